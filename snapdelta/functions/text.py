"""Scalar cleaning with PostgreSQL results, written with built-in Spark functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The ASCII characters PostgreSQL's \\s matches, and all Unicode whitespace.
ASCII_SPACES = " \t\n\x0b\f\r"
UNICODE_SPACES = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Characters that end a line.
LINE_BREAKS = "\n\r\x0b\f\x1c\x1d\x1e\x85\u2028\u2029"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_text(value: Column | str) -> Column:
    """``x::text`` for ids, integers, decimals, flags and JSON text."""
    return _column(value).cast("string")


def timestamp_text(value: Column | str) -> Column:
    """``timestamp::text``: ``2024-01-01 00:00:00``, a fraction only when there is one."""
    return _column(value).cast("timestamp_ntz").cast("string")


def timestamptz_text(value: Column | str) -> Column:
    """``timestamptz::text``: as above plus the session zone's offset, minutes only when not zero."""
    offset = F.regexp_replace(F.date_format(_column(value), "xxx"), ":00$", "")
    return F.concat(_column(value).cast("string"), offset)


def iso_text(value: Column | str, zoned: bool = False) -> Column:
    """ISO 8601 with ``T``; microseconds (always six digits) only when they are not zero.

    ``zoned`` adds the session zone's offset, for columns that hold instants.
    """
    raw = _column(value).cast("string")
    padded = F.when(F.contains(raw, F.lit(".")), F.rpad(raw, 26, "0")).otherwise(raw)
    text = F.replace(padded, F.lit(" "), F.lit("T"))
    return F.concat(text, F.date_format(_column(value), "xxx")) if zoned else text


def number_text(value: Column | str) -> Column:
    """``float8::text``: plain digits from 1e-4 up to 1e15, ``d.ddde+XX`` outside that range.

    Spark's own cast switches to ``1.0E7`` at ten million and always writes ``.0``.
    """
    given = _column(value)
    value = given.cast("double")
    # a real keeps the digits it was written with, which a double would lengthen
    raw = F.when(F.typeof(given) == "float", given.cast("string")).otherwise(value.cast("string"))
    size = F.abs(value)
    short = F.when(raw.endswith(".0"), F.left(raw, F.length(raw) - 2)).otherwise(raw)
    # From here on Spark wrote an exponent.
    whole = value.cast("bigint").cast("string")
    return (
        F.when(~F.contains(raw, F.lit("E")), short)
        .when((size >= 1e7) & (size < 1e15) & (value == F.rint(value)), whole)
        .otherwise(once(raw, _with_exponent))
    )


def _with_exponent(raw: Column) -> Column:
    size = F.abs(raw.cast("double"))
    plain = F.regexp_replace(raw.try_cast("decimal(38,22)").cast("string"), r"\.?0+$", "")
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    power = F.substring_index(raw, "E", -1).try_cast("int")
    digits = F.abs(power).cast("string")
    exponent = F.concat(
        mantissa,
        F.when(power < 0, "e-").otherwise("e+"),
        F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits),
    )
    return F.when((size >= 1e-4) & (size < 1e15), plain).otherwise(exponent)


def or_blank(value: Column | str) -> Column:
    return F.coalesce(_column(value), F.lit(""))


def or_zero(value: Column | str, data_type: str) -> Column:
    """``COALESCE(x, 0)``; the column's type is given so that both sides agree under ANSI mode."""
    return F.coalesce(_column(value), F.lit(0).cast(data_type))


def or_false(value: Column | str) -> Column:
    return F.coalesce(_column(value), F.lit(False))


def newline_runs_to_space(value: Column | str) -> Column:
    """Each run of line breaks becomes one space."""
    return F.regexp_replace(_column(value), r"[\r\n]+", " ")


def _each_replaced(value: Column, characters: str, by: str) -> Column:
    """Every one of some characters replaced: byte searches, far cheaper than a regex or ``translate``."""
    for character in characters:
        if character != by:
            value = F.replace(value, F.lit(character), F.lit(by))
    return value


def once(value: Column, step: Callable[[Column], Column]) -> Column:
    """``step(value)`` with ``value`` worked out once, however often the step names it.

    The step runs inside a lambda, outside the generated code: a wide projection stays below the
    method size up to which the JVM compiles.
    """
    return F.get(F.transform(F.array(value), step), F.lit(0))


def _runs_to_one_space(value: Column, characters: str) -> Column:
    def collapsed(spaced: Column) -> Column:
        has_runs = F.contains(spaced, F.lit("  "))
        return F.when(has_runs, F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)

    return once(_each_replaced(value, characters, " "), collapsed)


def newlines_to_spaces(value: Column | str) -> Column:
    """Each line-break character becomes one space, so runs keep their length."""
    return _each_replaced(_column(value), "\n\r", " ")


def collapse_spaces(value: Column | str) -> Column:
    """Outer spaces go first (spaces only, not tabs), then each whitespace run becomes one space."""
    return _runs_to_one_space(F.trim(_column(value)), ASCII_SPACES)


def one_spaced(value: Column | str) -> Column:
    """Each run of Unicode whitespace becomes one space."""
    return _runs_to_one_space(_column(value), UNICODE_SPACES)


def strip(value: Column | str) -> Column:
    """Unicode whitespace removed from both ends."""
    return F.btrim(_column(value), F.lit(UNICODE_SPACES))


def lines(value: Column | str) -> Column:
    """The lines of a text, outer whitespace removed, blank ones left out."""
    unified = _each_replaced(_column(value), LINE_BREAKS, "\n")
    return F.filter(F.transform(F.split(unified, "\n"), strip), lambda line: line != "")


def without(value: Column | str, piece: str) -> Column:
    """Every occurrence of ``piece`` removed."""
    return F.replace(_column(value), F.lit(piece))
