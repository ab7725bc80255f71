"""Cursor filters, bounds and literals for incremental extracts."""

from __future__ import annotations

import re
from datetime import date, datetime, time
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from snapdelta.functions.text import iso_text, strip
from snapdelta.operators.projection import quoted

# Cursor texts read as integers, and as calendar dates or date-times.
INTEGER_TEXT = r"^-?[0-9]+$"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
TIME_TEXT = r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?"
ZONE_TEXT = r"(Z|[+-][0-9]{2}:[0-9]{2})"


def coerce_cursor(value):
    """A configured floor as the value to compare with: integer, date-time or text; blank is none."""
    if isinstance(value, str):
        return _coerce_text(value)
    if isinstance(value, date) and not isinstance(value, datetime):
        return datetime.combine(value, time.min)
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def _coerce_text(raw: str):
    text = raw.strip()
    if not text:
        return None
    if re.match(INTEGER_TEXT, text):
        return int(text)
    try:
        return datetime.fromisoformat(text)
    except ValueError:
        return raw


def coerce_cursor_columns(raw: Column | str) -> Column:
    """The same rules for a column of cursor texts.

    Gives a struct: ``kind`` (``none``, ``integer``, ``timestamp``, ``text``) and one value field
    per kind. Date-times with a zone are turned into UTC.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    text = strip(raw)
    stamp = DATE_TEXT + TIME_TEXT
    as_integer = F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))
    local = F.when(text.rlike(stamp + "$"), text.try_cast("timestamp_ntz"))
    zoned = F.when(text.rlike(stamp + ZONE_TEXT + "$"), text.try_cast("timestamp"))
    in_utc = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), zoned.cast("timestamp_ntz")
    )
    as_timestamp = F.coalesce(local, in_utc)
    kind = (
        F.when(raw.isNull() | (text == ""), "none")
        .when(as_integer.isNotNull(), "integer")
        .when(as_timestamp.isNotNull(), "timestamp")
        .otherwise("text")
    )
    return F.struct(
        kind.alias("kind"),
        as_integer.alias("integer_value"),
        as_timestamp.alias("timestamp_value"),
        F.when(kind == "text", raw).alias("text_value"),
    )


def cursor_literal(value, data_type: T.DataType | None = None) -> Column:
    """``value`` as a constant of the cursor's own type.

    The cast sits on the constant, never on the column, so that the filter still reaches the scan.
    """
    if isinstance(value, datetime):
        aware = value.tzinfo is not None
        literal = F.lit(value.isoformat(sep=" ")).cast("timestamp" if aware else "timestamp_ntz")
    elif isinstance(value, date):
        literal = F.lit(value.isoformat()).cast("date")
    elif isinstance(value, Decimal):
        literal = F.lit(str(value)).cast(T.DecimalType(38, max(0, -value.as_tuple().exponent)))
    else:
        literal = F.lit(value)
    return literal.cast(data_type) if data_type is not None else literal


def greatest_columns(expression: str | None) -> list[str]:
    """The columns of a plain ``GREATEST(a, b, ...)``; empty for any other expression."""
    name = r"(?:`[^`]+`|[A-Za-z_]\w*)"
    plain = rf"\s*greatest\s*\(\s*({name}(?:\s*,\s*{name})+)\s*\)\s*"
    found = re.fullmatch(plain, expression or "", re.IGNORECASE)
    return [part.strip().strip("`") for part in found.group(1).split(",")] if found else []


def any_above(df: DataFrame, columns: list[str], value) -> Column:
    """``greatest(columns) > value`` as ``a > value OR b > value``.

    Both keep the same rows, because ``greatest`` skips NULLs, but only the OR form is pushed into
    Parquet and JDBC scans.
    """
    tests = [F.col(quoted(c)) > cursor_literal(value, df.schema[c].dataType) for c in columns]
    return reduce(lambda left, right: left | right, tests)


def above(
    df: DataFrame, cursor: str, value, cursor_expression: str | None = None
) -> DataFrame:
    """Rows whose cursor is strictly greater than ``value``.

    NULL cursors and ties go; with no value nothing is filtered and NULL cursors stay.
    """
    if value is None:
        return df
    parts = greatest_columns(cursor_expression)
    by_type = {field.name: field.dataType for field in df.schema.fields}
    if parts and len({by_type.get(part) for part in parts}) == 1 and parts[0] in by_type:
        return df.filter(any_above(df, parts, value))
    return df.filter(F.col(quoted(cursor)) > cursor_literal(value, by_type[cursor]))


def first_floor(*candidates):
    """The first configured floor that is not None, coerced. A blank one means no floor at all."""
    for candidate in candidates:
        if candidate is not None:
            return coerce_cursor(candidate)
    return None


def in_cursor_order(df: DataFrame, cursor: str, globally: bool = False) -> DataFrame:
    """Ascending cursor order: inside each output file (no shuffle), or over the whole result."""
    order = F.col(quoted(cursor)).asc()
    return df.orderBy(order) if globally else df.sortWithinPartitions(order)


def cursor_bounds(df: DataFrame, cursor: str) -> DataFrame:
    """One row: smallest and largest cursor, NULL when there are no rows."""
    column = F.col(quoted(cursor))
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def bounds_above(df: DataFrame, cursor: str, marks: dict[str, object], name: str) -> DataFrame:
    """The bounds of several extracts of the same rows, one row per mark, from one pass."""
    column, data_type = F.col(quoted(cursor)), df.schema[cursor].dataType
    chosen = [F.when(column > cursor_literal(mark, data_type), column) if mark is not None else column for mark in marks.values()]
    bounds = df.agg(*[F.struct(F.min(each).alias("lo"), F.max(each).alias("hi")).alias(f"_{nth}") for nth, each in enumerate(chosen)])
    rows = [F.struct(F.lit(mark).alias(name), F.col(f"_{nth}.lo").alias("lo"), F.col(f"_{nth}.hi").alias("hi")) for nth, mark in enumerate(marks)]
    return bounds.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def describe_extract(df: DataFrame, cursor: str, last_value) -> DataFrame:
    """One row saying what an extract above ``last_value`` holds: mode, cutoff, bounds, rows.

    ``df`` is the extract, already filtered.
    """
    bounds = cursor_bounds(df, cursor)
    data_type = df.schema[cursor].dataType

    def shown(column: Column) -> Column:
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
            return iso_text(column, zoned=isinstance(data_type, T.TimestampType))
        return column.cast("string")

    first = last_value is None
    mode = "full_table" if first else "incremental"
    cutoff = F.lit(None).cast("string") if first else shown(cursor_literal(last_value, data_type))
    lo, hi = shown(F.col("lo")), shown(F.col("hi"))
    span = F.concat(F.lit(" min="), lo, F.lit(" max="), hi)
    empty = F.col("lo").isNull() & F.col("hi").isNull()
    head = f"{mode} column={cursor}"
    if first:
        text = F.when(empty, f"{head} no_rows_or_null_cursors").otherwise(
            F.concat(F.lit(f"{head} loading_all_rows"), span)
        )
    else:
        cut = F.concat(F.lit(f"{head} cutoff_exclusive="), cutoff)
        text = F.when(empty, F.concat(cut, F.lit(" matched_rows=0"))).otherwise(F.concat(cut, span))
    return bounds.select(
        F.lit(mode).alias("mode"),
        cutoff.alias("cutoff"),
        lo.alias("lo"),
        hi.alias("hi"),
        text.alias("description"),
    )
