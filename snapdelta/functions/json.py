"""Fields out of JSON text, as the text has them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from snapdelta.functions.text import _column

# What JSON allows before a document.
_BLANKS = " \t\n\r"
# Numbers that Spark's parser writes in another form: with a fraction, an exponent, or a sign before zero.
_UNSTABLE = r"[0-9][.eE]|-0"
# All up to the next number that is not inside a string, and the number, from where the last one ended. The quantifiers never give back, so a
# long string takes no stack.
_NUMBER = r'\G((?:[^"0-9-]++|"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+")*+)(-?[0-9][0-9.eE+-]*+)'
# A private character that tells numbers written as strings from strings.
_MARK = "\ue000"


def _type_of(path: tuple[str | int, ...]) -> T.DataType:
    """The type that reads what a path leads to as text, in one parse."""
    found: T.DataType = T.StringType()
    for step in reversed(path):
        found = T.ArrayType(found) if isinstance(step, int) else T.StructType([T.StructField(step, found)])
    return found


def _followed(read: Column, path: tuple[str | int, ...]) -> Column:
    for step in path:
        if isinstance(step, str):
            read = read.getField(step)
        else:
            read = F.get(read, F.lit(step) if step >= 0 else F.size(read) + step)
    return read


def _opened(document: Column, kind: T.DataType) -> Column:
    """The document read by a type, if it is an object or array as the type is."""
    mark = "[" if isinstance(kind, T.ArrayType) else "{"
    return F.when(F.startswith(F.ltrim(document, F.lit(_BLANKS)), F.lit(mark)), F.from_json(document, kind))


def _with_marked_numbers(document: Column) -> Column:
    return F.regexp_replace(document, _NUMBER, f'$1"{_MARK}$2"')


def _without_marks(text: Column) -> Column:
    """A number, or the numbers inside an inner document, as they stood."""
    return F.replace(F.regexp_replace(text, f'"{_MARK}([^"]*)"', "$1"), F.lit(_MARK), F.lit(""))


def json_text(value: Column | str, *path: str | int) -> Column:
    """``j -> 'a' ->> 'b'``: the field as text; missing fields and JSON null give NULL.

    Numbers keep every character (``1.10``, ``1e5``), inner documents lose the blanks between their tokens, and
    repeated names count as their last one. Names may hold any character; a whole number steps into an array,
    from its end if it is negative.
    """
    document = _column(value)
    if not path:
        return document
    kind = _type_of(path)
    exact = _without_marks(_followed(_opened(_with_marked_numbers(document), kind), path))
    return F.when(document.rlike(_UNSTABLE), exact).otherwise(_followed(_opened(document, kind), path))


def json_fields(value: Column | str, names: list[str]) -> list[Column]:
    """Several top-level fields as text from one parse of the document, by the same rules."""
    document = _column(value)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    unstable = document.rlike(_UNSTABLE)
    read = _opened(F.when(unstable, _with_marked_numbers(document)).otherwise(document), schema)
    return [F.when(unstable, _without_marks(read.getField(name))).otherwise(read.getField(name)).alias(name) for name in names]
