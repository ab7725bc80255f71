"""Array, map and range columns as PostgreSQL prints them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from snapdelta.functions.text import _column, as_text, number_text, or_blank, timestamptz_text
from snapdelta.operators.projection import quoted

# An array element is quoted when it is empty, reads NULL, or holds one of these characters.
_QUOTED = r'[{},"\\ \t\n\x0B\f\r]'


def _quoted_element(text: Column) -> Column:
    escaped = F.regexp_replace(text, r'(["\\])', r"\\$1")
    needs_quotes = (text == "") | (F.upper(text) == "NULL") | text.rlike(_QUOTED)
    return F.when(text.isNull(), "NULL").when(needs_quotes, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(text)


def _element(item: Column, kind: T.DataType) -> Column:
    """An element as it stands between the braces: an inner array bare, anything else as its own text, in quotes if
    it has to be."""
    if isinstance(kind, T.ArrayType):
        return F.coalesce(array_literal(item, kind), F.lit("NULL"))
    if isinstance(kind, T.BooleanType):
        return F.when(item.isNull(), "NULL").when(item, "t").otherwise("f")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.coalesce(number_text(item), F.lit("NULL"))
    if isinstance(kind, (T.IntegralType, T.DecimalType, T.DateType)):
        return F.coalesce(item.cast("string"), F.lit("NULL"))
    if isinstance(kind, T.TimestampType):
        return _quoted_element(timestamptz_text(item))
    if isinstance(kind, T.BinaryType):
        return _quoted_element(F.concat(F.lit("\\x"), F.lower(F.hex(item))))
    if isinstance(kind, (T.StructType, T.MapType)):
        return _quoted_element(F.to_json(item))
    return _quoted_element(item.cast("string"))


def array_literal(value: Column | str, kind: T.DataType | str = "array<string>") -> Column:
    """``array::text``, e.g. ``{a,"b c",NULL}``; a NULL array stays NULL.

    ``kind`` is the column's type: numbers, flags (``t``, ``f``), times and inner arrays (``{{1,2},{3,4}}``) are
    printed by their own rules.
    """
    kind = T._parse_datatype_string(kind) if isinstance(kind, str) else kind
    items = F.array_join(F.transform(_column(value), lambda item: _element(item, kind.elementType)), ",")
    return F.concat(F.lit("{"), items, F.lit("}"))


def array_literals(df: DataFrame) -> DataFrame:
    """The frame with each array column as its literal, by the types of its schema."""
    return df.select([array_literal(F.col(quoted(f.name)), f.dataType).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(quoted(f.name)) for f in df.schema.fields])


def json_array(value: Column | str) -> Column:
    """``array_to_json(a)::text``: NULL elements kept, NULL array stays NULL."""
    return F.to_json(_column(value))


def json_array_or_empty(value: Column | str) -> Column:
    return F.coalesce(json_array(value), F.lit("[]"))


def joined(value: Column | str, separator: str = ",") -> Column:
    """``array_to_string``: NULL elements skipped."""
    return F.array_join(_column(value), separator)


def exploded(value: Column | str) -> Column:
    """``unnest`` in a select list: one row per element, none for NULL or empty arrays."""
    return F.explode(_column(value))


def map_text(value: Column | str, key: str) -> Column:
    """``COALESCE(m -> 'key', '')``."""
    return or_blank(F.try_element_at(_column(value), F.lit(key)))


def range_text(lower: Column | str, upper: Column | str, quoted: bool = False) -> Column:
    """``range::text`` of a half-open range; a missing bound is open and prints nothing.

    Set ``quoted`` for bounds whose text holds a blank or comma, such as timestamps.
    """

    def bound(value: Column | str) -> Column:
        text = as_text(value)
        return or_blank(F.concat(F.lit('"'), text, F.lit('"')) if quoted else text)

    opening = F.when(_column(lower).isNull(), "(").otherwise("[")
    body = F.concat(opening, bound(lower), F.lit(","), bound(upper), F.lit(")"))
    same = as_text(lower) == as_text(upper)
    return F.when(F.coalesce(same, F.lit(False)), "empty").otherwise(body)
