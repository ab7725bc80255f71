"""Stable column types from one batch to the next."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapdelta.functions.text import iso_text, or_blank
from snapdelta.operators.projection import quoted

# Columns that are always written as text.
STABLE_TEXT_COLUMNS = (
    "sender_user_id",
    "receiver_user_id",
    "receiver_company_id",
    "email_send_at",
    "event_received_at",
    "request_received_at",
)

def _as_stable_text(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return or_blank(iso_text(column, zoned=isinstance(data_type, T.TimestampType)))
    return or_blank(column.cast("string"))


def stable_text(df: DataFrame, columns: Iterable[str] = STABLE_TEXT_COLUMNS) -> DataFrame:
    """Write the named columns as text: NULL as blank, timestamps as ISO 8601."""
    named = set(columns)
    return df.select(
        [
            _as_stable_text(F.col(quoted(f.name)), f.dataType).alias(f.name)
            if f.name in named
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


# The column that holds what did not fit a declared type, as column name -> text.
REJECTED = "_rejected"

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def nullable_schema(schema: T.StructType) -> T.StructType:
    """The same columns, all of them allowed to be NULL."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def wider_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both: whole numbers, decimals and reals by size, dates as
    times, and text for what has no number or time in common. Nothing is rounded on the way."""
    if left == right:
        return left
    names = {left.typeName(), right.typeName()}
    if left in _WHOLE and right in _WHOLE:
        return max(left, right, key=_WHOLE.index)
    if names == {"float", "double"}:
        return T.DoubleType()
    exact = [T.DecimalType(_DIGITS[t.simpleString()], 0) if t in _WHOLE else t for t in (left, right)]
    if all(isinstance(t, T.DecimalType) for t in exact):
        scale = max(t.scale for t in exact)
        digits = max(t.precision - t.scale for t in exact) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    small = [t for t in (left, right) if t in _WHOLE[:3]]
    if len(small) == 1 and names & {"float", "double"}:
        return T.DoubleType()
    if names == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    return T.StringType()


def widened(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The columns of both, those of ``old`` first, in types that hold the values of both."""
    if old is None:
        return nullable_schema(new)
    by_name = {f.name: f.dataType for f in new.fields}
    known = [T.StructField(f.name, wider_type(f.dataType, by_name.get(f.name, f.dataType))) for f in old.fields]
    names = set(old.fieldNames())
    return T.StructType(known + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in names])


def conform(df: DataFrame, schema: T.StructType, on_bad_value: str = "fail") -> DataFrame:
    """The declared columns, in order, in their declared types; missing ones are NULL.

    ``on_bad_value``: ``fail`` stops on a value that does not fit, ``null`` writes NULL for it, ``reject``
    does so too and keeps the value's text in a last column ``_rejected`` (a map by column name, NULL in rows
    without such a value).
    """
    if on_bad_value not in ("fail", "null", "reject"):
        raise ValueError("on_bad_value must be 'fail', 'null' or 'reject'")
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType)
        value = F.col(quoted(field.name))
        if have[field.name] == field.dataType:
            return value
        return value.cast(field.dataType) if on_bad_value == "fail" else value.try_cast(field.dataType)

    columns = [column(field).alias(field.name) for field in schema.fields]
    if on_bad_value == "reject":
        if REJECTED in schema.fieldNames():
            raise ValueError(f"a declared column is named {REJECTED}")
        columns.append(_rejected(have, schema).alias(REJECTED))
    return df.select(columns)


def _rejected(have: dict[str, T.DataType], schema: T.StructType) -> Column:
    """The values that their declared type does not hold, as texts by column name."""
    found = []
    for field in schema.fields:
        if field.name in have and have[field.name] != field.dataType:
            value = F.col(quoted(field.name))
            lost = value.isNotNull() & value.try_cast(field.dataType).isNull()
            found.append(F.when(lost, F.struct(F.lit(field.name), value.cast("string"))))
    if not found:
        return F.lit(None).cast("map<string,string>")
    lost = F.array_compact(F.array(*found))
    return F.when(F.size(lost) > 0, F.map_from_entries(lost))


def text_for_complex(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, other columns unchanged."""
    complex_types = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        [
            F.to_json(quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, complex_types)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def columns_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A schema as rows ``(name, type)``."""
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "name string, type string")


def schema_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns whose type differs between two ``(name, type)`` frames, or that one side lacks."""
    joined = left.withColumnRenamed("type", "left_type").join(
        right.withColumnRenamed("type", "right_type"), "name", "full_outer"
    )
    status = (
        F.when(F.col("left_type").isNull(), "missing_left")
        .when(F.col("right_type").isNull(), "missing_right")
        .otherwise("type_differs")
    )
    return joined.filter(~F.col("left_type").eqNullSafe(F.col("right_type"))).select(
        "name", "left_type", "right_type", status.alias("status")
    )


def merge_batches(batches: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Batches whose columns or types drifted, as one frame of the declared schema, or of the narrowest one that
    holds them all."""
    from snapdelta.operators.compact import union_outputs

    if schema is None:
        for batch in batches:
            schema = widened(schema, batch.schema)
    return union_outputs([conform(batch, schema) for batch in batches])
