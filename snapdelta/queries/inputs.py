"""Shapes the operators need, made from the given tables the same way in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapdelta.config import DeltaLoad
from snapdelta.session import work_folder
from snapdelta.sinks.layout import Layout


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def layout(spark: SparkSession) -> Layout:
    return Layout(work_folder(spark, "landing"))


# A row with a creation and an update time; the second is NULL for large quantities.
_LINE_COLUMNS = [
    "l_orderkey AS order_id",
    "l_linenumber AS line_no",
    "l_partkey AS part_id",
    "l_suppkey AS supplier_id",
    "l_quantity AS quantity",
    "l_extendedprice AS price",
]
_UPDATED = "CASE WHEN l_quantity > 45 THEN NULL ELSE l_shipdate END AS updated_at"
_CREATED = "o_orderdate AS created_at"
# Here the first one can be NULL too, so that some rows have no cursor at all.
_CREATED_OR_NULL = "CASE WHEN l_linenumber = 1 THEN NULL ELSE o_orderdate END AS created_at"


def _lines_sql(created: str) -> str:
    columns = ", ".join([*_LINE_COLUMNS, created, _UPDATED])
    return f"SELECT {columns} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


ORDER_LINES = _lines_sql(_CREATED)
ORDER_LINES_WITH_GAPS = _lines_sql(_CREATED_OR_NULL)


def _lines(spark: SparkSession, folder: str, created: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(*_LINE_COLUMNS, created, _UPDATED)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, _CREATED)


def order_lines_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, _CREATED_OR_NULL)


LINE_LOAD = DeltaLoad(
    database="shop",
    schema="public",
    table="order_lines",
    columns=("order_id", "line_no", "part_id", "supplier_id", "quantity", "price", "created_at", "updated_at"),
    cursor_column="row_cursor",
    cursor_expression="GREATEST(created_at, updated_at)",
)

EVENT_LOAD = DeltaLoad(database="web", schema="public", table="events", cursor_column="ts")
