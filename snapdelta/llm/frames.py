"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapdelta.session import shared_root, work_folder


def text_of(column: str | Column) -> Column:
    """A text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def kept(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and go on from there; lost executors do not lose it."""
    shared_root(frame.sparkSession)
    return frame.checkpoint()


#: Narrow rows that are worth a partition of their own.
PART_ROWS = 100_000


def gathered(frame: DataFrame, rows: int) -> DataFrame:
    """A stored frame of so many narrow rows in no more partitions than they are worth, so that the shuffles behind it
    do not write a file for each of many nearly empty ones."""
    return frame.coalesce(rows // PART_ROWS + 1)


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """As ``kept``, in Parquet: for wide rows, of which later steps read some columns."""
    folder = work_folder(frame.sparkSession, label)
    frame.write.mode("overwrite").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
