"""Where a load's rows come from: Parquet tables or frames the caller already has."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from snapdelta.config import DeltaLoad, FullLoad
from snapdelta.operators.projection import nullable, project, quoted, with_cursor

# A source gives the projected rows of a load, with its cursor column if it has one.
Source = Callable[[FullLoad], DataFrame]


def projected(df: DataFrame, load: FullLoad) -> DataFrame:
    rows = nullable(project(df, load))
    return with_cursor(rows, load) if isinstance(load, DeltaLoad) else rows


def parquet_tables(spark: SparkSession, root: str) -> Source:
    """Tables kept as ``<root>/<table>.parquet`` (a file or a folder of files)."""
    return lambda load: projected(spark.read.parquet(f"{root}/{load.table}.parquet"), load)


def frames(tables: Mapping[str, DataFrame]) -> Source:
    return lambda load: projected(tables[load.table], load)

