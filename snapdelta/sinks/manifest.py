"""The bounds of cursor columns per landed file, beside a table's log, for readers that skip files by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapdelta.operators.projection import quoted
from snapdelta.sinks.folders import Folders
from snapdelta.sinks.landing import run_mark, run_of_mark
from snapdelta.state.watermark import stored_text

FOLDER = "_manifest"
SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("column", T.StringType()),
        T.StructField("n_null", T.LongType()),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
    ]
)


def write_manifest(run: DataFrame, log_folder: str, day: str, run_id: str, columns: Sequence[str]) -> None:
    """One row per file and column of a run just written; the scan reads these columns only.

    Bounds are state texts (``stored_text``), so that a column whose type is widened later keeps them.
    """
    tracked = [name for name in dict.fromkeys(columns) if name in run.columns]
    sizes = [F.count(quoted(name)).alias(f"filled_{nth}") for nth, name in enumerate(tracked)]
    bounds = [end(quoted(name)).alias(f"{end.__name__}_{nth}") for nth, name in enumerate(tracked) for end in (F.min, F.max)]
    counted = run.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n_rows"), *sizes, *bounds)
    each = [
        F.struct(
            F.lit(name).alias("column"),
            (F.col("n_rows") - F.col(f"filled_{nth}")).alias("n_null"),
            stored_text(F.col(f"min_{nth}"), run.schema[name].dataType).alias("low"),
            stored_text(F.col(f"max_{nth}"), run.schema[name].dataType).alias("high"),
        )
        for nth, name in enumerate(tracked)
    ]
    rows = counted.select("file", "n_rows", F.explode(F.array(*each)).alias("x")).select("file", "n_rows", "x.*")
    rows = rows.withColumn("run", F.lit(f"{day.strip('/')}/{run_id}")).select(SCHEMA.fieldNames())
    rows.coalesce(1).write.mode("overwrite").parquet(f"{log_folder}/{FOLDER}/{run_mark(day, run_id)}")


def manifest(spark: SparkSession, log_folder: str) -> DataFrame:
    """All manifest rows of a log."""
    folder = f"{log_folder}/{FOLDER}"
    if not Folders(spark).has_data(folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(folder)


def runs_with_manifest(spark: SparkSession, log_folder: str) -> set[str]:
    """``<day>/<run>`` of the runs whose manifest is complete."""
    folders = Folders(spark)
    names = folders.names(f"{log_folder}/{FOLDER}")
    return {run_of_mark(name) for name in names if "_SUCCESS" in folders.names(f"{log_folder}/{FOLDER}/{name}")}


def bound(text: str, data_type: T.DataType) -> Column:
    """A bound of the manifest as a value of the column's present type."""
    return F.col(text).cast(data_type)
