"""Read landed tables back."""

from __future__ import annotations

import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapdelta.config import DeltaLoad
from snapdelta.operators.cursor import above, cursor_literal
from snapdelta.operators.schema import merge_batches
from snapdelta.sinks.folders import Folders
from snapdelta.sinks.landing import PLAIN, marked_runs, snapshot_runs
from snapdelta.sinks.layout import Layout
from snapdelta.sinks.manifest import bound, manifest, runs_with_manifest
from snapdelta.state.schemas import SchemaStore


def _together(frames: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    return frames[0] if len(frames) == 1 and schema in (None, frames[0].schema) else merge_batches(frames, schema)


def _unversioned(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Files of writers that kept no schema: one frame if their types agree, else one for each folder."""
    try:
        return [spark.read.option("mergeSchema", True).parquet(*paths)]
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return [spark.read.option("mergeSchema", True).parquet(path) for path in paths]


def read_snapshot_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The newest version of a snapshot, with the columns of all runs that make it up.

    A column that some runs lack is NULL there; where types differ, the narrowest type that holds all of them.
    """
    runs = snapshot_runs(spark, folder)
    if not runs:
        raise FileNotFoundError(f"no snapshot in {folder}")
    by_schema: dict[str, list[str]] = {}
    frames = []
    for run in runs:
        if run["folder"] == PLAIN:
            frames += _unversioned(spark, Folders(spark).data_files(folder))
        else:
            by_schema.setdefault(json.dumps(run["schema"]), []).append(f"{folder}/{run['folder']}")
    frames += [spark.read.schema(T.StructType.fromJson(json.loads(text))).parquet(*paths) for text, paths in by_schema.items()]
    return _together(frames)


def read_snapshot(spark: SparkSession, layout: Layout, table: str, day: str) -> DataFrame:
    """One day's snapshot, with the columns of all loads that share it."""
    return read_snapshot_folder(spark, layout.snapshot(table, day))


def _runs_by_version(spark: SparkSession, layout: Layout, table: str, days: Sequence[str] | None) -> dict[int, list[str]]:
    """The run folders of a log by the schema version they were written under; 0 for none."""
    log = layout.delta_log(table)
    folders = [log] if days is None else [layout.delta(table, day) for day in days]
    found = [run for folder in folders for run in Folders(spark).data_folders(folder)]
    if not found:
        raise FileNotFoundError(f"no landed files for {table} under {folders}")
    marked = marked_runs(spark, log)
    by_version: dict[int, list[str]] = {}
    for run in found:
        by_version.setdefault(marked.get(run.removeprefix(log).strip("/"), 0), []).append(run)
    return by_version


def _read_versions(spark: SparkSession, layout: Layout, table: str, by_version: dict[int, list[str]]) -> DataFrame:
    store = SchemaStore(spark, layout.schemas)
    frames = [spark.read.schema(store.at(table, version)).parquet(*by_version[version]) for version in sorted(by_version) if version]
    if 0 in by_version:
        return _together(frames + _unversioned(spark, by_version[0]))
    newest = store.current(table)[1]
    return _together(frames, newest) if frames else spark.createDataFrame([], newest)


def read_delta_log(
    spark: SparkSession, layout: Layout, table: str, days: Sequence[str] | None = None
) -> DataFrame:
    """All runs of a delta table, or those of some days; only the named days' folders are listed.

    Each run is read under the schema version that it was written with and put into the table's newest one:
    a column that only some runs have is NULL in the others, and a column whose type changed has the type
    that holds all its values. No file is opened to find out.
    """
    return _read_versions(spark, layout, table, _runs_by_version(spark, layout, table, days))


def read_above(spark: SparkSession, layout: Layout, load: DeltaLoad, value, days: Sequence[str] | None = None) -> DataFrame:
    """The landed rows of a load whose cursor is above ``value``.

    Files whose bounds in the manifest lie at or below the value are not opened; in the others the filter is
    pushed to the scan. Runs without a manifest are read as they are.
    """
    log, table = layout.delta_log(load.output_name), load.output_name
    by_version = _runs_by_version(spark, layout, table, days)
    if value is not None:
        bounded = runs_with_manifest(spark, log)
        schema = SchemaStore(spark, layout.schemas).current(table)[1]
        files = _files_above(spark, log, load, value, schema) if bounded and schema else {}

        def chosen(run: str) -> list[str]:
            name = run.removeprefix(log).strip("/")
            return [f"{run}/{file}" for file in files.get(name, ())] if name in bounded and schema else [run]

        by_version = {version: [path for run in runs for path in chosen(run)] for version, runs in by_version.items()}
        by_version = {version: paths for version, paths in by_version.items() if paths}
    rows = _read_versions(spark, layout, table, by_version)
    return above(rows, load.cursor_column, value, load.cursor_expression)


def _files_above(spark: SparkSession, log: str, load: DeltaLoad, value, schema: T.StructType) -> dict[str, list[str]]:
    data_type = schema[load.cursor_column].dataType
    rows = manifest(spark, log).filter(F.col("column") == load.cursor_column)
    files: dict[str, list[str]] = {}
    # as many names as a scan of these files lists
    for row in rows.filter(bound("high", data_type) > cursor_literal(value, data_type)).select("run", "file").collect():
        files.setdefault(row["run"], []).append(row["file"])
    return files


def log_bounds(spark: SparkSession, layout: Layout, table: str, column: str) -> DataFrame:
    """One row: lowest and highest value of a tracked column and the rows of a log, from its manifest alone."""
    log = layout.delta_log(table)
    runs = [run.removeprefix(log).strip("/") for run in Folders(spark).data_folders(log)]
    missing = sorted(set(runs) - runs_with_manifest(spark, log))
    _, schema = SchemaStore(spark, layout.schemas).current(table)
    if missing or schema is None:
        raise ValueError(f"{table}: no manifest of {', '.join(missing) or 'any run'}")
    kind = schema[column].dataType
    rows = manifest(spark, log).filter((F.col("column") == column) & F.col("run").isin(runs))
    return rows.agg(F.min(bound("low", kind)).alias("lo"), F.max(bound("high", kind)).alias("hi"), F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("n_rows"))
