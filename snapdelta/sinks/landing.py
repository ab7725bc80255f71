"""Write snapshots and delta runs as Parquet."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from snapdelta.operators.schema import nullable_schema
from snapdelta.sinks.commits import VersionLog
from snapdelta.sinks.folders import Folders


Step = Callable[[DataFrame], DataFrame]


def _unchanged(df: DataFrame) -> DataFrame:
    return df


def write_files(
    df: DataFrame,
    folder: str,
    mode: str,
    rows_per_file: int = 0,
    finish: Step = _unchanged,
    **metrics: Column,
) -> dict:
    """Write Parquet and return ``n_rows`` and the given metrics, all taken during the write.

    ``finish`` is applied after the metrics are taken, e.g. to write the observed columns as text.

    The metrics are observed in the writing stage itself, where Spark counts each task once even
    if an executor is lost and its tasks run again.
    """
    seen = Observation()
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("n_rows"), *[m.alias(name) for name, m in metrics.items()]
    )
    writer = finish(observed).write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(folder)
    return seen.get


def write_run(
    df: DataFrame, folder: str, rows_per_file: int = 0, finish: Step = _unchanged, **metrics: Column
) -> dict:
    """Write one run of an increment to a folder of its own; a run without rows leaves no files."""
    found = write_files(df, folder, "overwrite", rows_per_file, finish, **metrics)
    if not found["n_rows"]:
        Folders(df.sparkSession).delete(folder)
    return found


# Beside the runs of a snapshot: which of them make up its versions.
VERSIONS = "_versions"
# The run that stands for files right in the folder, from a writer without versions.
PLAIN = "."


def _write_version(df: DataFrame, folder: str, rows_per_file: int, keep: bool, finish: Step, metrics: dict) -> dict:
    """Write ``df`` as a run of its own, then commit the version that names it, alone or beside the runs before."""
    spark = df.sparkSession
    folders, log = Folders(spark), VersionLog(spark, f"{folder}/{VERSIONS}")
    name = f"run-{uuid.uuid4().hex}"
    try:
        found = write_files(df, f"{folder}/{name}", "errorifexists", rows_per_file, finish, **metrics)
        run = {"folder": name, "schema": nullable_schema(finish(df).schema).jsonValue()}
        committed = False
        while not committed:
            version, before = log.newest()
            if not version and folders.data_files(folder):
                log.commit(1, {"runs": [{"folder": PLAIN}]})  # what a writer without versions left is the first one
                continue
            runs = snapshot_runs(spark, folder, before) if keep else []
            committed = log.commit(version + 1, {"runs": [*runs, run]})
    except BaseException:
        # a commit whose answer was lost still counts
        _, newest = log.newest()
        if not any(each["folder"] == name for each in (newest or {}).get("runs", ())):
            folders.delete(f"{folder}/{name}")
        raise
    if not keep:
        _drop_before(folders, log, folder, version + 1)
    return found


def _drop_before(folders: Folders, log: VersionLog, folder: str, version: int) -> None:
    """Delete the runs that only versions before the last one name: readers may still be at the last one."""
    taken = [each for each in log.versions() if each <= version]
    held = {run["folder"] for each in log.versions()[-2:] + taken[-2:] for run in (log.read(each) or {}).get("runs", ())}
    for each in taken[:-2]:
        for run in (log.read(each) or {}).get("runs", ()):
            if run["folder"] == PLAIN:
                for file in folders.data_files(folder):
                    folders.delete(file)
            elif run["folder"] not in held:
                folders.delete(f"{folder}/{run['folder']}")
        log.drop(each)


def snapshot_runs(spark: SparkSession, folder: str, version: dict | None = None) -> list[dict]:
    """The runs (``folder``, ``schema``) that make up a snapshot's newest version."""
    if version is None:
        _, version = VersionLog(spark, f"{folder}/{VERSIONS}").newest()
    if version is not None:
        return version["runs"]
    return [{"folder": PLAIN}] if Folders(spark).data_files(folder) else []


def vacuum_snapshot(spark: SparkSession, folder: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete runs that no version names, left by drivers that died; only those older than any load may last."""
    folders, log = Folders(spark), VersionLog(spark, f"{folder}/{VERSIONS}")
    named = {run["folder"] for version in log.versions() for run in (log.read(version) or {}).get("runs", ())}
    left = [f"{folder}/{name}" for name in folders.names(folder) if name.startswith("run-") and name not in named]
    left = [each for each in left if time.time() - folders.modified(each) >= older_than_hours * 3600]
    for each in left:
        folders.delete(each)
    return left


def replace_snapshot(df: DataFrame, folder: str, rows_per_file: int = 0, in_place: bool = False) -> int:
    """Put ``df`` in place of the folder's rows; gives the rows written.

    The rows are written to a run folder of their own, and a small version file that names it is created
    last: whoever reads by ``snapshot_runs`` sees the old snapshot or the new one, at every moment and
    after a failure at any step, and nothing is moved or copied. The version before stays for those who are
    still reading it. A snapshot can be rebuilt from itself. ``in_place`` keeps plain files in the folder, for
    readers that know no versions, at the price that a failed write leaves no snapshot.
    """
    return SnapshotWriter(in_place=in_place).write(df, folder, rows_per_file)["n_rows"]


def append_snapshot(df: DataFrame, folder: str, rows_per_file: int = 0, in_place: bool = False) -> int:
    """Add ``df`` to the folder's rows, in the same way."""
    return SnapshotWriter(keep_existing=True, in_place=in_place).write(df, folder, rows_per_file)["n_rows"]


# Beside the days of a delta log: which schema version each run was written under, as empty files
# ``v<version>/<day and run>``.
RUNS = "_runs"


def run_mark(day: str, run_id: str) -> str:
    return quote(f"{day.strip('/')}/{run_id}", safe="")


def run_of_mark(mark: str) -> str:
    return unquote(mark)


def mark_run(spark: SparkSession, log_folder: str, day: str, run_id: str, version: int) -> None:
    """Note the schema version of a run that is about to be written, and forget that of an earlier try."""
    folders, mark = Folders(spark), run_mark(day, run_id)
    unmark_run(spark, log_folder, day, run_id, but=version)
    folders.create_text(f"{log_folder}/{RUNS}/v{version:012}/{mark}", "")


def unmark_run(spark: SparkSession, log_folder: str, day: str, run_id: str, but: int = 0) -> None:
    folders, mark = Folders(spark), run_mark(day, run_id)
    for version in folders.names(f"{log_folder}/{RUNS}"):
        if int(version[1:]) != but:
            folders.delete(f"{log_folder}/{RUNS}/{version}/{mark}")


def marked_runs(spark: SparkSession, log_folder: str) -> dict[str, int]:
    """The schema version of each marked run, by ``<day>/<run>``."""
    folders = Folders(spark)
    versions = folders.names(f"{log_folder}/{RUNS}")
    return {run_of_mark(mark): int(version[1:]) for version in versions for mark in folders.names(f"{log_folder}/{RUNS}/{version}") if mark[0] != "."}


class SnapshotWriter:
    """Snapshots of one job: the first load of a folder replaces it, later ones add to it."""

    def __init__(self, keep_existing: bool = False, in_place: bool = False):
        self.keep_existing = keep_existing
        self.in_place = in_place
        self._replaced: set[str] = set()

    def write(self, df: DataFrame, folder: str, rows_per_file: int = 0, finish: Step = _unchanged, **metrics: Column) -> dict:
        """Write a load's rows; gives ``n_rows`` and the metrics."""
        keep = self.keep_existing or folder in self._replaced
        if self.in_place:
            found = write_files(df, folder, "append" if keep else "overwrite", rows_per_file, finish, **metrics)
        else:
            found = _write_version(df, folder, rows_per_file, keep, finish, metrics)
        self._replaced.add(folder)
        return found


def even_files(df: DataFrame) -> DataFrame:
    """Gather the few rows an increment leaves in each scan task into files of a sensible size.

    Spark sizes the partitions at run time (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    """
    return df.hint("rebalance")
