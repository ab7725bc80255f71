"""A delta log kept in buckets by key, so that the current row of each key is found without a shuffle.

Each run is folded to one row per key before it is dealt to the buckets: a key that holds a third of a
run arrives there as one row. A bucket therefore holds at most one row per key and run, sorted by key.
Reading the newest rows groups inside the buckets; only their own task ever compares them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapdelta.operators.compact import latest_per_key
from snapdelta.operators.projection import quoted
from snapdelta.session import work_folder


@dataclass(frozen=True)
class BucketedLog:
    """Runs of one table under ``path``, in ``buckets`` buckets by ``keys``, known to the session as ``name``.

    NULL is a key like any other. ``buckets`` is fixed for a log: choose it so that the newest rows of
    all keys over ``buckets`` fit a task; ``compacted`` can write a log of another number.
    """

    spark: SparkSession
    name: str
    path: str
    keys: tuple[str, ...]
    cursor: str
    buckets: int
    tiebreak: tuple[str, ...] = ()

    @classmethod
    def new(
        cls, spark: SparkSession, keys: Sequence[str], cursor: str, buckets: int, tiebreak: Sequence[str] = (), path: str = ""
    ) -> BucketedLog:
        if not keys or buckets < 1:
            raise ValueError("a bucketed log needs a key and a bucket")
        name = f"bucketed_{uuid.uuid4().hex[:12]}"
        return cls(spark, name, path or work_folder(spark, name), tuple(keys), cursor, buckets, tuple(tiebreak))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def append(self, run: DataFrame) -> None:
        """Add the newest row per key of a run: one file per bucket that has rows. The log's columns are its first run's."""
        if self.exists():
            run = run.select([F.col(quoted(name)) for name in self.rows().columns])
        self._write(latest_per_key(run, self.keys, self.cursor, self.tiebreak))

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def current(self) -> DataFrame:
        """The newest row of each key. The scan is dealt by the keys already, so no row is exchanged."""
        return latest_per_key(self.rows(), self.keys, self.cursor, self.tiebreak)

    def compacted(self, buckets: int = 0) -> BucketedLog:
        """A new log that holds the current rows only; this one stays as it is for its readers until ``drop``."""
        log = self.new(self.spark, self.keys, self.cursor, buckets or self.buckets, self.tiebreak)
        log._write(self.current())
        return log

    def drop(self) -> None:
        """Forget the table; the files stay until the folder goes."""
        self.spark.sql(f"DROP TABLE IF EXISTS {quoted(self.name)}")

    def _write(self, rows: DataFrame) -> None:
        dealt = rows.repartition(self.buckets, *[F.col(quoted(name)) for name in self.keys])
        first, *others = self.keys
        writer = dealt.write.format("parquet").option("path", self.path).mode("append")
        writer.bucketBy(self.buckets, first, *others).sortBy(first, *others).saveAsTable(self.name)
