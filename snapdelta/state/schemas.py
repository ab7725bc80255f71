"""The columns and types of each table's log, version by version, beside the saved cursors."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import SparkSession, types as T

from snapdelta.operators.schema import widened
from snapdelta.sinks.commits import VersionLog


class SchemaStore:
    """A new column or a type that does not hold a batch's values makes a new version, never a failed load.

    Versions only widen, so a file written under any of them can be read under the newest without loss.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")

    def _log(self, table: str) -> VersionLog:
        readable = re.sub(r"[^A-Za-z0-9_]", "_", table)
        return VersionLog(self._spark, f"{self._folder}/{readable}-{hashlib.md5(table.encode()).hexdigest()}")

    def current(self, table: str) -> tuple[int, T.StructType | None]:
        """The newest version with its number; 0 and None for a table without one."""
        number, document = self._log(table).newest()
        if document is None:
            return number, None
        return document["number"], T.StructType.fromJson(document["schema"])

    def at(self, table: str, number: int) -> T.StructType:
        document = self._log(table).read(number)
        if document is None:
            raise KeyError(f"{table} has no schema version {number}")
        return T.StructType.fromJson(document["schema"])

    def admit(self, table: str, schema: T.StructType) -> tuple[int, T.StructType]:
        """The version a batch of ``schema`` is written under: the newest, widened first if it has to be."""
        log = self._log(table)
        while True:
            taken, document = log.newest()
            old = None if document is None else T.StructType.fromJson(document["schema"])
            wanted = widened(old, schema)
            if old == wanted:
                return document["number"], old
            if log.commit(taken + 1, {"number": taken + 1, "schema": wanted.jsonValue()}):
                return taken + 1, wanted
