"""Read loads from PostgreSQL. The database evaluates the projection text as it is written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from snapdelta.config import DeltaLoad, FullLoad
from snapdelta.operators.projection import nullable, prune
from snapdelta.sources.slices import DatabaseCounts, plan_slices
from snapdelta.sources.tables import Source

DEFAULT_FETCH_ROWS = 100_000


@dataclass(frozen=True)
class Connection:
    host: str = ""
    user: str = ""
    password: str = ""
    database: str = ""
    port: int | str = 5432
    sslmode: str = ""
    statement_timeout_ms: int | None = None
    keepalive: bool = True

    def options(self, fetch_rows: int = DEFAULT_FETCH_ROWS) -> dict[str, str]:
        """Options for ``spark.read.format("jdbc")``; all missing parts are named in one error."""
        needed = ("host", "port", "user", "password", "database")
        missing = [name for name in needed if not getattr(self, name)]
        if missing:
            raise ValueError("missing connection settings: " + ", ".join(missing))
        url = f"jdbc:postgresql://{self.host}:{int(self.port)}/{self.database}"
        options = {
            "url": url + (f"?sslmode={self.sslmode}" if self.sslmode else ""),
            "driver": "org.postgresql.Driver",
            "user": self.user,
            "password": self.password,
            "fetchsize": str(fetch_rows),
            "tcpKeepAlive": str(self.keepalive).lower(),
            # Times without a zone stay without one.
            "preferTimestampNTZ": "true",
        }
        if self.statement_timeout_ms:
            options["sessionInitStatement"] = f"SET statement_timeout = {int(self.statement_timeout_ms)}"
        return options


def _name(value: str) -> str:
    return '"' + value.replace('"', '""') + '"'


def source_query(load: FullLoad) -> str:
    """The load as one sub-query for ``dbtable``; Spark adds its column pruning and cursor filter."""
    lists = {
        "select_sql": (load.select_sql or "").strip(),
        "columns": ", ".join(_name(c) for c in load.columns or ()),
        # output_columns prune the frame, and Spark the query: names the table lacks are left out, as over Parquet
        "all": "*",
    }
    query = f"SELECT {lists[load.projection]} FROM {_name(load.schema)}.{_name(load.table)}"
    if isinstance(load, DeltaLoad) and load.cursor_expression:
        cursor = f"({load.cursor_expression.strip()}) AS {_name(load.cursor_column)}"
        query = f"SELECT src.*, {cursor} FROM ({query}) AS src"
    return f"({query}) AS extract"


def planned_slices(load: FullLoad, rows: Callable[[str], Sequence]) -> list[str] | None:
    """Conditions for a partitioned read of the load, by the counts that ``rows`` gets from the database for a
    query text; None where the load asks for no slices."""
    if not load.read_slices or load.read_slices < 2:
        return None
    if not load.slice_columns:
        raise ValueError(f"{load.label}: read_slices needs slice_columns")
    return plan_slices(DatabaseCounts(rows, source_query(load)), load.slice_columns, load.read_slices)


def connections_from(given: dict[str, dict], settings: dict) -> dict[str, Connection]:
    """Connections by alias; what a connection leaves open comes from the settings' ``postgres`` section."""
    postgres = settings.get("postgres") or {}
    common = {"statement_timeout_ms": postgres.get("statement_timeout_ms"), "keepalive": postgres.get("tcp_keepalives_enabled")}
    common = {name: value for name, value in common.items() if value is not None}
    return {alias: Connection(**{**common, **parts}) for alias, parts in given.items()}


def fetch_rows_from(settings: dict) -> int:
    """Rows per fetch where a table sets none, from the settings' ``runtime`` or ``extract`` section."""
    runtime, extract = (settings.get(name) or {} for name in ("runtime", "extract"))
    return int(runtime.get("extract_chunk_size") or extract.get("chunk_size") or DEFAULT_FETCH_ROWS)


def postgres_tables(spark: SparkSession, connections: dict[str, Connection], fetch_rows: int = DEFAULT_FETCH_ROWS) -> Source:
    """Loads by database alias.

    A load with ``read_slices`` is read by that many tasks or a few more, one per condition of its slice plan;
    the others are one streaming read.
    """

    def rows(load: FullLoad) -> DataFrame:
        options = connections[load.database].options(load.extract_chunk_size or fetch_rows)

        def answered(query: str) -> Sequence:
            return spark.read.format("jdbc").options(dbtable=f"({query}) AS plan", **options).load().collect()

        conditions = planned_slices(load, answered)
        if conditions is None:
            read = spark.read.format("jdbc").options(dbtable=source_query(load), **options).load()
        else:
            url = options.pop("url")
            read = spark.read.jdbc(url, source_query(load), predicates=conditions, properties=options)
        kept = load.output_columns if load.projection == "all" else None
        return nullable(prune(read, kept))

    return rows
