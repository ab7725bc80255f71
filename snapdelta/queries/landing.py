"""Sinks: what is landed must equal what was read."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdelta.config import FullLoad
from snapdelta.plans.job import write_run_summary
from snapdelta.plans.loads import load_full
from snapdelta.queries.inputs import layout, table
from snapdelta.queries.registry import query
from snapdelta.sinks.landing import SnapshotWriter, write_files
from snapdelta.sinks.layout import Layout, folder_column
from snapdelta.sources.landed import read_delta_log, read_snapshot
from snapdelta.sources.tables import frames, parquet_tables

DAY = "2024/01/31"


@query(
    "snapshot_roundtrip",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance FROM customer",
)
def snapshot_roundtrip(spark, folder):
    select_sql = "CAST(c_custkey AS string) AS id, c_name AS name, c_acctbal AS balance"
    load = FullLoad("shop", "public", "customer", "clients", select_sql=select_sql)
    place = layout(spark)
    load_full(parquet_tables(spark, folder)(load), load, place, DAY, SnapshotWriter())
    return read_snapshot(spark, place, "clients", DAY)


def _two_runs(spark, folder, keep_existing):
    """Two jobs on one day: the first lands the finished orders, the second all of them."""
    orders, place = table(spark, folder, "orders"), layout(spark)
    load = FullLoad("shop", "public", "orders")
    for rows in (orders.filter("o_orderstatus = 'F'"), orders):
        load_full(frames({"orders": rows})(load), load, place, DAY, SnapshotWriter(keep_existing))
    return read_snapshot(spark, place, "orders", DAY)


@query("full_replace_rerun", "SELECT * FROM orders")
def full_replace_rerun(spark, folder):
    return _two_runs(spark, folder, keep_existing=False)


@query(
    "full_append_rerun",
    "SELECT * FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT * FROM orders",
)
def full_append_rerun(spark, folder):
    return _two_runs(spark, folder, keep_existing=True)


@query(
    "same_output_fan_in",
    """SELECT c_custkey AS id, c_name AS name FROM customer
       UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def same_output_fan_in(spark, folder):
    """Two loads of one job share an output: the first replaces an old snapshot, the second adds."""
    place, source = layout(spark), parquet_tables(spark, folder)
    old = FullLoad("shop", "public", "customer", "parties", select_sql="c_custkey AS id, 'old' AS name")
    load_full(source(old), old, place, DAY, SnapshotWriter())
    writer = SnapshotWriter()
    for name, select_sql in (
        ("customer", "c_custkey AS id, c_name AS name"),
        ("supplier", "s_suppkey AS id, s_name AS name"),
    ):
        load = FullLoad("shop", "public", name, "parties", select_sql=select_sql)
        load_full(source(load), load, place, DAY, writer)
    return read_snapshot(spark, place, "parties", DAY)


@query("delta_append_rerun", "SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'error'")
def delta_append_rerun(spark, folder):
    """A second run of the same day adds files; nothing is deleted."""
    events, place = table(spark, folder, "events"), layout(spark)
    for run, rows in (("run1", events), ("run2", events.filter("event_type = 'error'"))):
        write_files(rows, f"{place.delta('events', DAY)}/{run}", "overwrite")
    return read_delta_log(spark, place, "events")


@query(
    "snapshot_path",
    """SELECT 'full_load/' || o_orderstatus || '/' || strftime(o_orderdate, '%Y/%m/%d') AS path, COUNT(*) AS n_rows
       FROM orders GROUP BY 1""",
)
def snapshot_path(spark, folder):
    """The folder each order would land in, with its rows."""
    path = folder_column(Layout.full_template, F.col("o_orderstatus"), F.col("o_orderdate"))
    return table(spark, folder, "orders").groupBy(path.alias("path")).agg(F.count("*").alias("n_rows"))


#: Rows that a file holds at most.
FILE_ROWS = 10_000


@query("file_count", f"SELECT COUNT(*) AS n_rows, TRUE AS within_limit, COUNT(*) >= {FILE_ROWS} * 2 AS is_cut FROM lineitem")
def file_count(spark, folder):
    """Files are cut at a row limit; every row is in one of them."""
    lines, place = table(spark, folder, "lineitem"), layout(spark).delta("lineitem", DAY)
    write_files(lines, place, "overwrite", rows_per_file=FILE_ROWS)
    per_file = spark.read.parquet(place).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= FILE_ROWS).alias("within_limit"), (F.count("*") > 1).alias("is_cut"))


_LOG = """SELECT CASE WHEN user_id % 2 = 0 THEN 'FULL' ELSE 'DELTA' END AS load_type, 'web' AS database,
                 'public' AS schema, concat('t', event_id) AS table_name,
                 CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'ok' END AS status,
                 event_id AS n_rows, CASE event_type WHEN 'error' THEN props END AS error
          FROM {events}"""


@query(
    "run_summary_json",
    f"""WITH log AS ({_LOG.format(events="events")})
        SELECT 'run' AS kind, '{DAY}' AS snapshot_date, 'FAILED (full_failed=' || full_failed || ', delta_failed='
               || delta_failed || ')' AS status, CAST(1 AS BIGINT) AS exit_code, NULL AS phase,
               CAST(NULL AS BIGINT) AS tables, CAST(NULL AS BIGINT) AS failed, CAST(NULL AS BIGINT) AS n_rows,
               NULL AS table_ref, NULL AS error
        FROM (SELECT COUNT(*) FILTER (load_type = 'FULL') AS full_failed,
                     COUNT(*) FILTER (load_type = 'DELTA') AS delta_failed FROM log WHERE status = 'failed')
        UNION ALL
        SELECT 'phase', NULL, 'FAILED', NULL, CASE WHEN GROUPING(load_type) = 1 THEN 'ALL' ELSE load_type END,
               COUNT(*), COUNT(*) FILTER (status = 'failed'),
               CAST(SUM(n_rows) FILTER (status = 'ok') AS BIGINT), NULL, NULL
        FROM log GROUP BY ROLLUP (load_type)
        UNION ALL
        SELECT 'failure', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'web.public.' || table_name, error
        FROM log WHERE status = 'failed'""",
)
def run_summary_json(spark, folder):
    """The summary of a run, written as JSON lines and read back."""
    place = layout(spark)
    events = table(spark, folder, "events")
    log = spark.sql(_LOG.format(events="{events}"), events=events)
    written = write_run_summary(log, place, DAY, "job-1", exit_on_failures=True)
    schema = (
        "kind string, snapshot_date string, status string, exit_code bigint, phase string, tables bigint, "
        "failed bigint, n_rows bigint, table_ref string, error string"
    )
    return spark.read.schema(schema).json(written)
