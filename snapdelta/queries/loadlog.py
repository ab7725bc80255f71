"""Row counts, run roll-ups and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdelta.config import DeltaLoad, FullLoad
from snapdelta.operators import metrics
from snapdelta.plans.job import JobSettings, load_log, run_job
from snapdelta.queries.inputs import layout, table
from snapdelta.queries.registry import query
from snapdelta.sources.tables import parquet_tables

# Landed rows by output table: errors went to one of the loader's own tables.
_LANDED = """SELECT CASE WHEN event_type = 'error' THEN '_dlt_loads' ELSE event_type END AS table_name FROM {0}"""


def _landed(spark, folder):
    return spark.sql(_LANDED.format("{events}"), events=table(spark, folder, "events"))


@query(
    "row_counts",
    """SELECT t.table_name, CAST(COUNT(e.event_id) AS BIGINT) AS n_rows
       FROM (SELECT DISTINCT event_type AS table_name FROM events) t
       LEFT JOIN events e ON e.event_type = t.table_name AND e.event_type <> 'error'
       GROUP BY t.table_name""",
)
def row_counts(spark, folder):
    """Rows per output table; the one whose rows all went to the loader's table has a count of zero."""
    tables = table(spark, folder, "events").select(F.col("event_type").alias("table_name")).distinct()
    return metrics.loaded_row_counts(tables, metrics.row_counts(_landed(spark, folder)))


@query("total_rows", "SELECT COUNT(*) AS total_rows FROM events WHERE event_type <> 'error'")
def total_rows(spark, folder):
    return metrics.total_rows(metrics.row_counts(_landed(spark, folder)))


# One load attempt per event.
_LOG = """SELECT CASE WHEN user_id % 2 = 0 THEN 'FULL' ELSE 'DELTA' END AS load_type,
                 CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'ok' END AS status,
                 CASE WHEN event_type NOT IN ('error', 'signup') THEN event_id END AS n_rows
          FROM {0}"""


def _log(spark, folder):
    return spark.sql(_LOG.format("{events}"), events=table(spark, folder, "events"))


@query(
    "run_rollup",
    f"""SELECT CASE WHEN GROUPING(load_type) = 1 THEN 'ALL' ELSE load_type END AS phase, COUNT(*) AS tables,
               COUNT(*) FILTER (status = 'ok') AS ok, COUNT(*) FILTER (status = 'failed') AS failed,
               COUNT(*) FILTER (status = 'skipped') AS skipped,
               CAST(COALESCE(SUM(n_rows) FILTER (status = 'ok'), 0) AS BIGINT) AS n_rows,
               CASE WHEN COUNT(*) FILTER (status = 'failed') = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status
        FROM ({_LOG.format("events")}) GROUP BY ROLLUP (load_type)""",
)
def run_rollup(spark, folder):
    return metrics.run_rollup(_log(spark, folder))


@query(
    "run_status",
    f"""SELECT full_failed, delta_failed,
               'FAILED (full_failed=' || full_failed || ', delta_failed=' || delta_failed || ')' AS status,
               CAST(1 AS BIGINT) AS exit_code
        FROM (SELECT COUNT(*) FILTER (load_type = 'FULL') AS full_failed,
                     COUNT(*) FILTER (load_type = 'DELTA') AS delta_failed
              FROM ({_LOG.format("events")}) WHERE status = 'failed')""",
)
def run_status(spark, folder):
    status = metrics.run_status(_log(spark, folder), exit_on_failures=True)
    return status.withColumn("exit_code", F.col("exit_code").cast("bigint"))


@query(
    "tables_by_database",
    """SELECT p_brand AS database, COUNT(*) AS tables, ARG_MIN(p_name, p_partkey) AS first_table,
              ARG_MAX(p_name, p_partkey) AS last_table
       FROM part GROUP BY p_brand""",
)
def tables_by_database(spark, folder):
    configs = table(spark, folder, "part").selectExpr(
        "p_brand AS database", "p_name AS `table`", "p_partkey AS ordinal"
    )
    return metrics.database_groups(configs)


@query(
    "config_order",
    """SELECT p_brand AS database, p_name AS "table", p_partkey AS ordinal FROM part ORDER BY p_brand, p_partkey""",
)
def config_order(spark, folder):
    configs = table(spark, folder, "part").selectExpr(
        "p_brand AS database", "p_name AS `table`", "p_partkey AS ordinal"
    )
    return metrics.in_database_order(configs)


@query(
    "multi_table_load",
    """SELECT 'FULL' AS load_type, 'shop' AS database, 'orders' AS table_name, 'ok' AS status, COUNT(*) AS n_rows
         FROM orders
       UNION ALL SELECT 'FULL', 'shop', 'broken', 'failed', NULL
       UNION ALL SELECT 'FULL', 'shop', 'parties', 'ok', COUNT(*) FROM customer
       UNION ALL SELECT 'FULL', 'shop', 'parties', 'ok', COUNT(*) FROM supplier
       UNION ALL SELECT 'DELTA', 'web', 'events', 'ok', COUNT(*) FROM events WHERE ts > TIMESTAMP '2024-01-05'
       UNION ALL SELECT 'DELTA', 'shop', 'lineitem', 'ok', COUNT(*) FROM lineitem""",
)
def multi_table_load(spark, folder):
    """Six loads in one job: a broken one fails alone and the second phase still runs."""
    full = [
        FullLoad("shop", "public", "orders"),
        FullLoad("shop", "public", "nation", "broken", columns=("no_such_column",)),
        FullLoad("shop", "public", "customer", "parties", select_sql="c_custkey AS id, c_name AS name"),
        FullLoad("shop", "public", "supplier", "parties", select_sql="s_suppkey AS id, s_name AS name"),
        FullLoad("shop", "public", "region", enabled=False),
    ]
    delta = [
        DeltaLoad("web", "public", "events", cursor_column="ts", initial_value="2024-01-05"),
        DeltaLoad("shop", "public", "lineitem", cursor_column="l_shipdate"),
    ]
    settings = JobSettings(day="2024/01/31")
    outcomes = run_job(spark, parquet_tables(spark, folder), layout(spark), settings, full, delta)
    return load_log(spark, outcomes).select("load_type", "database", "table_name", "status", "n_rows")
