"""Table scans and reads of landed data."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdelta.config import FullLoad
from snapdelta.plans.loads import load_full
from snapdelta.queries.inputs import layout, table
from snapdelta.queries.registry import query
from snapdelta.sinks.landing import SnapshotWriter, write_files
from snapdelta.sources.landed import read_delta_log, read_snapshot
from snapdelta.sources.slices import FrameCounts, plan_slices, sliced
from snapdelta.sources.tables import frames, parquet_tables


@query("scan_full_table", "SELECT * FROM orders")
def scan_full_table(spark, folder):
    return parquet_tables(spark, folder)(FullLoad("shop", "public", "orders"))


@query("scan_columns", "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def scan_columns(spark, folder):
    columns = ("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return parquet_tables(spark, folder)(FullLoad("shop", "public", "lineitem", columns=columns))


@query(
    "scan_select_sql",
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_no,
              COALESCE(l_returnflag, '') AS return_flag, l_quantity * l_extendedprice AS gross,
              l_shipdate AS shipped_at
       FROM lineitem""",
)
def scan_select_sql(spark, folder):
    select_sql = """
      CAST(l_orderkey AS string) AS order_id,
      l_linenumber AS line_no,
      COALESCE(l_returnflag, '') AS return_flag,
      l_quantity * l_extendedprice AS gross,
      l_shipdate AS shipped_at
    """
    return parquet_tables(spark, folder)(FullLoad("shop", "public", "lineitem", select_sql=select_sql))


@query("partitioned_read", "SELECT * FROM lineitem")
def partitioned_read(spark, folder):
    """The table read once per condition of its slice plan, as a database table is; every row comes once."""
    lines = parquet_tables(spark, folder)(FullLoad("shop", "public", "lineitem"))
    return sliced(lines, plan_slices(FrameCounts(lines), ("l_suppkey", "l_orderkey"), 8))


@query("read_snapshot", "SELECT * FROM orders")
def snapshot_of_one_day(spark, folder):
    """Two days' snapshots side by side; only the second is read."""
    orders = table(spark, folder, "orders")
    place, load = layout(spark), FullLoad("shop", "public", "orders")
    days = {"2024/01/01": orders.filter("o_orderstatus = 'F'"), "2024/01/02": orders}
    for day, rows in days.items():
        load_full(frames({"orders": rows})(load), load, place, day, SnapshotWriter())
    return read_snapshot(spark, place, "orders", "2024/01/02")


@query(
    "read_delta_log",
    "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-11' OR ts >= TIMESTAMP '2024-01-21'",
)
def two_days_of_a_delta_log(spark, folder):
    """Three days' runs are landed; the folders of two days are read."""
    events = table(spark, folder, "events")
    place = layout(spark)
    early, late = F.lit("2024-01-11").cast("timestamp_ntz"), F.lit("2024-01-21").cast("timestamp_ntz")
    runs = {
        "2024/01/10": events.filter(F.col("ts") < early),
        "2024/01/20": events.filter((F.col("ts") >= early) & (F.col("ts") < late)),
        "2024/01/30": events.filter(F.col("ts") >= late),
    }
    for day, rows in runs.items():
        write_files(rows, f"{place.delta('events', day)}/run", "overwrite")
    return read_delta_log(spark, place, "events", ["2024/01/10", "2024/01/30"])
