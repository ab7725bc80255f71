"""Time the headline queries on whole tables and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs per query
(the median counts; one untimed run warms up first).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapdelta.config import DeltaLoad, FullLoad
from snapdelta.operators.compact import latest_per_key, union_outputs
from snapdelta.plans.loads import extract, load_delta, load_full
from snapdelta.queries import QUERIES
from snapdelta.queries.inputs import layout, order_lines
from snapdelta.sinks.landing import SnapshotWriter
from snapdelta.sources.landed import read_delta_log, read_snapshot
from snapdelta.sources.tables import frames, parquet_tables, projected
from snapdelta.state.watermark import WatermarkTable

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
DAY = "2024/01/31"

LINES = DeltaLoad(
    "shop",
    "public",
    "order_lines",
    columns=("order_id", "line_no", "part_id", "quantity", "price", "created_at", "updated_at"),
    cursor_column="row_cursor",
    cursor_expression="GREATEST(created_at, updated_at)",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_through(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def cases(spark: SparkSession) -> dict:
    place = layout(spark)
    source = parquet_tables(spark, FOLDER)
    lines = FullLoad(
        "shop",
        "public",
        "lineitem",
        select_sql="CAST(l_orderkey AS string) AS order_id, l_linenumber AS line_no, "
        "COALESCE(l_returnflag, '') AS flag, l_quantity AS quantity, l_extendedprice AS price, "
        "CAST(l_shipdate AS string) AS shipped_at",
    )

    # The source table of the delta cases: order lines with both times, landed once.
    load_full(order_lines(spark, FOLDER), FullLoad("shop", "public", "order_lines"), place, DAY, SnapshotWriter())
    stored = read_snapshot(spark, place, "order_lines", DAY)
    rows = projected(stored, LINES)
    mark = rows.select(F.percentile_approx(F.unix_micros(F.col("row_cursor").cast("timestamp")), 0.9)).first()[0]
    mark = datetime(1970, 1, 1) + (datetime.fromtimestamp(mark / 1e6) - datetime.fromtimestamp(0))
    at_mark = DeltaLoad(**{**LINES.__dict__, "initial_value": mark})

    # A delta log with repeats: two runs of a day, the second over half of the rows again.
    twice = layout(spark)
    for run, seen in (("run1", stored), ("run2", stored.filter("quantity > 25"))):
        load_full(seen, FullLoad("shop", "public", "log"), twice, f"{DAY}/{run}", SnapshotWriter())
    log = union_outputs([read_snapshot(spark, twice, "log", f"{DAY}/{run}") for run in ("run1", "run2")])

    def snapshot():
        load_full(source(lines), lines, place, DAY, SnapshotWriter())

    def delta_run():
        here = layout(spark)
        load_delta(frames({"order_lines": stored})(at_mark), at_mark, here, DAY, WatermarkTable(spark, here.state))
        return read_delta_log(spark, here, "order_lines")

    timed = {
        "scan_project_write": snapshot,
        "delta_filter_greatest": lambda: run_through(rows.filter(F.col("row_cursor") > F.lit(mark).cast("timestamp_ntz"))),
        "delta_filter_or": lambda: run_through(extract(rows, LINES, mark)),
        "delta_run_above_p90": delta_run,
        "latest_per_key_log": lambda: run_through(latest_per_key(log, ["order_id", "line_no"], "updated_at")),
    }
    for name in (
        "latest_per_key",
        "repeated_keys",
        "current_state",
        "current_state_unique_snapshot",
        "cursor_bounds",
        "incremental_runs",
        "full_replace_rerun",
        "stable_strings",
        "number_text",
        "array_literal_text",
        "collapse_whitespace",
        "json_field",
        "classify_failure",
        "failure_digest",
        "run_rollup",
        "watermark_lookup",
        "schema_diff",
    ):
        timed[name] = lambda name=name: run_through(QUERIES[name](spark, FOLDER))
    return timed


def main() -> None:
    spark = session()
    seconds = {}
    wanted = set(sys.argv[1:])
    for name, run in cases(spark).items():
        if wanted and name not in wanted:
            continue
        run()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 4)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "spark": spark.version,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
