"""Loads over several runs, in batches and as a file stream."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from snapdelta.operators.compact import late_rows
from snapdelta.plans.loads import load_delta
from snapdelta.queries.inputs import EVENT_LOAD, layout, table
from snapdelta.queries.registry import query
from snapdelta.session import work_folder
from snapdelta.sinks.landing import write_files
from snapdelta.sources.landed import read_delta_log
from snapdelta.sources.tables import frames
from snapdelta.state.watermark import WatermarkTable
from snapdelta.streaming.landing import file_stream, land_stream

FLOOR = "2024-01-03T00:00:00"
# What the source shows at the time of each run.
_SEEN_UNTIL = ("2024-01-11", "2024-01-21", "2100-01-01")


def _runs(spark, folder, seen_until):
    events, place = table(spark, folder, "events"), layout(spark)
    watermarks = WatermarkTable(spark, place.state)
    landed = []
    for number, until in enumerate(seen_until, 1):
        visible = events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
        rows = frames({"events": visible})(EVENT_LOAD)
        landed.append(
            load_delta(rows, EVENT_LOAD, place, f"2024/02/0{number}", watermarks, floor=FLOOR, run_id=f"run{number}")
        )
    return place, landed


@query("incremental_runs", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-03'")
def incremental_runs(spark, folder):
    """Three runs over a growing source: together they hold each row above the floor once."""
    place, _ = _runs(spark, folder, _SEEN_UNTIL)
    return read_delta_log(spark, place, "events")


@query(
    "empty_increment",
    """SELECT CAST(1 AS BIGINT) AS run, 'incremental' AS mode, COUNT(*) AS n_rows, TIMESTAMP '2024-01-03' AS cutoff
         FROM events WHERE ts > TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-21'
       UNION ALL SELECT 2, 'incremental', 0, MAX(ts) FROM events WHERE ts < TIMESTAMP '2024-01-21'
       UNION ALL SELECT 3, 'incremental', COUNT(*) FILTER (ts >= TIMESTAMP '2024-01-21'),
                 MAX(ts) FILTER (ts < TIMESTAMP '2024-01-21') FROM events""",
)
def empty_increment(spark, folder):
    """A run that finds nothing succeeds and leaves the cursor where it was."""
    _, landed = _runs(spark, folder, ("2024-01-21", "2024-01-21", "2100-01-01"))
    rows = [(n, each.mode, each.n_rows, each.cutoff) for n, each in enumerate(landed, 1)]
    return spark.createDataFrame(rows, "run bigint, mode string, n_rows bigint, cutoff timestamp_ntz")


@query(
    "late_rows",
    """SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL ELSE DATE_TRUNC('day', ts)::TIMESTAMP END AS ts
       FROM events WHERE event_type = 'signup' OR DATE_TRUNC('day', ts) <= TIMESTAMP '2024-01-15'""",
)
def rows_that_came_late(spark, folder):
    """Arrivals at or below the mark, ties included, and those without a cursor."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    arrivals = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") != "signup", day).alias("ts")
    )
    return late_rows(arrivals, "ts", datetime(2024, 1, 15))


@query("late_rows_landed", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-03'")
def late_rows_landed(spark, folder):
    """Errors of the ten days before each mark show up one run late; a run that looks back lands them, each row once."""
    events, place = table(spark, folder, "events"), layout(spark)
    watermarks = WatermarkTable(spark, place.state)
    load = replace(EVENT_LOAD, keys=("event_id",), late_window="11 days")
    for number, until in enumerate((*_SEEN_UNTIL, "2100-01-02"), 1):
        until = F.lit(until).cast("timestamp_ntz")
        late = (F.col("event_type") == "error") & (F.col("ts") >= until - F.expr("INTERVAL 10 DAYS"))
        rows = frames({"events": events.filter((F.col("ts") < until) & ~late)})(load)
        load_delta(rows, load, place, f"2024/02/0{number}", watermarks, floor=FLOOR, run_id=f"run{number}", manifest=True)
    return read_delta_log(spark, place, "events")


@query("stream_equals_batch", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-03'")
def stream_equals_batch(spark, folder):
    """Source files that arrive between two calls of the stream; each is read once."""
    events, place = table(spark, folder, "events"), layout(spark)
    arrived, checkpoint = work_folder(spark, "arrived"), work_folder(spark, "stream-state")
    watermarks = WatermarkTable(spark, place.state)
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    for name, rows in (("a", events.filter(F.col("ts") < cut)), ("b", events.filter(F.col("ts") >= cut))):
        write_files(rows, f"{arrived}/{name}", "overwrite")
        source = file_stream(spark, arrived, events.schema)
        land_stream(
            source, EVENT_LOAD, place, "2024/02/01", checkpoint, watermarks, floor=FLOOR
        ).awaitTermination()
    return read_delta_log(spark, place, "events")
