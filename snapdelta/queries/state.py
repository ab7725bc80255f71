"""Saved cursors: keys, lookups, advances, resets."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdelta.plans.loads import load_delta
from snapdelta.queries.inputs import EVENT_LOAD, layout, table
from snapdelta.queries.registry import query
from snapdelta.sources.tables import parquet_tables
from snapdelta.state.watermark import WatermarkTable, advanced, current_watermarks, state_key_column


@query(
    "state_key",
    """SELECT page_id, '-land.ing-|delta|' || split_part(url, '/', 3) || '|' || replace(replace(html[1:3], '\\', '\\\\'), '|', '\\|')
              || '|' || split_part(url, '/', 4) AS state_key
       FROM pages""",
)
def state_key(spark, folder):
    """Hosts as database names and paths as table names, kept as they are: no two of them share a key."""
    key = state_key_column(
        F.lit("-land.ing-"),
        F.lit("DELTA"),
        F.split_part("url", F.lit("/"), F.lit(3)),
        F.substring("html", 1, 3),
        F.split_part("url", F.lit("/"), F.lit(4)),
    )
    return table(spark, folder, "pages").select("page_id", key.alias("state_key"))


def _history(spark, folder):
    """A state history: one key per user, one row per event, an error forgets the cursor."""
    return table(spark, folder, "events").selectExpr(
        "concat('web__', user_id) AS state_key",
        "event_id AS version",
        "CASE WHEN event_type = 'error' THEN 'reset' ELSE 'advance' END AS event",
        "CASE WHEN event_type <> 'error' THEN CAST(ts AS string) END AS last_value",
        "'timestamp_ntz' AS value_type",
    )


_NEWEST = """SELECT 'web__' || user_id AS state_key, MAX(event_id) AS version,
                    ARG_MAX(event_type, event_id) AS event, ARG_MAX(ts, event_id) AS ts
             FROM events GROUP BY user_id"""


@query(
    "watermark_lookup",
    f"""SELECT state_key, CASE WHEN event <> 'error' THEN CAST(ts AS VARCHAR) END AS last_value
        FROM ({_NEWEST})""",
)
def watermark_lookup(spark, folder):
    return current_watermarks(_history(spark, folder)).select("state_key", "last_value")


@query("watermark_reset", f"SELECT state_key, version FROM ({_NEWEST}) WHERE event = 'error'")
def watermark_reset(spark, folder):
    """Keys whose newest state is a reset: their next run starts from the floor."""
    newest = current_watermarks(_history(spark, folder))
    return newest.filter(F.col("last_value").isNull()).select("state_key", "version")


@query(
    "watermark_advance",
    """WITH runs AS (SELECT user_id, ts AS hi, event_type, CAST(props ->> 'k' AS BIGINT) % 5 AS n_rows FROM events),
            saved AS (SELECT user_id, MIN(ts) + INTERVAL 10 DAY AS saved FROM events GROUP BY user_id)
       SELECT 'web__' || user_id AS state_key,
              GREATEST(saved, MAX(hi) FILTER (event_type <> 'error' AND n_rows > 0)) AS last_value
       FROM runs JOIN saved USING (user_id) GROUP BY user_id, saved""",
)
def watermark_advance(spark, folder):
    """One run per event: only successful runs with rows move a key's cursor, and never back."""
    events = table(spark, folder, "events")
    key = F.concat(F.lit("web__"), "user_id").alias("state_key")
    runs = events.select(
        key,
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        (F.get_json_object("props", "$.k").cast("bigint") % 5).alias("n_rows"),
        F.col("ts").alias("hi"),
    )
    first = F.min("ts") + F.expr("INTERVAL 10 DAYS")
    saved = events.groupBy(key).agg(first.alias("last_value"))
    return advanced(saved, runs)


@query(
    "state_restore",
    """SELECT 'snapdelta|delta|web|public|events' AS state_key, CAST(MAX(ts) AS VARCHAR) AS last_value,
              'timestamp_ntz' AS value_type, COUNT(*) AS n_rows FROM events""",
)
def state_restore(spark, folder):
    """A load saves its cursor beside the data; a new reader of the same root finds it."""
    place = layout(spark)
    rows = parquet_tables(spark, folder)(EVENT_LOAD)
    load_delta(rows, EVENT_LOAD, place, "2024/01/31", WatermarkTable(spark, place.state), run_id="run1")
    found = WatermarkTable(spark, place.state).history()
    return found.select("state_key", "last_value", "value_type", "n_rows")
