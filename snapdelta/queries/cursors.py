"""Incremental filters, floors, literals and bounds."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from snapdelta.config import enabled_loads
from snapdelta.operators.compact import union_outputs
from snapdelta.operators.cursor import (
    bounds_above,
    coerce_cursor_columns,
    describe_extract,
    first_floor,
    in_cursor_order,
)
from snapdelta.plans.loads import extract, load_delta
from snapdelta.queries.inputs import (
    EVENT_LOAD,
    LINE_LOAD,
    ORDER_LINES,
    ORDER_LINES_WITH_GAPS,
    layout,
    order_lines,
    order_lines_with_gaps,
    table,
)
from snapdelta.queries.registry import query
from snapdelta.sources.landed import log_bounds, read_above, read_delta_log
from snapdelta.sources.tables import frames, parquet_tables
from snapdelta.state.watermark import WatermarkTable

MARK = datetime(2000, 1, 1)

_WITH_CURSOR = f"SELECT *, GREATEST(created_at, updated_at) AS row_cursor FROM ({ORDER_LINES})"
_GAPS_WITH_CURSOR = f"SELECT *, GREATEST(created_at, updated_at) AS row_cursor FROM ({ORDER_LINES_WITH_GAPS})"


def _lines(spark, folder):
    return frames({"order_lines": order_lines(spark, folder)})(LINE_LOAD)


def _lines_with_gaps(spark, folder):
    return frames({"order_lines": order_lines_with_gaps(spark, folder)})(LINE_LOAD)


@query("delta_filter", f"SELECT * FROM ({_WITH_CURSOR}) WHERE row_cursor > TIMESTAMP '2000-01-01'")
def delta_filter(spark, folder):
    """Scan, project, derive the cursor, filter above the mark, land as Parquet, read back."""
    place = layout(spark)
    load = replace(LINE_LOAD, initial_value="2000-01-01T00:00:00")
    load_delta(_lines(spark, folder), load, place, "2024/01/01", WatermarkTable(spark, place.state))
    return read_delta_log(spark, place, "order_lines")


@query("delta_first_run", _GAPS_WITH_CURSOR)
def delta_first_run(spark, folder):
    """Without a saved cursor and without a floor nothing is filtered; rows without a cursor stay."""
    return extract(_lines_with_gaps(spark, folder), LINE_LOAD, None)


@query(
    "null_cursor_dropped",
    f"SELECT * FROM ({_GAPS_WITH_CURSOR}) WHERE row_cursor > TIMESTAMP '1970-01-01'",
)
def null_cursor_dropped(spark, folder):
    """Any floor, however low, drops the rows without a cursor. The rows come from a landed log, whose scan takes the
    filter and opens only files whose bounds reach above the floor."""
    place = layout(spark)
    load_delta(_lines_with_gaps(spark, folder), LINE_LOAD, place, "2024/01/01", WatermarkTable(spark, place.state), manifest=True)
    return read_above(spark, place, LINE_LOAD, datetime(1970, 1, 1))


@query("increment_of_log", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-21'")
def increment_of_log(spark, folder):
    """The rows of a log above a mark; the files of runs that end below it are not opened."""
    return read_above(spark, _log_of_events(spark, folder), EVENT_LOAD, datetime(2024, 1, 21))


def _log_of_events(spark, folder):
    """Three runs of the events, each with the bounds of its files."""
    events, place = table(spark, folder, "events"), layout(spark)
    watermarks = WatermarkTable(spark, place.state)
    for nth, until in enumerate(("2024-01-11", "2024-01-21", "2100-01-01"), 1):
        rows = events.filter(F.col("ts") <= F.lit(until).cast("timestamp_ntz"))
        load_delta(frames({"events": rows})(EVENT_LOAD), EVENT_LOAD, place, f"2024/02/0{nth}", watermarks, run_id=f"run{nth}", manifest=True)
    return place


@query("log_bounds", "SELECT MIN(ts) AS lo, MAX(ts) AS hi, COUNT(*) AS n_rows FROM events")
def bounds_of_log(spark, folder):
    """Bounds and rows of a whole log from the manifest; no landed row is read."""
    return log_bounds(spark, _log_of_events(spark, folder), "events", "ts")


@query(
    "delta_floor",
    """SELECT 'lineitem' AS table_name, l_orderkey AS id, l_shipdate AS cursor_value FROM lineitem
         WHERE l_shipdate > TIMESTAMP '1999-06-01'
       UNION ALL SELECT 'orders', o_orderkey, o_orderdate FROM orders
         WHERE o_orderdate > TIMESTAMP '1998-01-01'
       UNION ALL SELECT 'events', event_id, ts FROM events""",
)
def delta_floor(spark, folder):
    """A table's own floor wins over the general one; a blank one switches it off."""
    source = parquet_tables(spark, folder)
    general = "1998-01-01 00:00:00"

    def load(name, key, cursor, floor):
        named = replace(EVENT_LOAD, table=name, select_sql=f"{key} AS id, {cursor} AS cursor_value")
        return replace(named, cursor_column="cursor_value", initial_value=floor)

    loads = [
        load("lineitem", "l_orderkey", "l_shipdate", "1999-06-01"),
        load("orders", "o_orderkey", "o_orderdate", None),
        load("events", "event_id", "ts", "  "),
    ]
    extracts = [extract(source(each), each, first_floor(each.initial_value, general)) for each in loads]
    named = [rows.withColumn("table_name", F.lit(each.table)) for rows, each in zip(extracts, loads)]
    return union_outputs(named)


@query(
    "coerce_cursor_values",
    """SELECT event_id,
              CASE WHEN event_id % 8 IN (0, 1) THEN 'integer' WHEN event_id % 8 IN (2, 3, 4, 5) THEN 'timestamp'
                   WHEN event_id % 8 = 6 THEN 'text' ELSE 'none' END AS kind,
              CASE event_id % 8 WHEN 0 THEN event_id WHEN 1 THEN -event_id END AS integer_value,
              CASE event_id % 8 WHEN 2 THEN DATE_TRUNC('day', ts)::TIMESTAMP WHEN 3 THEN ts WHEN 4 THEN ts
                   WHEN 5 THEN ts - INTERVAL 2 HOUR END AS timestamp_value,
              CASE event_id % 8 WHEN 6 THEN event_type END AS text_value
       FROM events""",
)
def coerce_cursor_values(spark, folder):
    """Cursor texts of every kind, told apart and converted."""
    raw = F.expr(
        """CASE event_id % 8
             WHEN 0 THEN concat(' ', event_id)
             WHEN 1 THEN concat('-', event_id)
             WHEN 2 THEN date_format(ts, 'yyyy-MM-dd')
             WHEN 3 THEN CAST(ts AS string)
             WHEN 4 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
             WHEN 5 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'")
             WHEN 6 THEN event_type
             ELSE '  ' END"""
    )
    values = coerce_cursor_columns(raw).alias("value")
    return table(spark, folder, "events").select("event_id", values).select("event_id", "value.*")


@query(
    "select_load_configs",
    """SELECT p_partkey AS ordinal, p_brand AS database, p_name AS "table",
              CASE p_type WHEN 'ECONOMY' THEN p_name WHEN 'PROMO' THEN p_name ELSE p_type || '_out' END AS output_name
       FROM part WHERE p_size > 10 AND p_brand = 'Brand#7'""",
)
def select_load_configs(spark, folder):
    """Config rows kept by flag and database alias, with the name each one lands under."""
    configs = table(spark, folder, "part").selectExpr(
        "p_partkey AS ordinal",
        "p_brand AS database",
        "p_name AS `table`",
        "p_size > 10 AS enabled",
        "CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'PROMO' THEN NULL ELSE concat(p_type, '_out') END AS output_table_name",
    )
    kept = enabled_loads(configs, database="Brand#7")
    return kept.select("ordinal", "database", "table", "output_name")


@query("ordered_extract", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10' ORDER BY ts")
def ordered_extract(spark, folder):
    rows = parquet_tables(spark, folder)(EVENT_LOAD)
    return in_cursor_order(extract(rows, EVENT_LOAD, datetime(2024, 1, 10)), "ts", globally=True)


@query(
    "cursor_bounds",
    f"""WITH extracts AS ({_WITH_CURSOR})
        SELECT 'above_mark' AS extract, MIN(row_cursor) AS lo, MAX(row_cursor) AS hi
          FROM extracts WHERE row_cursor > TIMESTAMP '2000-01-01'
        UNION ALL SELECT 'empty', MIN(row_cursor), MAX(row_cursor)
          FROM extracts WHERE row_cursor > TIMESTAMP '2100-01-01'""",
)
def bounds_of_extracts(spark, folder):
    """Both extracts' bounds from one pass over the rows."""
    return bounds_above(_lines(spark, folder), "row_cursor", {"above_mark": MARK, "empty": datetime(2100, 1, 1)}, "extract")


@query(
    "extract_description",
    """WITH described AS (
         SELECT 'orders' AS table_name, 'full_table' AS mode, NULL AS cutoff,
                strftime(MIN(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS lo,
                strftime(MAX(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS hi FROM orders
         UNION ALL SELECT 'events', 'incremental', '2024-01-10T00:00:00',
                strftime(MIN(ts), '%Y-%m-%dT%H:%M:%S.%f'), strftime(MAX(ts), '%Y-%m-%dT%H:%M:%S.%f')
                FROM events WHERE ts > TIMESTAMP '2024-01-10'
         UNION ALL SELECT 'lineitem', 'incremental', '2100-01-01T00:00:00', NULL, NULL)
       SELECT *, CASE table_name
           WHEN 'orders' THEN 'full_table column=o_orderdate loading_all_rows min=' || lo || ' max=' || hi
           WHEN 'events' THEN 'incremental column=ts cutoff_exclusive=' || cutoff || ' min=' || lo || ' max=' || hi
           ELSE 'incremental column=l_shipdate cutoff_exclusive=' || cutoff || ' matched_rows=0' END AS description
       FROM described""",
)
def extract_description(spark, folder):
    source = parquet_tables(spark, folder)
    cases = [
        ("orders", "o_orderdate", None),
        ("events", "ts", datetime(2024, 1, 10)),
        ("lineitem", "l_shipdate", datetime(2100, 1, 1)),
    ]
    described = []
    for name, cursor, mark in cases:
        load = replace(EVENT_LOAD, table=name, cursor_column=cursor)
        rows = extract(source(load), load, mark)
        described.append(describe_extract(rows, cursor, mark).withColumn("table_name", F.lit(name)))
    return union_outputs(described)


@query(
    "greatest_cursor",
    f"""SELECT order_id, line_no, part_id, GREATEST(created_at, updated_at) AS row_cursor
        FROM ({ORDER_LINES_WITH_GAPS})""",
)
def greatest_cursor(spark, folder):
    """NULL parts are skipped; the cursor is NULL only when all are."""
    return _lines_with_gaps(spark, folder).select("order_id", "line_no", "part_id", "row_cursor")
