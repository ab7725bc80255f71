"""Column types that stay the same across batches."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from snapdelta.config import FullLoad
from snapdelta.operators.projection import nullable
from snapdelta.operators.schema import REJECTED, conform, merge_batches, schema_difference, stable_text
from snapdelta.plans.loads import load_delta, load_full
from snapdelta.queries.inputs import EVENT_LOAD, layout, table
from snapdelta.queries.registry import query
from snapdelta.sinks.landing import SnapshotWriter
from snapdelta.sources.landed import read_delta_log, read_snapshot
from snapdelta.sources.tables import frames, parquet_tables
from snapdelta.state.watermark import WatermarkTable

_ISO = """strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({0}) % 1000000 = 0 THEN ''
          ELSE strftime({0}, '.%f') END"""
_SENT = "CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN {second} ELSE ts END"


@query(
    "stable_strings",
    f"""SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS sender_user_id,
               COALESCE({_ISO.format("sent")}, '') AS email_send_at, sent
        FROM (SELECT *, {_SENT.format(second="DATE_TRUNC('second', ts)")} AS sent FROM events)""",
)
def stable_strings(spark, folder):
    """Named columns become text with blanks for NULL; the copy under another name stays as it is."""
    sent = F.expr(_SENT.format(second="CAST(DATE_TRUNC('second', ts) AS timestamp_ntz)"))
    rows = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("sender_user_id"),
        sent.alias("email_send_at"),
        sent.alias("sent"),
    )
    return stable_text(rows)


_ORDER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("price", T.DecimalType(18, 2)),
        T.StructField("placed_at", T.TimestampNTZType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("note", T.StringType()),
    ]
)


@query(
    "conform_schema",
    """SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18, 2)) AS price,
              o_orderdate AS placed_at, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS INTEGER) END AS rank,
              CAST(NULL AS VARCHAR) AS note, CASE WHEN o_orderstatus = 'P' THEN '{"rank":"pending"}' END AS rejected
       FROM orders""",
)
def conform_schema(spark, folder):
    """Text columns put into declared types; a value that does not fit is NULL and told apart, a missing column is NULL."""
    drifted = table(spark, folder, "orders").selectExpr(
        "CAST(o_orderdate AS string) AS placed_at",
        "CAST(CAST(o_totalprice AS decimal(18, 2)) AS string) AS price",
        "CAST(o_orderkey AS string) AS id",
        "CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE CAST(o_orderkey AS string) END AS rank",
        "o_orderpriority AS undeclared",
    )
    found = conform(drifted, _ORDER_SCHEMA, on_bad_value="reject")
    return found.select(*_ORDER_SCHEMA.fieldNames(), F.to_json(REJECTED).alias("rejected"))


_DECLARED = FullLoad(
    "web",
    "public",
    "events",
    select_sql="event_id, CASE event_type WHEN 'error' THEN props ELSE CAST(user_id AS string) END AS number, CAST(ts AS string) AS seen_at",
    column_types=(("number", "bigint"), ("seen_at", "timestamp_ntz")),
)


@query(
    "rejected_values",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS number, ts AS seen_at,
              CASE event_type WHEN 'error' THEN '{"number":"' || replace(props, '"', '\\"') || '"}' END AS _rejected
       FROM events""",
)
def rejected_values(spark, folder):
    """A load whose config declares types: what does not fit is landed beside the row, not lost."""
    place = layout(spark)
    load_full(parquet_tables(spark, folder)(_DECLARED), _DECLARED, place, "2024/01/31", SnapshotWriter())
    return read_snapshot(spark, place, "events", "2024/01/31")


@query(
    "delta_log_new_column",
    """SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id, CAST(CASE WHEN ts > TIMESTAMP '2024-01-11' AND ts <= TIMESTAMP '2024-01-21' THEN event_id / 4.0 ELSE event_id END AS DOUBLE) AS amount,
              CASE WHEN ts > TIMESTAMP '2024-01-11' THEN event_type END AS event_type,
              CASE WHEN ts > TIMESTAMP '2024-01-21' THEN props END AS props
       FROM events""",
)
def delta_log_new_column(spark, folder):
    """Three runs: the second brings a column and a wider number, the third a column and a text for a number."""
    events, place = table(spark, folder, "events"), layout(spark)
    watermarks = WatermarkTable(spark, place.state)
    runs = [
        ("2024-01-11", ["CAST(user_id AS int) AS user_id", "CAST(event_id AS int) AS amount"]),
        ("2024-01-21", ["user_id", "CAST(event_id / 4 AS decimal(14,2)) AS amount", "event_type"]),
        ("2100-01-01", ["CAST(user_id AS string) AS user_id", "event_id AS amount", "event_type", "props"]),
    ]
    for nth, (until, columns) in enumerate(runs, 1):
        rows = events.filter(F.col("ts") <= F.lit(until).cast("timestamp_ntz")).selectExpr("event_id", "ts", *columns)
        load_delta(frames({"events": rows})(EVENT_LOAD), EVENT_LOAD, place, f"2024/02/0{nth}", watermarks, run_id=f"run{nth}")
    return read_delta_log(spark, place, "events").withColumn("amount", F.col("amount").cast("double"))


@query("nullable_schema", "SELECT c_custkey, c_name, 'retail' AS kind FROM customer")
def nullable_schema(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", F.lit("retail").alias("kind"))
    return nullable(rows)


@query(
    "schema_diff",
    """WITH declared AS (SELECT p_name AS name, MIN(p_type) AS type FROM part WHERE p_size <= 40 GROUP BY p_name),
            found AS (SELECT p_name AS name, MAX(p_type) AS type FROM part WHERE p_brand <> 'Brand#7' GROUP BY p_name)
       SELECT name, d.type AS left_type, f.type AS right_type,
              CASE WHEN d.type IS NULL THEN 'missing_left' WHEN f.type IS NULL THEN 'missing_right'
                   ELSE 'type_differs' END AS status
       FROM declared d FULL JOIN found f USING (name) WHERE d.type IS DISTINCT FROM f.type""",
)
def schema_diff(spark, folder):
    """Two name-and-type catalogs gathered from the parts, compared."""
    parts = table(spark, folder, "part")
    declared = parts.filter("p_size <= 40").groupBy(F.col("p_name").alias("name"))
    found = parts.filter("p_brand <> 'Brand#7'").groupBy(F.col("p_name").alias("name"))
    return schema_difference(declared.agg(F.min("p_type").alias("type")), found.agg(F.max("p_type").alias("type")))


@query(
    "merge_batches",
    """SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS customer,
              CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority
       FROM orders""",
)
def merged_batches(spark, folder):
    """Three batches whose key changed type and one of which has a new column."""
    orders = table(spark, folder, "orders")
    batches = [
        orders.filter("o_orderstatus = 'O'").selectExpr("CAST(o_orderkey AS int) AS id", "o_custkey AS customer"),
        orders.filter("o_orderstatus = 'P'").selectExpr(
            "CAST(o_orderkey AS string) AS id", "CAST(o_custkey AS string) AS customer"
        ),
        orders.filter("o_orderstatus = 'F'").selectExpr(
            "o_orderkey AS id", "o_custkey AS customer", "o_orderpriority AS priority"
        ),
    ]
    declared = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("customer", T.StringType()),
            T.StructField("priority", T.StringType()),
        ]
    )
    return merge_batches(batches, declared)
