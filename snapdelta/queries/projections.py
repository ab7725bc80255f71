"""Projection forms, renames, pruning and compaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdelta.config import FullLoad
from snapdelta.operators.compact import current_state, latest_per_key, repeated_keys, union_outputs
from snapdelta.operators.projection import prune
from snapdelta.queries.inputs import LINE_LOAD, ORDER_LINES, order_lines, table
from snapdelta.queries.registry import query
from snapdelta.sinks.bucketed import BucketedLog
from snapdelta.sources.tables import frames, parquet_tables


@query(
    "projection_precedence",
    """SELECT 'select_sql' AS form, CAST(c_custkey AS BIGINT) AS c_custkey, 'id ' || c_custkey AS label,
              NULL AS c_name, NULL AS c_mktsegment FROM customer
       UNION ALL SELECT 'columns', c_custkey, NULL, c_name, NULL FROM customer
       UNION ALL SELECT 'all', c_custkey, NULL, c_name, c_mktsegment FROM customer""",
)
def projection_precedence(spark, folder):
    """The same table three times: a select list wins over columns, a blank one does not."""
    source = parquet_tables(spark, folder)
    columns = ("c_custkey", "c_name")
    select_sql = "c_custkey, concat('id ', c_custkey) AS label"
    loads = [
        FullLoad("shop", "public", "customer", columns=columns, select_sql=select_sql),
        FullLoad("shop", "public", "customer", columns=columns, select_sql="  \n"),
        FullLoad("shop", "public", "customer", output_columns=("c_custkey", "c_name", "c_mktsegment")),
    ]
    return union_outputs([source(load).withColumn("form", F.lit(load.projection)) for load in loads])


@query(
    "rename_columns",
    """SELECT p_partkey AS "partKey", p_name AS "Name of part", p_brand AS brand, p_retailprice AS price
       FROM part""",
)
def rename_columns(spark, folder):
    select_sql = "`p_partkey` AS partKey, `p_name` AS `Name of part`, p_brand AS brand, p_retailprice AS price"
    return parquet_tables(spark, folder)(FullLoad("shop", "public", "part", select_sql=select_sql))


@query("prune_output_columns", "SELECT c_custkey, c_acctbal FROM customer")
def prune_output_columns(spark, folder):
    return prune(table(spark, folder, "customer"), ["c_acctbal", "c_custkey", "not_there"])


@query(
    "derived_cursor",
    f"SELECT *, GREATEST(created_at, updated_at) AS row_cursor FROM ({ORDER_LINES})",
)
def derived_cursor(spark, folder):
    return frames({"order_lines": order_lines(spark, folder)})(LINE_LOAD)


_LINE_ORDER = (
    "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, "
    "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"
)


@query(
    "latest_per_key",
    f"""SELECT * EXCLUDE (rn) FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
          FROM lineitem) WHERE rn = 1""",
)
def latest_line(spark, folder):
    return latest_per_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "repeated_keys",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS copies, MIN(l_shipdate) AS first_cursor,
              MAX(l_shipdate) AS last_cursor
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
)
def repeated_lines(spark, folder):
    return repeated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "union_same_output",
    """SELECT o_orderkey AS id, o_orderdate AS happened_at, o_orderpriority AS priority,
              CAST(NULL AS DOUBLE) AS quantity FROM orders
       UNION ALL SELECT l_orderkey, l_shipdate, NULL, l_quantity FROM lineitem""",
)
def union_same_output(spark, folder):
    source = parquet_tables(spark, folder)
    placed = "o_orderkey AS id, o_orderdate AS happened_at, o_orderpriority AS priority"
    shipped = "l_orderkey AS id, l_shipdate AS happened_at, l_quantity AS quantity"
    loads = [
        FullLoad("shop", "public", "orders", "history", select_sql=placed),
        FullLoad("shop", "public", "lineitem", "history", select_sql=shipped),
    ]
    return union_outputs([source(load) for load in loads])


_SNAPSHOT = """SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS amount,
                      o_orderdate AS changed_at FROM orders"""
_CHANGES = """SELECT l_orderkey AS order_id, l_linestatus AS status, l_extendedprice AS amount,
                     l_shipdate AS changed_at
              FROM lineitem WHERE l_shipdate > TIMESTAMP '1999-01-01'"""
_CURRENT = f"""SELECT * EXCLUDE (rn) FROM (
                 SELECT *, ROW_NUMBER() OVER (
                   PARTITION BY order_id ORDER BY changed_at DESC, status DESC, amount DESC) AS rn
                 FROM ({_SNAPSHOT} UNION ALL {_CHANGES})) WHERE rn = 1"""


def _snapshot_and_changes(spark, folder):
    snapshot = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id", "o_orderstatus AS status", "o_totalprice AS amount", "o_orderdate AS changed_at"
    )
    changes = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_linestatus AS status", "l_extendedprice AS amount", "l_shipdate AS changed_at"
    )
    return snapshot, changes.filter("changed_at > timestamp_ntz '1999-01-01'")


@query("current_state", _CURRENT)
def current_state_of_orders(spark, folder):
    snapshot, changes = _snapshot_and_changes(spark, folder)
    return current_state(snapshot, changes, ["order_id"], "changed_at")


@query("current_state_unique_snapshot", _CURRENT)
def current_state_of_unique_orders(spark, folder):
    """The same result when the snapshot is known to hold each key once."""
    snapshot, changes = _snapshot_and_changes(spark, folder)
    return current_state(snapshot, changes, ["order_id"], "changed_at", unique_snapshot=True)


@query("current_state_bucketed", _CURRENT)
def current_state_in_buckets(spark, folder):
    """The same result out of a log in buckets by order: the snapshot and two runs of changes, each folded as it lands."""
    snapshot, changes = _snapshot_and_changes(spark, folder)
    log = BucketedLog.new(spark, ["order_id"], "changed_at", int(spark.conf.get("spark.sql.shuffle.partitions")))
    late = "changed_at > timestamp_ntz '2000-01-01'"
    for run in (snapshot, changes.filter(f"NOT {late}"), changes.filter(late)):
        log.append(run)
    return log.current()
