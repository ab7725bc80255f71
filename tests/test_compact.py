import random

import pytest
from pyspark.sql import functions as F, types as T

from snapdelta.operators import metrics
from snapdelta.operators.compact import current_state, late_rows, latest_per_key, repeated_keys, union_outputs
from snapdelta.operators.projection import nullable, project, prune
from snapdelta.operators.schema import columns_frame, conform, merge_batches, schema_difference, stable_text, text_for_complex
from snapdelta.config import FullLoad


def brute_latest(rows):
    best = {}
    for k, c, v in rows:
        rank = (c is not None, c or 0, v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, c, v))
    return sorted(str(row) for _, row in best.values())


@pytest.mark.parametrize("seed", range(3))
def test_latest_with_a_hot_key(spark, seed):
    chance = random.Random(seed)
    keys = [0] * 400 + list(range(1, 200)) * 3
    rows = [(k, chance.choice([None, 1, 2, 3]), chance.randrange(50)) for k in keys]
    frame = spark.createDataFrame(rows, "k int, c int, v int").repartition(7)
    found = latest_per_key(frame, ["k"], "c")
    assert sorted(str(tuple(r)) for r in found.collect()) == brute_latest(rows)
    # A first pass inside each task comes before the shuffle.
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_latest_carries_columns_without_an_order(spark):
    rows = [(1, 1, {"a": 1}), (1, 2, {"b": 2}), (2, None, None)]
    found = latest_per_key(spark.createDataFrame(rows, "k int, c int, m map<string,int>"), ["k"], "c")
    assert found.columns == ["k", "c", "m"]
    assert {r.k: r.m for r in found.collect()} == {1: {"b": 2}, 2: None}


def test_tiebreak_columns_come_first(spark):
    rows = [(1, 5, "z", 1), (1, 5, "a", 2)]
    frame = spark.createDataFrame(rows, "k int, c int, v string, version int")
    assert latest_per_key(frame, ["k"], "c").first().v == "z"
    assert latest_per_key(frame, ["k"], "c", ["version"]).first().v == "a"


def test_current_state_both_ways(spark):
    chance = random.Random(1)
    snapshot = [(k, chance.randrange(5), "s") for k in range(100)]
    delta = [(chance.randrange(150), chance.randrange(8), chance.choice("abcz")) for _ in range(120)]
    frames = [spark.createDataFrame(rows, "k int, c int, v string") for rows in (snapshot, delta)]
    general = current_state(*frames, ["k"], "c")
    unique = current_state(*frames, ["k"], "c", unique_snapshot=True)
    want = brute_latest(snapshot + delta)
    assert sorted(str(tuple(r)) for r in general.collect()) == want
    assert sorted(str(tuple(r)) for r in unique.collect()) == want


def test_repeats_and_late_rows(spark):
    frame = spark.createDataFrame([(1, 1), (1, 3), (2, 2), (3, None)], "k int, c int")
    assert [tuple(r) for r in repeated_keys(frame, ["k"], "c").collect()] == [(1, 2, 1, 3)]
    assert sorted(r.k for r in late_rows(frame, "c", 2).collect()) == [1, 2, 3]


def test_union_fills_missing_columns(spark):
    merged = union_outputs([spark.range(1).withColumn("a", F.lit(1)), spark.range(1, 2)])
    assert sorted((r.id, r.a) for r in merged.collect()) == [(0, 1), (1, None)]


def test_projection_rules(spark):
    frame = spark.createDataFrame([(1, "x", 2.0)], "id int, `Odd name` string, v double")
    plain = FullLoad("d", "s", "t", output_columns=("v", "id"))
    assert project(frame, plain).columns == ["id", "v"]
    listed = FullLoad("d", "s", "t", columns=("Odd name", "id"), output_columns=("id",))
    assert project(frame, listed).columns == ["Odd name", "id"]
    assert project(frame, listed, enforce_output=True).columns == ["id"]
    text = FullLoad("d", "s", "t", select_sql="id, concat('{', `Odd name`, '}') AS t,\n")
    assert project(frame, text).first() == (1, "{x}")
    assert prune(frame, None).columns == frame.columns


def test_nullable(spark):
    frame = spark.range(1).withColumn("a", F.lit("x"))
    assert not frame.schema["id"].nullable
    assert all(f.nullable for f in nullable(frame).schema.fields)


def test_stable_columns(spark):
    frame = spark.sql(
        "SELECT 5 AS sender_user_id, CAST(NULL AS bigint) AS receiver_user_id, "
        "timestamp_ntz '2024-01-01 00:00:00' AS email_send_at, "
        "timestamp_ntz '2024-01-01 00:00:00.5' AS event_received_at, CAST(NULL AS bigint) AS other, array(1) AS a"
    )
    row = text_for_complex(stable_text(frame)).first()
    assert tuple(row) == ("5", "", "2024-01-01T00:00:00", "2024-01-01T00:00:00.500000", None, "[1]")


SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("x", T.StringType())])


def test_conform(spark):
    drifted = spark.createDataFrame([("1", 9), ("two", 9)], "k string, extra int")
    assert [tuple(r) for r in conform(drifted, SCHEMA, "null").collect()] == [(1, None), (None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(drifted, SCHEMA).collect()
    with pytest.raises(ValueError):
        conform(drifted, SCHEMA, "skip")
    batches = [
        spark.createDataFrame([(1,)], "k int"),
        spark.createDataFrame([("2",)], "k string"),
        spark.createDataFrame([(3, "y")], "k int, x string"),
    ]
    merged = merge_batches(batches, SCHEMA)
    assert sorted(merged.collect()) == [(1, None), (2, None), (3, "y")] and merged.schema == SCHEMA


def test_schema_difference(spark):
    left = columns_frame(spark, spark.createDataFrame([], "a int, b string, same date").schema)
    right = columns_frame(spark, spark.createDataFrame([], "a bigint, c string, same date").schema)
    found = sorted(map(tuple, schema_difference(left, right).collect()))
    assert found == [
        ("a", "int", "bigint", "type_differs"),
        ("b", "string", None, "missing_right"),
        ("c", None, "string", "missing_left"),
    ]


LOG = "load_type string, status string, n_rows bigint"


def test_rollup_and_status(spark):
    rows = [("FULL", "ok", 5), ("FULL", "failed", None), ("DELTA", "ok", 0), ("DELTA", "skipped", None)]
    log = spark.createDataFrame(rows, LOG)
    found = {r.phase: tuple(r)[1:] for r in metrics.run_rollup(log).collect()}
    assert found == {
        "FULL": (2, 1, 1, 0, 5, "FAILED"),
        "DELTA": (2, 1, 0, 1, 0, "SUCCESS"),
        "ALL": (4, 2, 1, 1, 5, "FAILED"),
    }
    assert tuple(metrics.run_status(log).first()) == (1, 0, "FAILED (full_failed=1)", 0)
    assert metrics.run_status(log, exit_on_failures=True).first().exit_code == 1
    assert tuple(metrics.run_status(log.filter("status = 'ok'"), True).first()) == (0, 0, "SUCCESS", 0)


def test_counts(spark):
    landed = spark.createDataFrame([("a",), ("a",), ("_dlt_loads",)], "table_name string")
    counts = metrics.row_counts(landed)
    assert sorted(map(tuple, counts.collect())) == [("a", 2)]
    tables = spark.createDataFrame([("a",), ("b",)], "table_name string")
    assert sorted(map(tuple, metrics.loaded_row_counts(tables, counts).collect())) == [("a", 2), ("b", 0)]
    assert metrics.total_rows(counts.limit(0)).first()[0] == 0


def test_configs_in_database_order(spark):
    configs = spark.createDataFrame([("b", "x", 0), ("a", "z", 1), ("b", "w", 2), ("a", "y", 3)], "database string, table string, ordinal int")
    assert [r.table for r in metrics.in_database_order(configs).collect()] == ["z", "y", "x", "w"]
