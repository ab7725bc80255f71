"""The bucketed delta log: one row per key, no exchange, NULL keys, a hot key."""

import random

import pytest

from snapdelta.operators.compact import latest_per_key
from snapdelta.sinks.bucketed import BucketedLog
from tests.test_compact import brute_latest

SCHEMA = "k int, c int, v int"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def runs_of(seed):
    chance = random.Random(seed)
    # a third of all rows under one key, some without a key
    keys = [7] * 300 + [None] * 60 + [chance.randrange(200) for _ in range(540)]
    rows = [(k, chance.choice([None, *range(20)]), at) for at, k in enumerate(keys)]
    chance.shuffle(rows)
    return [rows[at::3] for at in range(3)]


@pytest.mark.parametrize("seed", range(2))
def test_runs_fold_to_the_newest_rows(spark, seed):
    log, every = BucketedLog.new(spark, ["k"], "c", 4, ["v"]), []
    for rows in runs_of(seed):
        log.append(spark.createDataFrame(rows, SCHEMA).repartition(5))
        every += rows
    found = sorted(str(tuple(row)) for row in log.current().collect())
    assert found == brute_latest(every)
    # a run leaves one row per key at most, also of the hot key and of the missing one
    assert log.rows().filter("k = 7").count() == 3 and log.rows().filter("k IS NULL").count() == 3
    small = log.compacted(buckets=2)
    assert sorted(str(tuple(row)) for row in small.current().collect()) == found
    assert small.rows().count() == len(found) and log.rows().count() > len(found)
    log.drop()
    assert not log.exists() and small.exists()


def test_current_rows_need_no_exchange(spark):
    log = BucketedLog.new(spark, ["k"], "c", 4)
    plain = []
    for rows in runs_of(5):
        log.append(spark.createDataFrame(rows, SCHEMA))
        plain += rows
    assert "Exchange" not in plan_of(log.current())
    assert "Exchange" in plan_of(latest_per_key(spark.createDataFrame(plain, SCHEMA).repartition(3), ["k"], "c"))
    # a join of two logs by the key stays inside the buckets too
    other = log.compacted()
    assert "hashpartitioning" not in plan_of(log.current().join(other.current().hint("merge"), "k"))


def test_two_keys_empty_runs_and_columns_in_another_order(spark):
    log = BucketedLog.new(spark, ["a", "b"], "c", 3)
    log.append(spark.createDataFrame([(1, None, 1, "x"), (1, None, 2, "y"), (None, None, 1, "z")], "a int, b string, c int, t string"))
    log.append(spark.createDataFrame([], "a int, b string, c int, t string"))
    log.append(spark.createDataFrame([("w", 3, None, 1), ("q", 1, "b", 1)], "t string, c int, b string, a int"))
    found = {tuple(row) for row in log.current().collect()}
    assert found == {(1, None, 3, "w"), (1, "b", 1, "q"), (None, None, 1, "z")}
    with pytest.raises(ValueError):
        BucketedLog.new(spark, [], "c", 3)
