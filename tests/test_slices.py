"""Slice plans: every row in exactly one slice, slices of a bounded size, on a frame and on a database."""

import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from snapdelta.config import FullLoad, load_from_entry
from snapdelta.queries import QUERIES
from snapdelta.sources.jdbc import planned_slices
from snapdelta.sources.slices import POSTGRES, SPARK, DatabaseCounts, FrameCounts, plan_slices, sliced


def skewed(n=4000, seed=1):
    """A key of which one value holds a third of all rows and a tenth is NULL, and a second, unique column."""
    rng = random.Random(seed)
    keys = [rng.choice([7, 7, 7, 7, None, rng.randrange(900), rng.randrange(900), -3, rng.randrange(900), rng.randrange(900)]) for _ in range(n)]
    return [(key, nth) for nth, key in enumerate(keys)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(skewed(), "k bigint, id bigint").cache()


@pytest.mark.parametrize("parts", [1, 3, 8, 40])
@pytest.mark.parametrize("columns", [("k",), ("k", "id")])
def test_every_row_is_in_one_slice_of_a_frame(frame, parts, columns):
    plan = plan_slices(FrameCounts(frame), columns, parts)
    found = sliced(frame.select("id", "k"), plan)
    assert sorted(row.id for row in found.collect()) == list(range(4000))
    share = -(-4000 // parts)
    sizes = [frame.filter(condition).count() for condition in plan]
    counts = Counter(key for key, _ in skewed())
    for condition, size in zip(plan, sizes):
        # only a value without a second column to cut it by may hold more
        alone = len(columns) == 1 and size in counts.values()
        assert alone or size <= 2 * share + 1
    assert len(plan) <= 2 * parts + len([n for n in counts.values() if n >= share]) + 1


@pytest.mark.parametrize("parts", [1, 3, 8, 40])
def test_the_same_plan_in_a_database(frame, parts):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (k BIGINT, id BIGINT)")
    connection.executemany("INSERT INTO t VALUES (?, ?)", skewed())
    load = FullLoad("d", "main", "t", read_slices=parts, slice_columns=("k", "id"))
    plan = planned_slices(load, lambda query: connection.execute(query).fetchall())
    if parts == 1:
        assert plan is None
        return
    found = [connection.execute(f"SELECT id FROM t WHERE {condition}").fetchall() for condition in plan]
    assert sorted(row[0] for rows in found for row in rows) == list(range(4000))
    assert max(map(len, found)) <= 2 * -(-4000 // parts)
    # rows that come after the plan was made have a slice too
    connection.execute("INSERT INTO t VALUES (-99, 5000), (99999, 5001), (NULL, 5002), (7, -5)")
    assert sum(connection.execute(f"SELECT count(*) FROM t WHERE id IN (5000, 5001, 5002, -5) AND ({condition})").fetchone()[0] for condition in plan) == 4


@pytest.mark.parametrize("kind", ["decimal(12,2)", "date", "timestamp_ntz", "timestamp", "double", "boolean", "string"])
def test_columns_of_every_kind(spark, kind):
    value = {
        "decimal(12,2)": "CAST(id / 3 AS decimal(12,2))",
        "date": "date_add(DATE '2024-01-01', CAST(id AS int))",
        "timestamp_ntz": "TIMESTAMP_NTZ '2024-01-01 00:00:00.000001' + make_interval(0, 0, 0, 0, CAST(id AS int))",
        "timestamp": "CAST(id * 3600 AS timestamp)",
        "double": "CASE WHEN id < 5 THEN double('NaN') ELSE id / 7 END",
        "boolean": "id % 4 = 0",
        "string": "CASE WHEN id % 2 = 0 THEN 'it''s' ELSE 'b' END",
    }[kind]
    rows = spark.range(200).selectExpr("id", f"CASE WHEN id % 9 <> 0 THEN {value} END AS `a``b`")
    plan = plan_slices(FrameCounts(rows), ("a`b", "id"), 6)
    assert sorted(row.id for row in sliced(rows, plan).collect()) == list(range(200)) and len(plan) > 4


def test_nothing_to_slice(spark):
    empty = spark.range(0)
    assert sliced(empty, plan_slices(FrameCounts(empty), ("id",), 5)).count() == 0
    nulls = spark.range(9).selectExpr("CAST(NULL AS int) AS k", "id")
    assert sliced(nulls, plan_slices(FrameCounts(nulls), ("k",), 3)).count() == 9
    with pytest.raises(ValueError, match="slice_columns"):
        planned_slices(FullLoad("d", "s", "t", read_slices=4), None)


def test_literals():
    assert [POSTGRES.value(v) for v in (1, True, "a'b", date(2024, 1, 2), datetime(2024, 1, 2, 3), Decimal("1.50"))] == [
        "1", "TRUE", "'a''b'", "DATE '2024-01-02'", "TIMESTAMP '2024-01-02 03:00:00'", "1.50",
    ]
    assert (SPARK.name("a`b"), POSTGRES.name('a"b')) == ("`a``b`", '"a""b"')
    assert DatabaseCounts(None, "t")._from(["a > 1", "b"]) == " FROM t WHERE (a > 1) AND (b)"


def test_slices_come_from_the_config():
    load = load_from_entry("shop", {"schema": "s", "table": "t", "read_slices": 12, "slice_columns": ["k", "id"]}, delta=False)
    assert (load.read_slices, load.slice_columns) == (12, ("k", "id"))


def test_conditions_reach_the_scan(spark):
    found = QUERIES["partitioned_read"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [") >= 8 and "GreaterThanOrEqual(l_suppkey" in plan
    assert found.agg(F.count("*")).first()[0] == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
