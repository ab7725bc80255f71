from datetime import date, datetime, timezone
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F, types as T

from snapdelta.config import DeltaLoad
from snapdelta.operators.cursor import (
    above,
    coerce_cursor,
    coerce_cursor_columns,
    cursor_bounds,
    describe_extract,
    first_floor,
    greatest_columns,
    in_cursor_order,
)
from snapdelta.plans.loads import extract
from snapdelta.sources.tables import frames

MARK = datetime(2024, 1, 10)
AFTER = datetime(2024, 1, 10, 0, 0, 0, 1)
BEFORE = datetime(2024, 1, 9)

LOAD = DeltaLoad(
    "d", "s", "t", columns=("id", "a", "b"), cursor_column="c", cursor_expression="GREATEST(a, b)"
)


@pytest.fixture(scope="module")
def rows(spark):
    stamps = [None, BEFORE, MARK, AFTER]
    data = [(i, a, b) for i, (a, b) in enumerate(product(stamps, stamps))]
    return spark.createDataFrame(data, "id int, a timestamp_ntz, b timestamp_ntz")


def test_strictly_above_and_null_cursors_go(rows):
    kept = {r.id for r in extract(frames({"t": rows})(LOAD), LOAD, MARK).collect()}
    want = {r.id for r in rows.collect() if max([v for v in (r.a, r.b) if v] or [BEFORE]) > MARK}
    assert kept == want


def test_no_value_keeps_everything(rows):
    assert extract(frames({"t": rows})(LOAD), LOAD, None).count() == rows.count()


def test_or_form_equals_greatest_on_all_triples(spark):
    triples = list(product([None, 1, 2, 3], repeat=3))
    frame = spark.createDataFrame(triples, "a int, b int, v int")
    by_or = frame.filter("a > v OR b > v OR v > 2 AND v > v").select("a", "b", "v")
    by_greatest = frame.filter("greatest(a, b) > v")
    assert sorted(map(str, by_or.collect())) == sorted(map(str, by_greatest.collect()))


def test_cursor_filter_reaches_the_scan(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = extract(frames({"t": stored})(LOAD), LOAD, MARK)._jdf.queryExecution().executedPlan().toString()
    assert "Or(GreaterThan(a,2024-01-10T00:00),GreaterThan(b,2024-01-10T00:00))" in plan
    single = above(stored, "a", "2024-01-10")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,2024-01-10T00:00)" in single
    assert "Exchange" not in plan


def test_parts_of_different_types_compare_as_one(spark):
    frame = spark.createDataFrame([(1, date(2024, 1, 11), MARK), (2, date(2024, 1, 9), AFTER), (3, None, None)], "id int, a date, b timestamp_ntz")
    kept = extract(frames({"t": frame})(LOAD), LOAD, MARK).collect()
    assert sorted(r.id for r in kept) == [1, 2]


@pytest.mark.parametrize(
    "text, columns",
    [
        ("GREATEST(a, b)", ["a", "b"]),
        (" greatest( `A b` ,c,d ) ", ["A b", "c", "d"]),
        ("GREATEST(a, COALESCE(b, c))", []),
        ("GREATEST(a)", []),
        ("a", []),
        (None, []),
    ],
)
def test_greatest_columns(text, columns):
    assert greatest_columns(text) == columns


@pytest.mark.parametrize(
    "value, coerced",
    [
        (None, None),
        ("", None),
        ("  ", None),
        ("5", 5),
        ("-5", -5),
        (5.0, 5),
        (5.5, 5.5),
        (True, True),
        (date(2024, 1, 1), datetime(2024, 1, 1)),
        (MARK, MARK),
        ("2024-01-01", datetime(2024, 1, 1)),
        (" 2024-01-01 02:03:04 ", datetime(2024, 1, 1, 2, 3, 4)),
        ("2024-01-01T02:03:04.5", datetime(2024, 1, 1, 2, 3, 4, 500000)),
        ("2024-01-01T00:00:00Z", datetime(2024, 1, 1, tzinfo=timezone.utc)),
        ("free text", "free text"),
    ],
)
def test_coerce_cursor(spark, value, coerced):
    assert coerce_cursor(value) == coerced
    if isinstance(value, str):
        row = spark.createDataFrame([(value,)], "raw string").select(coerce_cursor_columns("raw").alias("c")).first().c
        kinds = {int: "integer", datetime: "timestamp", str: "text", type(None): "none"}
        assert row.kind == kinds[type(coerced)]
        plain = coerced.replace(tzinfo=None) if isinstance(coerced, datetime) else coerced
        assert (row.integer_value, row.timestamp_value, row.text_value) == (
            coerced if isinstance(coerced, int) else None,
            plain if isinstance(coerced, datetime) else None,
            coerced if isinstance(coerced, str) else None,
        )


def test_offsets_do_not_depend_on_the_session_zone(spark):
    frame = spark.createDataFrame([("2024-01-01T00:00:00+02:00",)], "raw string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = frame.select(coerce_cursor_columns("raw").alias("c")).first().c.timestamp_value
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == datetime(2023, 12, 31, 22)


@pytest.mark.parametrize(
    "data_type, values, mark, kept",
    [
        ("bigint", [1, 2, 3, None], 2, [3]),
        ("string", ["a", "b", "c", None], "b", ["c"]),
        ("date", [date(2024, 1, 1), date(2024, 1, 2)], date(2024, 1, 1), [date(2024, 1, 2)]),
        ("decimal(10,2)", [Decimal("1.10"), Decimal("1.11")], Decimal("1.10"), [Decimal("1.11")]),
        ("double", [1.5, 2.5], 1.5, [2.5]),
    ],
)
def test_cursor_types(spark, data_type, values, mark, kept):
    frame = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("c", T._parse_datatype_string(data_type))]))
    assert [r.c for r in above(frame, "c", mark).collect()] == kept


def test_floors():
    assert first_floor("2024-01-01", "1970-01-01") == datetime(2024, 1, 1)
    assert first_floor(None, "1970-01-01") == datetime(1970, 1, 1)
    assert first_floor("", "1970-01-01") is None
    assert first_floor(None, None) is None


def test_bounds_and_descriptions(rows):
    found = extract(frames({"t": rows})(LOAD), LOAD, MARK)
    assert cursor_bounds(found, "c").first() == (AFTER, AFTER)
    described = describe_extract(found, "c", MARK).first()
    assert (described["mode"], described.cutoff) == ("incremental", "2024-01-10T00:00:00")
    assert described.description.endswith("min=2024-01-10T00:00:00.000001 max=2024-01-10T00:00:00.000001")
    none = describe_extract(found.limit(0), "c", MARK).first()
    assert (none.lo, none.hi) == (None, None) and none.description.endswith("matched_rows=0")
    assert describe_extract(found.limit(0), "c", None).first().description.endswith("no_rows_or_null_cursors")


def test_cursor_order(spark):
    frame = spark.range(0, 1000, 1, 4).select((F.col("id") * 37 % 1000).alias("c"))
    ordered = [r.c for r in in_cursor_order(frame, "c", globally=True).collect()]
    assert ordered == sorted(ordered)
    local = in_cursor_order(frame, "c")
    assert "Exchange" not in local._jdf.queryExecution().executedPlan().toString()
    for part in local.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.collect_list("c").alias("cs")).collect():
        assert part.cs == sorted(part.cs)
