from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from snapdelta import functions as pg
from snapdelta.functions.text import UNICODE_SPACES, lines, one_spaced, strip


def values(spark, data_type, rows, column):
    """``column`` applied to a one-column frame, in row order."""
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T._parse_datatype_string(data_type))])
    frame = spark.createDataFrame(list(enumerate(rows)), schema)
    return [row.y for row in frame.select("n", column.alias("y")).orderBy("n").collect()]


def test_number_text(spark):
    cases = [
        (123456789.5, "123456789.5"),
        (0.0, "0"),
        (-0.0, "-0"),
        (1.0, "1"),
        (100.0, "100"),
        (-12345678.0, "-12345678"),
        (0.1, "0.1"),
        (0.001, "0.001"),
        (0.0001, "0.0001"),
        (0.00012345, "0.00012345"),
        (0.00001, "1e-05"),
        (-1.5e-7, "-1.5e-07"),
        (1e14, "100000000000000"),
        (999999999999999.0, "999999999999999"),
        (1e15, "1e+15"),
        (1.2345678901234568e17, "1.2345678901234568e+17"),
        (1e100, "1e+100"),
        (float("nan"), "NaN"),
        (float("inf"), "Infinity"),
        (float("-inf"), "-Infinity"),
        (None, None),
    ]
    assert values(spark, "double", [c for c, _ in cases], pg.number_text("x")) == [t for _, t in cases]


def test_array_literal(spark):
    cases = [
        (None, None),
        ([], "{}"),
        (["a", "b"], "{a,b}"),
        (["a"], "{a}"),
        ([""], '{""}'),
        ([None], "{NULL}"),
        (["a", "", "b"], '{a,"",b}'),
        (["a,b", None], '{"a,b",NULL}'),
        (["Null"], '{"Null"}'),
        (["annulled", "x"], "{annulled,x}"),
        (["a", None], "{a,NULL}"),
        (["NULL", "null", ""], '{"NULL","null",""}'),
        (["b c", "x,y", "{", "}", "t\tt"], '{"b c","x,y","{","}","t\tt"}'),
        (['q"r', "back\\slash"], '{"q\\"r","back\\\\slash"}'),
    ]
    assert values(spark, "array<string>", [c for c, _ in cases], pg.array_literal("x")) == [t for _, t in cases]


def test_array_json_and_join(spark):
    rows = [["a", None, 'q"'], [], None]
    assert values(spark, "array<string>", rows, pg.json_array("x")) == ['["a",null,"q\\""]', "[]", None]
    assert values(spark, "array<string>", rows, pg.json_array_or_empty("x"))[2] == "[]"
    assert values(spark, "array<string>", rows, pg.joined("x")) == ['a,q"', "", None]


def test_unnest_drops_null_and_empty_arrays(spark):
    frame = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "id bigint, a array<string>")
    rows = frame.select("id", pg.exploded("a").alias("e")).collect()
    assert [(r.id, r.e) for r in rows] == [(1, "a"), (1, None)]


def test_map_text(spark):
    rows = [{"de": "Haus", "en": ""}, {}, None]
    assert values(spark, "map<string,string>", rows, pg.map_text("x", "de")) == ["Haus", "", ""]


def test_range_text(spark):
    frame = spark.createDataFrame([(1, 5), (None, 5), (1, None), (None, None), (3, 3)], "lo int, hi int")
    found = [r[0] for r in frame.select(pg.range_text("lo", "hi")).collect()]
    assert found == ["[1,5)", "(,5)", "[1,)", "(,)", "empty"]
    stamps = spark.createDataFrame([(datetime(2024, 1, 1), None)], "lo timestamp_ntz, hi timestamp_ntz")
    assert stamps.select(pg.range_text("lo", "hi", quoted=True)).first()[0] == '["2024-01-01 00:00:00",)'


def test_json_fields(spark):
    rows = ['{"a": {"b": "x", "n": 1.50}, "z": null, "k y": 3}', '{"a": 5}', "not json", None]
    assert values(spark, "string", rows, pg.json_text("x", "a", "b")) == ["x", None, None, None]
    assert values(spark, "string", rows, pg.json_text("x", "z")) == [None] * 4
    assert values(spark, "string", rows, pg.json_text("x", "k y")) == ["3", None, None, None]
    assert values(spark, "string", rows, pg.json_fields("x", ["a", "z"])[1]) == [None] * 4


DIRTY = ["a\nb", "a\r\nb", "a\n\n\rb", "\t a  b \x0b\x0c c ", "  lead", "", None, "tab\tonly", " \t x"]


def test_line_breaks_and_spaces(spark):
    assert values(spark, "string", DIRTY, pg.newline_runs_to_space("x"))[:3] == ["a b", "a b", "a b"]
    assert values(spark, "string", DIRTY, pg.newlines_to_spaces("x"))[:3] == ["a b", "a  b", "a   b"]
    collapsed = values(spark, "string", DIRTY, pg.collapse_spaces("x"))
    # A leading tab is not trimmed, it becomes a space.
    assert collapsed == ["a b", "a b", "a b", " a b c", "lead", "", None, "tab only", " x"]
    assert values(spark, "string", ["aXbXX", None], pg.without("x", "X")) == ["ab", None]


def test_unicode_whitespace_is_pythons(spark):
    assert set(UNICODE_SPACES) == {chr(c) for c in range(0x11000) if chr(c).isspace()}
    texts = ["　 a   b\x85", "x", " \t", ""]
    assert values(spark, "string", texts, strip("x")) == [t.strip() for t in texts]
    assert values(spark, "string", texts, one_spaced(strip("x"))) == [" ".join(t.split()) for t in texts]
    text = "one\r\n\r\n two  three\x0bfour\x85\n"
    assert values(spark, "string", [text], lines("x")) == [[t.strip() for t in text.splitlines() if t.strip()]]


def test_timestamp_texts(spark):
    stamps = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120000), None]
    assert values(spark, "timestamp_ntz", stamps, pg.timestamp_text("x")) == [
        "2024-01-02 03:04:05",
        "2024-01-02 03:04:05.12",
        None,
    ]
    assert values(spark, "timestamp_ntz", stamps, pg.iso_text("x")) == [s and s.isoformat() for s in stamps]
    zoned = spark.sql("SELECT timestamp '2024-01-02 03:04:05.5 UTC' AS t").select(pg.timestamptz_text("t"))
    assert zoned.first()[0] == "2024-01-02 03:04:05.5+00"


@pytest.mark.parametrize(
    "column, data_type, row, filled",
    [
        (lambda: pg.or_blank("x"), "string", None, ""),
        (lambda: pg.or_zero("x", "bigint"), "bigint", None, 0),
        (lambda: pg.or_zero("x", "double"), "double", 2.5, 2.5),
        (lambda: pg.or_false("x"), "boolean", None, False),
    ],
)
def test_defaults(spark, column, data_type, row, filled):
    assert values(spark, data_type, [row], column()) == [filled]


def test_functions_run_without_python_workers(spark):
    plan = spark.range(5).select(
        pg.number_text(F.col("id").cast("double")), pg.collapse_spaces(F.col("id").cast("string"))
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


def test_number_text_of_a_real(spark):
    assert [r[0] for r in spark.sql("SELECT explode(array(float(0.1), float(1e20), float(3))) AS x").select(pg.number_text("x")).collect()] == ["0.1", "1e+20", "3"]
