"""Typed array literals, exact JSON fields, cause chains, late rows, watched tables, honoured settings."""

import errno
import json
import time
from dataclasses import replace
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from snapdelta import functions as pg
from snapdelta.config import DeltaLoad, FullLoad, load_from_entry
from snapdelta.operators import failures
from snapdelta.plans.job import JobSettings, PhaseSettings, day_from, layout_from, load_log, run_job, settings_from
from snapdelta.plans.loads import load_delta, window_start
from snapdelta.sinks.layout import Layout
from snapdelta.sources.jdbc import connections_from, fetch_rows_from
from snapdelta.sources.landed import read_delta_log
from snapdelta.sources.tables import frames
from snapdelta.state.watermark import WatermarkTable

DAY = "2024/01/31"


@pytest.fixture
def place(tmp_path):
    return Layout(str(tmp_path))


@pytest.mark.parametrize(
    "sql, want",
    [
        ("array(1.0D, 12345678.5D, NULL, double('NaN'), 1e20D, -0.00001D)", "{1,12345678.5,NULL,NaN,1e+20,-1e-05}"),
        ("array(1.5f, 0.1f)", "{1.5,0.1}"),
        ("array(true, NULL, false)", "{t,NULL,f}"),
        ("array(array(1, 2), array(3, NULL))", "{{1,2},{3,NULL}}"),
        ("array(array('a b', 'x'), array('{', NULL))", '{{"a b",x},{"{",NULL}}'),
        ("array(timestamp_ntz'2024-01-01 00:00:00.5')", '{"2024-01-01 00:00:00.5"}'),
        ("array(timestamp'2024-01-01 00:00:00 UTC')", '{"2024-01-01 00:00:00+00"}'),
        ("array(date'2024-01-01', NULL)", "{2024-01-01,NULL}"),
        ("array(1.50BD)", "{1.50}"),
        ("array(X'00ff')", r'{"\\x00ff"}'),
        ("array('', 'NULL', 'a\"b', 'c')", '{"","NULL","a\\"b",c}'),
        ("CAST(array() AS array<double>)", "{}"),
        ("CAST(NULL AS array<boolean>)", None),
    ],
)
def test_array_literals_by_type(spark, sql, want):
    assert pg.array_literals(spark.sql(f"SELECT {sql} AS a, 7 AS b")).first() == (want, 7)


DOCUMENT = r"""
 {"n": 1.10, "e": 1e5, "neg": -0, "big": 12345678901234567890.5000, "it's": "1.5 \"x\", 2.0", "d": 1.0, "d": 2.00,
  "o": { "a" : [1.0 , 2, {"k": null}, "3.0"], "b": "z"}, "t": true, "z": null, "a.b": 7, "": "empty", "s": "{1.0}", "u": "é 1.0"}"""


@pytest.mark.parametrize(
    "path, want",
    [
        (("n",), "1.10"), (("e",), "1e5"), (("neg",), "-0"), (("big",), "12345678901234567890.5000"), (("it's",), '1.5 "x", 2.0'), (("d",), "2.00"),
        (("o", "a", 0), "1.0"), (("o", "a", -1), "3.0"), (("o", "a", 2, "k"), None), (("o", "a", 9), None), (("o", "b"), "z"), (("o",), '{"a":[1.0,2,{"k":null},"3.0"],"b":"z"}'),
        (("t",), "true"), (("z",), None), (("missing",), None), (("a.b",), "7"), (("",), "empty"), (("s",), "{1.0}"), (("u",), "é 1.0"), ((0,), None), (("n", "x"), None),
    ],
)
def test_json_fields_as_written(spark, path, want):
    rows = spark.createDataFrame([(DOCUMENT,), (None,), ("no json 1.5",), ('[{"n": 1}, 1.50]',)], "j string")
    found = [row[0] for row in rows.select(pg.json_text("j", *path)).collect()]
    assert found[:3] == [want, None, None] and found[3] == ('{"n":1}' if path == (0,) else None)
    if len(path) == 1 and isinstance(path[0], str):
        (column,) = pg.json_fields("j", [path[0]])
        assert [row[0] for row in rows.select(column).collect()] == [want, None, None, None]


def test_long_json_strings_take_no_stack(spark):
    text = json.dumps({"a": "x\\\"1.5, " * 200_000, "b": [0.5] * 50_000, "n": 1})
    row = spark.createDataFrame([(text.replace('"n": 1', '"n": 1.00'),)], "j string").select(pg.json_text("j", "n"), pg.json_text("j", "b", -1)).first()
    assert tuple(row) == ("1.00", "0.5")


# ---- failures


def raised(error, cause=None, context=None):
    error.__cause__, error.__context__ = cause, context
    return error


ERRORS = [
    (pa.ArrowInvalid("Schema at index 1 did not match: timeout"), "schema"),
    (RuntimeError("load failed"), "fatal"),
    (raised(RuntimeError("load failed"), cause=ConnectionResetError(errno.ECONNRESET, "gone")), "transient"),
    (raised(RuntimeError("load failed"), context=TimeoutError()), "transient"),
    (raised(RuntimeError("timeout"), cause=raised(KeyError("x"), cause=ValueError("Schema does not Match"))), "schema"),
    (BrokenPipeError(), "transient"),
    (OSError(errno.ENOSPC, "full"), "transient"),
    (OSError(errno.EINVAL, "Invalid argument"), "fatal"),
    (OSError(errno.EINVAL, "wrong number of bytes"), "transient"),
    (OSError(errno.ENOENT, "none"), "fatal"),
    (type("ClientError", (Exception,), {"response": {"Error": {"Code": "SlowDown"}}})("x"), "transient"),
    (type("ClientError", (Exception,), {"response": {"Error": {"Code": "AccessDenied"}}})("x"), "fatal"),
]


@pytest.mark.parametrize("error, want", ERRORS)
def test_errors_by_their_whole_chain(error, want):
    assert failures.error_class(error) == want


def test_a_circle_of_causes_ends():
    a, b = RuntimeError("a"), RuntimeError("b")
    a.__cause__, b.__cause__ = b, a
    assert failures.cause_chain(a) == [a, b] and failures.error_class(a) == "fatal"


def test_causes_of_the_jvm_count(spark):
    with pytest.raises(Exception) as caught:
        spark.range(1).select(F.raise_error(F.lit("server closed the connection unexpectedly"))).collect()
    assert failures.error_class(raised(RuntimeError("wrapped"), cause=caught.value)) == "transient"


def test_names_of_derived_types(spark):
    assert "ArrowInvalid" in failures.kinds_of("ValueError") and "ConnectionResetError" in failures.kinds_of("OSError")
    rows = [("ArrowInvalid", "Schema at index 1 did not match: timeout", "schema"), ("KeyError", "schema did not match", "fatal"), ("ArrowMemoryError", "malloc", "fatal")]
    frame = spark.createDataFrame(rows, "t string, m string, want string")
    found = frame.select("want", failures.failure_class("t", "m").alias("one"), failures.is_exhaustion("t", "m").alias("full")).collect()
    assert [(r.one, r.full) for r in found] == [("schema", False), ("fatal", False), ("fatal", True)]
    assert failures.is_exhausted(raised(RuntimeError("x"), cause=OSError(errno.ENOSPC, "y"))) and not failures.is_exhausted(OSError(errno.EPIPE, "y"))


# ---- late rows


def test_windows():
    at = datetime(2024, 1, 10)
    assert window_start(at, "2 days") == at - timedelta(days=2) and window_start(at, "1 hour") == at - timedelta(hours=1)
    assert window_start(50, "8") == 42 and window_start(1.5, "0.5") == 1.0
    with pytest.raises(ValueError, match="needs keys"):
        DeltaLoad("d", "s", "t", cursor_column="c", late_window="5")
    load = load_from_entry("d", {"schema": "s", "table": "t", "cursor_column": "c", "late_window": 5, "keys": ["id"]}, delta=True)
    assert (load.late_window, load.keys) == ("5", ("id",))


def test_late_rows_land_once(spark, place):
    load = DeltaLoad("d", "s", "t", "out", cursor_column="c", keys=("id",), late_window="10")
    batches = [
        [(1, 5), (2, 20)],
        [(1, 5), (2, 20), (3, 12), (4, 9), (5, 30)],  # 3 came late, 4 too late for the window
        [(1, 5), (2, 31), (3, 12), (4, 9), (5, 30), (6, 21), (6, 25), (None, 22)],  # 2 changed, two late rows of one key, one without
        [(1, 5), (2, 31), (3, 12), (4, 9), (5, 30), (6, 21), (6, 25), (None, 22)],
    ]
    landed = []
    for nth, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "id long, c long")
        landed.append(load_delta(frame, load, place, DAY, WatermarkTable(spark, place.state), floor=3, manifest=nth % 2 == 0).n_rows)
    assert landed == [2, 2, 4, 0]
    found = sorted((r.id or 0, r.c) for r in read_delta_log(spark, place, "out").collect())
    assert found == [(0, 22), (1, 5), (2, 20), (2, 31), (3, 12), (5, 30), (6, 21), (6, 25)]


# ---- jobs


def test_a_stuck_table_is_cancelled_and_the_others_land(spark, place):
    slow = F.udf(lambda n: time.sleep(60) or n, "long")

    def source(load):
        rows = spark.range(4)
        return rows.select(slow("id").alias("id")) if load.table == "stuck" else rows

    settings = JobSettings(DAY, full=PhaseSettings(parallel_tables=3, attempts=3, table_timeout_seconds=5, pool="loads"))
    start = time.monotonic()
    outcomes = run_job(spark, source, place, settings, [FullLoad("d", "s", name) for name in ("a", "stuck", "b")])
    assert time.monotonic() - start < 40
    assert [(o.table_name, o.status, o.n_rows) for o in outcomes] == [("a", "ok", 4), ("stuck", "failed", None), ("b", "ok", 4)]
    assert outcomes[1].error.startswith("TableTimeout: d.s.stuck: cancelled after 5 s") and len(outcomes[1].causes) > 1
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_the_log_says_what_was_read(spark, place):
    load = DeltaLoad("d", "s", "t", cursor_column="c", initial_value="2")
    rows = frames({"t": spark.range(6).withColumnRenamed("id", "c"), "u": spark.range(2).selectExpr("CAST(id AS string) AS id")})
    full = FullLoad("d", "s", "u", column_types=(("id", "date"),))
    log = load_log(spark, run_job(spark, rows, place, JobSettings(DAY), [full], [load]))
    found = {r.table_name: (r.mode, r.cutoff, r.low, r.high, r.n_rejected) for r in log.collect()}
    assert found == {"t": ("incremental", "2", "3", "5", 0), "u": ("full_table", None, None, None, 2)}


def test_settings_are_honoured(spark, tmp_path):
    document = {
        "pipeline": {"name": "nightly", "dataset_name": "ext"},
        "destination": {
            "full_load_layout": "full/{table_name}/at/{snapshot_date}/{load_id}.{file_id}.{ext}",
            "delta_load_layout": "delta/{table_name}/{snapshot_date}/part",
        },
        "snapshot": {"mode": "current_date", "date_format": "%Y-%m"},
        "runtime": {"rows_per_file": 2, "order_first_load": True, "file_manifest": True, "full_load_table_timeout_seconds": 600, "extract_chunk_size": 5},
        "postgres": {"statement_timeout_ms": 900, "tcp_keepalives_enabled": False},
    }
    settings, place = settings_from(document), layout_from(document, str(tmp_path))
    assert settings.day == day_from(document) == f"{datetime.now():%Y-%m}"
    assert (settings.rows_per_file, settings.order_first_load, settings.file_manifest, settings.delta.table_timeout_seconds) == (2, True, True, 600.0)
    source = frames({"t": spark.range(5).withColumnRenamed("id", "c")})
    load = DeltaLoad("d", "s", "t", cursor_column="c")
    outcomes = run_job(spark, source, place, settings, [FullLoad("d", "s", "t")], [load])
    assert [o.status for o in outcomes] == ["ok", "ok"]
    assert (tmp_path / "ext" / "full" / "t" / "at" / settings.day).is_dir() and (tmp_path / "ext" / "delta" / "t" / settings.day / "part").is_dir()
    assert sorted(r.c for r in read_delta_log(spark, place, "t").collect()) == list(range(5))
    assert layout_from({}, "r") == Layout("r") and layout_from(document, "r", "other").dataset == "other"
    for wrong, message in (({"destination": {"file_format": "csv"}}, "file format"), ({"destination": {"full_load_layout": "x/{snapshot_date}"}}, "table_name"), ({"snapshot": {"mode": "fixed"}}, "snapshot mode")):
        with pytest.raises(ValueError, match=message):
            layout_from(wrong, "r"), day_from(wrong)
    connection = connections_from({"a": {"host": "h", "user": "u", "password": "p", "database": "d", "keepalive": True}}, document)["a"]
    assert (connection.statement_timeout_ms, connection.keepalive, fetch_rows_from(document)) == (900, True, 5)
