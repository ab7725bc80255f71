"""Commits that can fail or race: numbered documents, snapshots, saved cursors, schema versions, file bounds."""

import json
import os
import random
import threading
import time
from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from snapdelta.config import DeltaLoad, FullLoad
from snapdelta.operators.compact import current_state
from snapdelta.operators.schema import conform, merge_batches, wider_type, widened
from snapdelta.plans.loads import load_delta, load_full
from snapdelta.queries import QUERIES
from snapdelta.sinks import landing
from snapdelta.sinks.commits import VersionLog
from snapdelta.sinks.folders import Folders
from snapdelta.sinks.landing import SnapshotWriter, append_snapshot, replace_snapshot, snapshot_runs, vacuum_snapshot, write_files
from snapdelta.sinks.layout import Layout
from snapdelta.sources.landed import log_bounds, read_above, read_delta_log, read_snapshot, read_snapshot_folder
from snapdelta.sources.tables import frames
from snapdelta.state.schemas import SchemaStore
from snapdelta.state.watermark import WatermarkTable, state_key

DAY = "2024/01/31"
LOAD = DeltaLoad("d", "s", "t", "out", cursor_column="c")


@pytest.fixture
def place(tmp_path):
    return Layout(str(tmp_path))


def ids(frame, column="id"):
    return sorted(row[column] for row in frame.collect())


# ---- documents


def test_a_number_is_taken_once(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path / "log"))
    assert log.newest() == (0, None)
    won = []
    threads = [threading.Thread(target=lambda nth=nth: log.commit(1, {"by": nth}) and won.append(nth)) for nth in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(won) == 1 and log.newest() == (1, {"by": won[0]})


@pytest.mark.parametrize("left", ["", '{"by": 2', "7"])
def test_a_number_without_a_whole_document_is_passed_over(spark, tmp_path, left):
    log = VersionLog(spark, str(tmp_path))
    assert log.commit(1, {"by": 1})
    (tmp_path / "v000000000002.json").write_text(left)
    assert log.newest() == (2, {"by": 1}) and not log.commit(2, {}) and log.commit(3, {"by": 3})
    assert log.newest() == (3, {"by": 3})


# ---- snapshots


def test_every_moment_has_a_snapshot(spark, tmp_path, monkeypatch):
    """Looked at before and after each step of a replacement that touches the file system."""
    folder = str(tmp_path / "day")
    replace_snapshot(spark.range(5), folder)
    seen = []
    for name in ("create_text", "delete"):
        real = getattr(Folders, name)

        def watched(self, *given, real=real):
            seen.append(ids(read_snapshot_folder(spark, folder)))
            done = real(self, *given)
            seen.append(ids(read_snapshot_folder(spark, folder)))
            return done

        monkeypatch.setattr(Folders, name, watched)
    for size in (3, 2, 4):
        replace_snapshot(spark.range(size), folder)
    assert seen[0] == list(range(5)) and seen[-1] == list(range(4))
    assert all(each in [list(range(n)) for n in (5, 3, 2, 4)] for each in seen)


@pytest.mark.parametrize("step", ["write", "commit", "lost answer", "drop"])
def test_a_replacement_that_fails(spark, tmp_path, monkeypatch, step):
    folder = str(tmp_path / "day")
    for size in (6, 5):
        replace_snapshot(spark.range(size), folder)
    rows, after = spark.range(3), [0, 1, 2, 3, 4]
    with monkeypatch.context() as patched:
        if step == "write":
            rows = rows.select(F.when(F.col("id") == 1, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
        else:
            name = {"commit": "commit", "lost answer": "commit", "drop": "drop"}[step]
            real = getattr(VersionLog, name)

            def failing(self, *given):
                if step == "lost answer":
                    real(self, *given)
                raise OSError("boom")

            patched.setattr(VersionLog, name, failing)
        with pytest.raises(Exception, match="boom"):
            replace_snapshot(rows, folder)
    if step in ("lost answer", "drop"):
        after = [0, 1, 2]  # the new version was committed before the failure
    assert ids(read_snapshot_folder(spark, folder)) == after
    replace_snapshot(spark.range(2), folder)
    assert ids(read_snapshot_folder(spark, folder)) == [0, 1]
    replace_snapshot(spark.range(1), folder)
    assert len([name for name in os.listdir(folder) if name.startswith("run-")]) == 2  # this one and the one before


def test_readers_of_the_last_version_are_not_cut_off(spark, tmp_path):
    folder = str(tmp_path / "day")
    replace_snapshot(spark.range(5), folder)
    reading = read_snapshot_folder(spark, folder)
    replace_snapshot(spark.range(3), folder)
    assert ids(reading) == [0, 1, 2, 3, 4]


def test_writers_that_add_at_once_lose_nothing(spark, tmp_path):
    folder = str(tmp_path / "day")
    replace_snapshot(spark.range(1), folder)
    threads = [threading.Thread(target=append_snapshot, args=(spark.range(10 * nth, 10 * nth + 2), folder)) for nth in range(1, 6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert ids(read_snapshot_folder(spark, folder)) == sorted([0] + [10 * nth + more for nth in range(1, 6) for more in (0, 1)])


def test_a_run_left_by_a_dead_driver_is_no_part_and_can_be_removed(spark, tmp_path):
    folder = str(tmp_path / "day")
    replace_snapshot(spark.range(2), folder)
    write_files(spark.range(9), f"{folder}/run-lost", "overwrite")
    assert ids(read_snapshot_folder(spark, folder)) == [0, 1]
    assert vacuum_snapshot(spark, folder) == []
    assert vacuum_snapshot(spark, folder, older_than_hours=0) == [f"{folder}/run-lost"]
    assert ids(read_snapshot_folder(spark, folder)) == [0, 1]


def test_a_plain_folder_is_the_first_version(spark, tmp_path):
    folder = str(tmp_path / "day")
    write_files(spark.range(4), folder, "overwrite")
    assert ids(read_snapshot_folder(spark, folder)) == [0, 1, 2, 3]
    append_snapshot(spark.range(9, 10), folder)
    assert ids(read_snapshot_folder(spark, folder)) == [0, 1, 2, 3, 9]
    for size in (2, 3, 1):
        replace_snapshot(spark.range(size), folder)
        assert ids(read_snapshot_folder(spark, folder)) == list(range(size))
    assert not Folders(spark).data_files(folder) and len(snapshot_runs(spark, folder)) == 1
    with pytest.raises(FileNotFoundError):
        read_snapshot_folder(spark, str(tmp_path / "none"))


def test_loads_of_unlike_types_share_a_snapshot(spark, place):
    writer = SnapshotWriter()
    for sql in ("SELECT 1 AS id, DATE '2024-01-01' AS at", "SELECT 'x' AS id, TIMESTAMP_NTZ '2024-01-02 03:00:00' AS at, 2 AS more"):
        load = FullLoad("d", "s", "t", "out")
        load_full(spark.sql(sql), load, place, DAY, writer)
    rows = read_snapshot(spark, place, "out", DAY)
    assert dict(rows.dtypes) == {"id": "string", "at": "timestamp_ntz", "more": "int"}
    assert sorted((r.id, r.at, r.more) for r in rows.collect()) == [("1", datetime(2024, 1, 1), None), ("x", datetime(2024, 1, 2, 3), 2)]


# ---- saved cursors


def test_tables_of_like_names_keep_their_cursors_apart(spark, place):
    loads = [replace(LOAD, database="a-b", output_table_name="x"), replace(LOAD, database="a_b", output_table_name="y"), replace(LOAD, database="a.b", output_table_name="y_")]
    for nth, load in enumerate(loads):
        state = WatermarkTable(spark, place.state)
        rows = spark.range(10 * (3 - nth)).select(F.col("id"), F.col("id").alias("c"))
        assert load_delta(rows, load, place, DAY, state).n_rows == 10 * (3 - nth)
    keys = {r.state_key: r.last_value for r in WatermarkTable(spark, place.state).history().collect()}
    assert keys == {state_key("snapdelta", "delta", load.database, "s", load.output_name): str(29 - 10 * nth) for nth, load in enumerate(loads)}


def test_two_runs_that_save_at_once(spark, place):
    state = WatermarkTable(spark, place.state)
    state.advance("k", "5", "bigint", 1, "r0")
    seen = state.saved("k")
    state.advance("k", "9", "bigint", 1, "r1", after=seen)
    state.advance("k", "7", "bigint", 1, "r2", after=seen)  # started from the same save, came second, ends lower
    assert (state.lookup("k"), state.saved("k").version) == (9, 2)
    state.advance("k", "12", "bigint", 1, "r3", after=seen)
    assert (state.lookup("k"), state.saved("k").run_id) == (12, "r3")
    threads = [threading.Thread(target=state.advance, args=("k", str(20 + nth), "bigint", 1, f"t{nth}")) for nth in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert state.lookup("k") == 27


def test_old_saves_are_folded(spark, place, monkeypatch):
    state = WatermarkTable(spark, place.state)
    for nth in range(1, 51):
        state.advance("k", str(nth), "bigint", 1, f"r{nth}")
    (folder,) = [name for name in os.listdir(place.state)]
    names = [name for name in os.listdir(f"{place.state}/{folder}") if not name.startswith(".")]
    assert len([name for name in names if name[0] == "v"]) <= 2 * 16 and len([name for name in names if name[0] == "u"]) == 1
    assert (state.lookup("k"), state.saved("k").version) == (50, 50)
    assert sorted(r.version for r in state.history("k").collect()) == list(range(1, 51))
    with monkeypatch.context() as patched:  # cut short between the folded file and the removal of the others
        patched.setattr(VersionLog, "drop", lambda self, version: (_ for _ in ()).throw(OSError("boom")))
        with pytest.raises(OSError):
            state.fold("k", keep=3)
    assert sorted(r.version for r in state.history().collect()) == list(range(1, 51))
    state.reset("k")
    assert state.lookup("k") is None and state.saved("k").version == 51


def test_the_repeated_hour_loses_no_row(spark, place):
    zone = spark.conf.get("spark.sql.session.timeZone")
    load = replace(LOAD, output_table_name="hours")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        rows = spark.sql("SELECT id, CAST(1729980000 + id * 600 AS timestamp) AS c FROM range(20)")  # 2024-10-27, from 00:00 to 03:10 in Berlin
        for until, found in ((6, 6), (8, 2), (20, 12)):
            state = WatermarkTable(spark, place.state)
            assert load_delta(rows.filter(f"id < {until}"), load, place, DAY, state).n_rows == found
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert ids(read_delta_log(spark, place, "hours")) == list(range(20))


# ---- schema versions


def test_wider_types_hold_both():
    long, whole, money = T.LongType(), T.IntegerType(), T.DecimalType(12, 2)
    cases = [
        (whole, long, long), (T.ByteType(), T.ShortType(), T.ShortType()), (whole, money, money), (long, money, T.DecimalType(21, 2)),
        (money, T.DecimalType(10, 4), T.DecimalType(14, 4)), (T.DecimalType(38, 0), T.DecimalType(38, 9), T.StringType()),
        (T.FloatType(), T.DoubleType(), T.DoubleType()), (whole, T.DoubleType(), T.DoubleType()), (long, T.DoubleType(), T.StringType()),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.DateType(), T.TimestampType(), T.StringType()),
        (T.BooleanType(), whole, T.StringType()), (T.StringType(), long, T.StringType()),
    ]
    for left, right, wanted in cases:
        assert wider_type(left, right) == wanted == wider_type(right, left)
    old, new = T._parse_datatype_string("a int, b string"), T._parse_datatype_string("c date, a long")
    assert widened(old, new).simpleString() == "struct<a:bigint,b:string,c:date>"
    assert widened(widened(old, new), old) == widened(old, new)


def test_versions_of_a_log_are_admitted_once(spark, place):
    store = SchemaStore(spark, place.schemas)
    assert store.current("t") == (0, None)
    a, b = T._parse_datatype_string("a int"), T._parse_datatype_string("a string, b int")
    assert store.admit("t", a) == (1, a) and store.admit("t", a) == (1, a)
    assert store.admit("t", b) == (2, b) and store.admit("t", a) == (2, b) and store.at("t", 1) == a
    kinds = ["a int, x1 int", "a int, x2 int", "a int, x3 int", "a int, x4 int"]
    threads = [threading.Thread(target=store.admit, args=("t", T._parse_datatype_string(kind))) for kind in kinds]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert set(store.current("t")[1].fieldNames()) == {"a", "b", "x1", "x2", "x3", "x4"}
    with pytest.raises(KeyError):
        store.at("t", 99)


def test_a_version_that_is_being_written_is_waited_for(spark, place, monkeypatch):
    store, started, write = SchemaStore(spark, place.schemas), threading.Event(), Folders.create_text

    def slow(self, file, text):
        if started.is_set():
            return write(self, file, text)
        path, fs = self._path(file)
        fs.mkdirs(path.getParent())
        stream = fs.create(path, False)
        started.set()
        time.sleep(2)
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    monkeypatch.setattr(Folders, "create_text", slow)
    first = threading.Thread(target=store.admit, args=("slow", T._parse_datatype_string("a int, x1 int")))
    first.start()
    assert started.wait(60)
    store.admit("slow", T._parse_datatype_string("a int, x2 int"))
    first.join()
    assert set(store.current("slow")[1].fieldNames()) == {"a", "x1", "x2"}


def test_a_log_whose_types_change_stays_readable(spark, place):
    runs = [
        "SELECT 1L AS c, 5 AS v, DATE '2024-01-01' AS d",
        "SELECT 2L AS c, 7000000000 AS v, TIMESTAMP_NTZ '2024-01-02 01:00:00' AS d, 'n' AS extra",
        "SELECT 3L AS c, CAST(1.25 AS decimal(10,2)) AS v, DATE '2024-01-03' AS d",
        "SELECT 4L AS c, 'text' AS v, DATE '2024-01-04' AS d",
        "SELECT 5L AS c, 6 AS v, DATE '2024-01-05' AS d",
    ]
    for nth, sql in enumerate(runs):
        assert load_delta(spark.sql(sql), LOAD, place, f"2024/02/0{nth + 1}", WatermarkTable(spark, place.state)).n_rows == 1
    rows = read_delta_log(spark, place, "out")
    assert dict(rows.dtypes) == {"c": "bigint", "v": "string", "d": "timestamp_ntz", "extra": "string"}
    assert sorted((r.c, r.v, r.d.day, r.extra) for r in rows.collect()) == [(1, "5", 1, None), (2, "7000000000", 2, "n"), (3, "1.25", 3, None), (4, "text", 4, None), (5, "6", 5, None)]
    assert ids(read_delta_log(spark, place, "out", ["2024/02/02", "2024/02/04"]), "c") == [2, 4]


def test_files_without_a_schema_version(spark, place):
    """What writers without versions left, of unlike types, beside a versioned run."""
    for name, sql in (("a", "SELECT 1L AS c, 1 AS v"), ("b", "SELECT 2L AS c, 'x' AS v, 5 AS w")):
        write_files(spark.sql(sql), f"{place.delta('out', DAY)}/{name}", "overwrite")
    rows = read_delta_log(spark, place, "out")
    assert sorted((r.c, r.v, r.w) for r in rows.collect()) == [(1, "1", None), (2, "x", 5)]
    load_delta(spark.sql("SELECT 3L AS c, 2.5D AS v"), LOAD, place, DAY, WatermarkTable(spark, place.state))
    assert sorted((r.c, r.v) for r in read_delta_log(spark, place, "out").collect()) == [(1, "1"), (2, "x"), (3, "2.5")]


def test_a_second_try_under_a_wider_schema(spark, place):
    state = WatermarkTable(spark, place.state)
    real = WatermarkTable.advance
    try:  # the first try lands its file and dies before the cursor is saved
        WatermarkTable.advance = lambda *given, **named: (_ for _ in ()).throw(OSError("boom"))
        with pytest.raises(OSError):
            load_delta(spark.sql("SELECT 1L AS c, 1 AS v"), LOAD, place, DAY, state, run_id="r")
    finally:
        WatermarkTable.advance = real
    load_delta(spark.sql("SELECT 1L AS c, 'wide' AS v"), LOAD, place, DAY, state, run_id="r")
    assert [tuple(r) for r in read_delta_log(spark, place, "out").collect()] == [(1, "wide")]


def test_declared_types_keep_what_does_not_fit(spark, place):
    rows = spark.sql("SELECT id AS c, CASE WHEN id % 3 = 0 THEN 'odd' ELSE CAST(id AS string) END AS n, '2024-01-0x' AS d FROM range(9)")
    load = replace(LOAD, column_types=(("n", "int"), ("d", "date")))
    landed = load_delta(rows.withColumn("d", F.expr("IF(c = 4, d, '2024-01-02')")), load, place, DAY, WatermarkTable(spark, place.state))
    assert (landed.n_rows, landed.n_rejected) == (9, 4)
    found = {r.c: (r.n, r._rejected and json.loads(r._rejected)) for r in read_delta_log(spark, place, "out").collect()}
    assert found[0] == (None, {"n": "odd"}) and found[4] == (4, {"d": "2024-01-0x"}) and found[5] == (5, None)
    full = load_full(rows, FullLoad("d", "s", "t", column_types=(("n", "int"),)), place, DAY, SnapshotWriter())
    assert (full.n_rows, full.n_rejected) == (9, 3)
    for bad, message in (((("nope", "int"),), "not read"), ((("c", "int"),), "cursor column")):
        with pytest.raises(ValueError, match=message):
            load_delta(rows, replace(LOAD, column_types=bad), place, DAY, WatermarkTable(spark, place.state))
    with pytest.raises(ValueError, match="_rejected"):
        conform(rows, T._parse_datatype_string("_rejected string"), "reject")


def test_batches_merge_under_the_narrowest_schema(spark):
    merged = merge_batches([spark.sql("SELECT 1 AS a, 'x' AS b"), spark.sql("SELECT 2L AS a, 3 AS c")])
    assert dict(merged.dtypes) == {"a": "bigint", "b": "string", "c": "int"}
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "x", None), (2, None, 3)]


# ---- file bounds


def pushed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_files_below_the_mark_are_not_opened(spark, place):
    state = WatermarkTable(spark, place.state)
    rng = random.Random(2)
    rows = [(nth, nth + rng.randrange(3)) for nth in range(400)]
    for until in (100, 200, 300, 400):
        frame = spark.createDataFrame(rows[:until], "id long, c long").repartitionByRange(4, "c")
        load_delta(frame, LOAD, place, DAY, state, manifest=True)
    whole = read_delta_log(spark, place, "out")
    for mark in (-1, 0, 57, 250, 399, 10_000, None):
        found = read_above(spark, place, LOAD, mark)
        assert ids(found) == ids(whole if mark is None else whole.filter(F.col("c") > mark))
        if mark == 250:
            assert 0 < len(found.inputFiles()) < len(whole.inputFiles()) / 2
            assert "GreaterThan(c,250)" in pushed(found)
        if mark == 10_000:
            assert found.inputFiles() == []
    bounds = log_bounds(spark, place, "out", "c")
    assert bounds.inputFiles() and all("/_manifest/" in file for file in bounds.inputFiles())
    row = bounds.first()
    top = whole.agg(F.min("c"), F.max("c"), F.count("*")).first()
    assert tuple(row) == tuple(top)


def test_runs_without_bounds_are_read(spark, place):
    state = WatermarkTable(spark, place.state)
    for until, bounds in ((10, False), (20, True), (30, False)):
        load_delta(spark.range(until).select("id", F.col("id").alias("c")), LOAD, place, DAY, state, manifest=bounds)
    write_files(spark.range(90, 93).select("id", F.col("id").alias("c")), f"{place.delta('out', DAY)}/loose", "overwrite")
    assert ids(read_above(spark, place, LOAD, 14)) == [*range(15, 30), 90, 91, 92]
    with pytest.raises(ValueError, match="no manifest"):
        log_bounds(spark, place, "out", "c")


def test_bounds_outlast_a_wider_type(spark, place):
    state = WatermarkTable(spark, place.state)
    for until, kind in ((8, "int"), (12, "bigint"), (101, "decimal(20,2)")):
        load_delta(spark.range(until).selectExpr("id", f"CAST(id AS {kind}) AS c"), LOAD, place, DAY, state, manifest=True)
    assert ids(read_above(spark, place, LOAD, Decimal("9.5"))) == list(range(10, 101))
    assert log_bounds(spark, place, "out", "c").first().hi == 100


def test_null_cursors_and_the_pushed_filter_of_the_registered_query(spark):
    found = QUERIES["null_cursor_dropped"](spark, "/root/testdata/sf0.001")
    plan = pushed(found)
    assert "Or(GreaterThan(created_at,1970-01-01T00:00),GreaterThan(updated_at,1970-01-01T00:00))" in plan and "Join" not in plan
    skipping = QUERIES["increment_of_log"](spark, "/root/testdata/sf0.001")
    assert "GreaterThan(ts," in pushed(skipping) and all("run1" not in file for file in skipping.inputFiles())
    assert pushed(QUERIES["cursor_bounds"](spark, "/root/testdata/sf0.001")).count("Join") <= 2  # one join, named twice by an adaptive plan


def test_null_keys_are_keys(spark):
    snapshot = spark.createDataFrame([(1, 1, "a"), (None, 1, "b")], "k int, c int, v string")
    delta = spark.createDataFrame([(None, 2, "n"), (2, 1, "z")], "k int, c int, v string")
    for unique in (False, True):
        found = current_state(snapshot, delta, ["k"], "c", unique_snapshot=unique)
        assert sorted((r.k or 0, r.c, r.v) for r in found.collect()) == [(0, 2, "n"), (1, 1, "a"), (2, 1, "z")]


def test_run_marks_round_trip():
    assert landing.run_of_mark(landing.run_mark("2024/01/31/", "a b%c")) == "2024/01/31/a b%c"
