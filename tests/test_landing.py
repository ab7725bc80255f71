import os
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from snapdelta.config import DeltaLoad, FullLoad
from snapdelta.plans.loads import load_delta, load_full
from snapdelta.sinks.folders import Folders
from snapdelta.sinks.landing import SnapshotWriter, append_snapshot, replace_snapshot, write_files, write_run
from snapdelta.sinks.layout import Layout
from snapdelta.sources.landed import read_delta_log, read_snapshot, read_snapshot_folder
from snapdelta.sources.tables import frames
from snapdelta.state.watermark import (
    WatermarkTable,
    current_watermarks,
    state_key,
    state_key_column,
    stored_text,
)

DAY = "2024/01/31"


@pytest.fixture
def place(tmp_path):
    return Layout(str(tmp_path))


def ids(frame):
    return sorted(r[0] for r in frame.collect())


def test_replace_swaps_whole_snapshots(spark, tmp_path):
    folder = str(tmp_path / "t" / "day")
    assert replace_snapshot(spark.range(5), folder) == 5
    assert replace_snapshot(spark.range(3).toDF("id"), folder) == 3
    assert ids(read_snapshot_folder(spark, folder)) == [0, 1, 2]
    assert append_snapshot(spark.range(2), folder) == 2
    assert ids(read_snapshot_folder(spark, folder)) == [0, 0, 1, 1, 2]


def test_a_failed_write_leaves_the_old_snapshot(spark, tmp_path):
    folder = str(tmp_path / "t" / "day")
    replace_snapshot(spark.range(5), folder)
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        replace_snapshot(broken, folder)
    assert ids(read_snapshot_folder(spark, folder)) == [0, 1, 2, 3, 4]
    assert len([name for name in os.listdir(folder) if name.startswith("run-")]) == 1


def test_a_delta_log_keeps_new_columns(spark, tmp_path):
    place = Layout(str(tmp_path))
    write_run(spark.sql("SELECT 1 AS c, 'a' AS v"), f"{place.delta('t', '2024/01/30')}/run1")
    write_run(spark.sql("SELECT 2 AS c, 'b' AS v, 'x' AS extra"), f"{place.delta('t', '2024/01/31')}/run2")
    rows = read_delta_log(spark, place, "t").orderBy("c").collect()
    assert [row.asDict() for row in rows] == [{"c": 1, "v": "a", "extra": None}, {"c": 2, "v": "b", "extra": "x"}]


def test_a_snapshot_can_be_rebuilt_from_itself(spark, tmp_path):
    folder = str(tmp_path / "day")
    replace_snapshot(spark.range(5), folder)
    replace_snapshot(read_snapshot_folder(spark, folder).filter("id > 2"), folder)
    assert ids(read_snapshot_folder(spark, folder)) == [3, 4]


def test_first_writer_replaces_and_the_next_adds(spark, tmp_path):
    folder = str(tmp_path / "day")
    replace_snapshot(spark.range(100, 105), folder)
    writer = SnapshotWriter()
    writer.write(spark.range(2), folder)
    writer.write(spark.range(2, 4), folder)
    assert ids(read_snapshot_folder(spark, folder)) == [0, 1, 2, 3]
    # A writer whose first load failed has not replaced anything yet.
    failing = SnapshotWriter()
    with pytest.raises(Exception):
        failing.write(spark.range(1).select(F.raise_error(F.lit("boom"))), folder)
    failing.write(spark.range(9, 10), folder)
    assert ids(read_snapshot_folder(spark, folder)) == [9]
    SnapshotWriter(keep_existing=True).write(spark.range(1), folder)
    assert ids(read_snapshot_folder(spark, folder)) == [0, 9]


def test_in_place_replacement(spark, tmp_path):
    folder = str(tmp_path / "day")
    replace_snapshot(spark.range(5), folder, in_place=True)
    assert replace_snapshot(spark.range(2), folder, in_place=True) == 2
    assert ids(read_snapshot_folder(spark, folder)) == [0, 1]


def test_empty_snapshot_is_readable(spark, tmp_path):
    folder = str(tmp_path / "day")
    replace_snapshot(spark.range(5), folder)
    assert replace_snapshot(spark.range(0), folder) == 0
    assert read_snapshot_folder(spark, folder).count() == 0


def test_metrics_are_taken_during_the_write(spark, tmp_path):
    found = write_files(spark.range(10), str(tmp_path / "x"), "overwrite", high=F.max("id").cast("string"))
    assert found == {"n_rows": 10, "high": "9"}
    empty = write_files(spark.range(0), str(tmp_path / "y"), "overwrite", high=F.max("id"))
    assert empty == {"n_rows": 0, "high": None}


def test_rows_per_file(spark, tmp_path):
    write_files(spark.range(0, 100, 1, 1), str(tmp_path / "x"), "overwrite", rows_per_file=30)
    assert len([f for f in os.listdir(tmp_path / "x") if f.endswith(".parquet")]) == 4


def test_full_load_has_no_shuffle(spark, place):
    rows = spark.range(100).withColumn("sender_user_id", F.col("id"))
    load = FullLoad("d", "s", "t", "out", columns=("id", "sender_user_id"))
    assert load_full(frames({"t": rows})(load), load, place, DAY, SnapshotWriter()).n_rows == 100
    landed = read_snapshot(spark, place, "out", DAY)
    assert dict(landed.dtypes)["sender_user_id"] == "string"
    plan = frames({"t": rows})(load)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


LOAD = DeltaLoad("d", "s", "t", "out", columns=("id", "c"), cursor_column="c")


def run(spark, place, rows, **options):
    return load_delta(rows, LOAD, place, DAY, WatermarkTable(spark, place.state), **options)


@pytest.mark.parametrize(
    "data_type, first, second",
    [
        ("bigint", 5, 6),
        ("string", "b", "c"),
        ("date", date(2024, 1, 1), date(2024, 1, 2)),
        ("decimal(12,3)", Decimal("1.001"), Decimal("1.002")),
        ("double", 0.1, 0.2),
        ("timestamp_ntz", datetime(2024, 1, 1, 0, 0, 0, 1), datetime(2024, 1, 1, 0, 0, 0, 2)),
        ("timestamp", datetime(2024, 1, 1, 0, 0, 0, 1, timezone.utc), datetime(2024, 1, 1, 0, 0, 0, 2, timezone.utc)),
    ],
)
def test_second_run_loads_only_what_is_above(spark, place, data_type, first, second):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("c", T._parse_datatype_string(data_type))])
    one = spark.createDataFrame([(1, first), (2, None)], schema)
    two = spark.createDataFrame([(1, first), (3, second), (2, None)], schema)
    assert run(spark, place, one).n_rows == 2  # no floor: the row without a cursor is read once
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert run(spark, place, two).n_rows == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert run(spark, place, two, run_id="empty").n_rows == 0
    assert not Folders(spark).exists(f"{place.delta('out', DAY)}/empty")
    assert ids(read_delta_log(spark, place, "out")) == [1, 2, 3]
    key = state_key("snapdelta", "delta", "d", "s", "out")
    assert WatermarkTable(spark, place.state).saved(key).version == 2


def test_random_histories_load_every_row_above_the_floor_once(spark, tmp_path):
    import random

    for seed in range(3):
        place = Layout(str(tmp_path / str(seed)))
        chance = random.Random(seed)
        seen, high, wanted = [], 3, []
        for _ in range(4):
            arrivals = [(len(seen) + i, chance.choice([None, *range(12 + 3 * len(seen))])) for i in range(chance.randrange(6))]
            seen += arrivals
            kept = [row for row in seen if row[1] is not None and row[1] > high]
            frame = spark.createDataFrame(seen, "id bigint, c bigint")
            assert run(spark, place, frame, floor="3").n_rows == len(kept)
            wanted += [row[0] for row in kept]
            high = max([row[1] for row in kept], default=high)
        if wanted:
            assert ids(read_delta_log(spark, place, "out")) == sorted(wanted)


def test_a_second_try_of_a_run_replaces_the_first(spark, place):
    frame = spark.createDataFrame([(1, 5), (2, 6)], "id bigint, c bigint")
    # The first try wrote its files and was lost before it saved the cursor.
    write_files(frame, f"{place.delta('out', DAY)}/run-1", "overwrite")
    assert run(spark, place, frame, run_id="run-1").n_rows == 2
    assert ids(read_delta_log(spark, place, "out")) == [1, 2]
    with pytest.raises(ValueError, match="already complete"):
        run(spark, place, frame, run_id="run-1")
    assert ids(read_delta_log(spark, place, "out")) == [1, 2]


def test_reset_reads_from_the_floor_again(spark, place):
    frame = spark.createDataFrame([(1, 5), (2, 6)], "id bigint, c bigint")
    state = WatermarkTable(spark, place.state)
    key = state_key("snapdelta", "delta", "d", "s", "out")
    assert state.lookup(key) is None
    run(spark, place, frame)
    assert state.lookup(key) == 6
    state.reset(key)
    assert state.lookup(key) is None and state.saved(key).version == 2
    again = run(spark, place, frame, floor=5)
    assert (again.n_rows, again.cutoff, again.mode) == (1, 5, "incremental")
    assert state.lookup(key) == 6


def test_the_cursor_never_moves_back_and_empty_runs_keep_it(spark, place):
    state = WatermarkTable(spark, place.state)
    state.advance("k", "7", "bigint", 3, "r1")
    state.advance("k", "5", "bigint", 3, "r2")
    state.advance("k", None, "bigint", 3, "r3")
    state.advance("k", "9", "bigint", 0, "r4")
    assert (state.lookup("k"), state.history("k").count()) == (7, 1)
    odd = "a b=c/d%e"
    state.advance(odd, "2024-01-01", "date", 1, "r")
    assert state.lookup(odd) == date(2024, 1, 1) and state.lookup("other") is None
    assert {r.state_key: r.last_value for r in current_watermarks(state.history()).collect()} == {
        "k": "7",
        odd: "2024-01-01",
    }


def test_increments_are_gathered_into_few_files(spark, place):
    wide = spark.range(0, 1000, 1, 50).select("id", F.col("id").alias("c"))
    run(spark, place, wide.filter("id < 900"), run_id="first")
    run(spark, place, wide, run_id="second")
    parts = [f for f in os.listdir(f"{place.delta('out', DAY)}/second") if f.endswith(".parquet")]
    assert len(parts) == 1
    landed = spark.read.parquet(f"{place.delta('out', DAY)}/second")
    assert [r.c for r in landed.collect()] == list(range(900, 1000))


def test_first_loads_are_sorted_on_request(spark, place):
    backwards = spark.range(0, 100, 1, 1).select("id", (-F.col("id")).alias("c"))
    run(spark, place, backwards, run_id="first", order_first_load=True)
    landed = spark.read.parquet(f"{place.delta('out', DAY)}/first")
    assert [r.c for r in landed.collect()] == list(range(-99, 1))


def test_state_keys(spark):
    cases = [("-a.b-", "DELTA", "x-y", "public", "t_"), ("a", "full", "x|y", "p\\", "q"), ("a", "full", "x", "y|p\\", "q"), ("a", "full", "x", "a-b", ""), ("a", "full", "x", "a_b", "")]
    keys = [state_key(*case) for case in cases]
    assert keys[0] == "-a.b-|delta|x-y|public|t_" and len(set(keys)) == len(cases)
    frame = spark.createDataFrame(cases, "a string, b string, c string, d string, e string")
    columns = [F.col(c) for c in "abcde"]
    assert [r[0] for r in frame.select(state_key_column(*columns)).collect()] == keys


def test_instants_are_stored_in_utc(spark):
    frame = spark.sql("SELECT timestamp '2024-01-01 00:00:00 UTC' AS c")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert frame.select(stored_text(F.max("c"), T.TimestampType())).first()[0] == "2024-01-01 00:00:00+00:00"
        # an hour that clocks show twice, a fraction, and a time before 1970
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        for instant in ("2024-10-27 00:30:00", "2024-10-27 01:30:00", "2024-10-27 01:30:00.000007", "1969-12-31 23:59:59.5"):
            text = spark.sql(f"SELECT timestamp '{instant} UTC' AS c").select(stored_text(F.max("c"), T.TimestampType())).first()[0]
            assert text == f"{instant}+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_missing_delta_log_is_an_error(spark, place):
    with pytest.raises(FileNotFoundError):
        read_delta_log(spark, place, "nothing")
    assert not Folders(spark).exists(place.delta_log("nothing"))
