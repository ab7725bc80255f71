import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from snapdelta import main
from snapdelta.config import DeltaLoad, FullLoad
from snapdelta.plans import job as jobs
from snapdelta.plans.job import JobSettings, PhaseSettings, load_log, run_job, settings_from, write_run_summary
from snapdelta.session import shared_root, work_folder
from snapdelta.sinks.layout import Layout
from snapdelta.sources.landed import read_delta_log, read_snapshot
from snapdelta.sources.tables import frames
from snapdelta.state.watermark import WatermarkTable
from snapdelta.streaming.landing import file_stream, land_stream

DAY = "2024/01/31"
FULL = [FullLoad("a", "s", "t"), FullLoad("a", "s", "missing"), FullLoad("b", "s", "u", "t2")]
DELTA = [DeltaLoad("a", "s", "t", "td", cursor_column="id", initial_value="1")]


@pytest.fixture
def place(tmp_path):
    return Layout(str(tmp_path))


@pytest.fixture
def source(spark):
    return frames({"t": spark.range(5), "u": spark.range(7)})


def statuses(outcomes):
    return [(o.load_type, o.table_name, o.status, o.n_rows) for o in outcomes]


def test_a_failure_stays_with_its_table(spark, place, source):
    outcomes = run_job(spark, source, place, JobSettings(DAY), FULL, DELTA)
    assert statuses(outcomes) == [
        ("FULL", "t", "ok", 5),
        ("FULL", "missing", "failed", None),
        ("FULL", "t2", "ok", 7),
        ("DELTA", "td", "ok", 3),
    ]
    assert outcomes[1].entry == "a.s.missing: KeyError: 'missing'"
    assert read_snapshot(spark, place, "t2", DAY).count() == 7
    log = load_log(spark, outcomes)
    lines = []
    folder = write_run_summary(log, place, DAY, "job", job_name="nightly")
    for row in spark.read.text(folder).collect():
        lines.append(json.loads(row.value))
    run = next(line for line in lines if line["kind"] == "run")
    assert (run["status"], run["exit_code"], run["job_name"]) == ("FAILED (full_failed=1)", 0, "nightly")
    assert {line["phase"]: line["n_rows"] for line in lines if line["kind"] == "phase"} == {"FULL": 12, "DELTA": 3, "ALL": 15}
    (failure,) = [line for line in lines if line["kind"] == "failure"]
    assert failure["table_ref"] == "a.s.missing" and "KeyError" in failure["error"]


def test_reruns_replace_snapshots_and_add_increments(spark, place, source):
    for _ in range(2):
        outcomes = run_job(spark, source, place, JobSettings(DAY), FULL[:1], DELTA)
    assert statuses(outcomes) == [("FULL", "t", "ok", 5), ("DELTA", "td", "ok", 0)]
    assert read_snapshot(spark, place, "t", DAY).count() == 5
    assert read_delta_log(spark, place, "td").count() == 3


def test_shared_output(spark, place, source):
    both = [FullLoad("a", "s", "t", "out"), FullLoad("a", "s", "u", "out")]
    for _ in range(2):
        run_job(spark, source, place, JobSettings(DAY), both)
    assert read_snapshot(spark, place, "out", DAY).count() == 12


def test_modes_and_empty_selection(spark, place, source):
    assert len(run_job(spark, source, place, JobSettings(DAY, mode="full"), FULL[:1], DELTA)) == 1
    assert len(run_job(spark, source, place, JobSettings(DAY, mode="delta"), FULL[:1], DELTA)) == 1
    with pytest.raises(ValueError, match="no enabled tables"):
        run_job(spark, source, place, JobSettings(DAY, mode="delta"), FULL, [])
    with pytest.raises(ValueError, match="mode must be"):
        JobSettings(DAY, mode="all")


def test_stop_on_failure_skips_what_has_not_started(spark, place, source):
    settings = JobSettings(DAY, full=PhaseSettings(parallel_tables=1, stop_on_failure=True))
    outcomes = run_job(spark, source, place, settings, FULL[1:], DELTA)
    assert [o.status for o in outcomes] == ["failed", "skipped", "ok"]


@pytest.mark.parametrize("message, tries", [("connection reset by peer", 3), ("syntax error at or near", 1)])
def test_only_passing_faults_are_tried_again(spark, place, message, tries, monkeypatch):
    monkeypatch.setattr(jobs.time, "sleep", lambda seconds: None)
    calls = []

    def flaky(load):
        calls.append(load)
        if len(calls) < 3:
            raise RuntimeError(message)
        return spark.range(4)

    outcomes = run_job(spark, flaky, place, JobSettings(DAY, full=PhaseSettings(attempts=3)), FULL[:1])
    assert len(calls) == tries
    assert outcomes[0].status == ("ok" if tries == 3 else "failed")


EVENTS = DeltaLoad("d", "s", "events", cursor_column="ts")


def stream_once(spark, place, folder, checkpoint, floor="0"):
    source = file_stream(spark, folder, spark.range(1).withColumnRenamed("id", "ts").schema, files_per_batch=1)
    land_stream(source, EVENTS, place, DAY, checkpoint, WatermarkTable(spark, place.state), floor=floor).awaitTermination()


def test_stream_reads_each_file_once(spark, place, tmp_path):
    arrived, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    for low, high in ((0, 10), (20, 30), (10, 20)):
        spark.range(low, high, 1, 2).withColumnRenamed("id", "ts").write.parquet(f"{arrived}/{low}")
        for _ in range(2):
            stream_once(spark, place, arrived, checkpoint)
    landed = sorted(r.ts for r in read_delta_log(spark, place, "events").collect())
    # 0 is the floor. Rows 10 to 19 came after 29 and are kept.
    assert landed == list(range(1, 30))
    key = "snapdelta|delta|d|s|events"
    assert WatermarkTable(spark, place.state).lookup(key) == 29


def test_a_repeated_batch_replaces_itself(spark, place, tmp_path):
    arrived, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    spark.range(5).withColumnRenamed("id", "ts").coalesce(1).write.parquet(arrived)
    stream_once(spark, place, arrived, checkpoint, floor=None)
    # As if the driver had died after the batch's write, before Spark noted it as done.
    for name in ("0", ".0.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    stream_once(spark, place, arrived, checkpoint, floor=None)
    assert read_delta_log(spark, place, "events").count() == 5
    # Another stream into the same table keeps out of the first one's folders.
    stream_once(spark, place, arrived, str(tmp_path / "other"), floor=None)
    assert read_delta_log(spark, place, "events").count() == 10


def test_equal_configs_do_not_overwrite_each_other(spark, place, source):
    outcomes = run_job(spark, source, place, JobSettings(DAY), (), DELTA * 2)
    assert [o.n_rows for o in outcomes] == [3, 0]
    assert read_delta_log(spark, place, "td").count() == 3


def test_many_tables_at_once_keep_their_state_apart(spark, place, source):
    loads = [DeltaLoad("a", "s", "t", f"out{i}", cursor_column="id") for i in range(16)]
    settings = JobSettings(DAY, delta=PhaseSettings(parallel_tables=16))
    for rows in (4, 0):
        outcomes = run_job(spark, source, place, replace(settings, floor="0"), (), loads)
        assert [(o.status, o.n_rows) for o in outcomes] == [("ok", rows)] * 16
    keys = [f"snapdelta|delta|a|s|out{i}" for i in range(16)]
    state = WatermarkTable(spark, place.state)
    assert sorted(r.state_key for r in state.history().collect()) == sorted(keys)
    assert {state.lookup(key) for key in keys} == {4}


def test_hooks_are_plain_functions_around_a_source(spark, place, source):
    def hooked(load):
        return source(load).filter("id > 2")

    assert run_job(spark, hooked, place, JobSettings(DAY), FULL[:1])[0].n_rows == 2


def test_batch_runs_go_on_from_a_stream(spark, place, tmp_path):
    arrived = str(tmp_path / "in")
    spark.range(5).withColumnRenamed("id", "ts").write.parquet(arrived)
    stream_once(spark, place, arrived, str(tmp_path / "check"), floor=None)
    source = frames({"events": spark.range(8).withColumnRenamed("id", "ts")})
    outcomes = run_job(spark, source, place, JobSettings(DAY, floor=None), (), [EVENTS])
    assert outcomes[0].n_rows == 3


def test_work_folders_need_a_shared_root_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        def __init__(self, conf, folder=None):
            self.conf, self.folder = conf, folder

        def getConf(self):
            return self.conf

        def getCheckpointDir(self):
            return self.folder

    class Session:
        def __init__(self, context):
            self.sparkContext = context

    assert shared_root(Session(Context({"spark.checkpoint.dir": "hdfs://x/check/"}))) == "hdfs://x/check"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session(Context({})))
    first, second = work_folder(spark, "a"), work_folder(spark, "a")
    assert first != second and first.startswith(shared_root(spark))


def test_partition_count_does_not_change_the_rows(spark):
    path = "/root/testdata/sf0.01/orders.parquet"
    whole = spark.read.parquet(path)
    total = [F.sum(F.xxhash64(*whole.columns).cast("decimal(38,0)")), F.count("*")]
    expected, parts = whole.agg(*total).first(), whole.rdd.getNumPartitions()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
        cut = spark.read.parquet(path)
        assert cut.rdd.getNumPartitions() > parts
        assert cut.agg(*total).first() == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_settings_document():
    document = {
        "pipeline": {"name": "nightly"},
        "snapshot": {"delete_existing_full_load_snapshot": False},
        "delta": {"initial_cursor_value": "2020-01-01"},
        "runtime": {"max_workers_full": 2, "full_load_max_attempts": 3, "delta_load_fail_fast": True, "exit_on_table_failures": True},
    }
    settings = settings_from(document, DAY, "full")
    assert (settings.base_name, settings.floor, settings.mode) == ("nightly", "2020-01-01", "full")
    assert settings.keep_existing_snapshot and settings.exit_on_failures
    assert settings.full == PhaseSettings(2, 3)
    assert settings.delta == PhaseSettings(4, 3, stop_on_failure=True)
    assert settings_from({}, DAY).floor is None


def test_command_line(spark, tmp_path):
    configs = tmp_path / "configs"
    for mode, entry in (
        ("full_load", {"schema": "public", "table": "orders", "columns": ["o_orderkey", "o_orderdate"]}),
        ("delta_load", {"schema": "public", "table": "orders", "cursor_column": "o_orderdate"}),
    ):
        (configs / mode).mkdir(parents=True)
        (configs / mode / "shop.json").write_text(json.dumps({"tables": [entry]}))
    arguments = ["--configs", str(configs), "--parquet", "/root/testdata/sf0.001", "--root", str(tmp_path / "out"), "--day", DAY]
    assert main.run(spark, [*arguments, "--summary-id", "job-1"]) == 0
    place = Layout(str(tmp_path / "out"))
    assert read_snapshot(spark, place, "orders", DAY).columns == ["o_orderkey", "o_orderdate"]
    total = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert read_delta_log(spark, place, "orders").count() == total
    assert spark.read.json(place.summary(DAY, "job-1")).count() == 4
    assert main.run(spark, [*arguments, "--mode", "delta"]) == 0
    assert read_delta_log(spark, place, "orders").count() == total
    with pytest.raises(ValueError, match="no tables selected"):
        main.run(spark, [*arguments, "--table", "nothing"])
    settings = tmp_path / "settings.json"
    settings.write_text(json.dumps({"runtime": {"exit_on_table_failures": True}}))
    wrong = [*arguments[:2], "--parquet", str(tmp_path), *arguments[4:]]
    assert main.run(spark, [*wrong, "--settings", str(settings)]) == 1
