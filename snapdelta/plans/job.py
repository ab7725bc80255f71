"""A whole run: all snapshots, then all increments, one outcome row per table."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapdelta.config import DeltaLoad, FullLoad
from snapdelta.operators.compact import union_outputs
from snapdelta.operators.failures import cause_chain, error_class
from snapdelta.operators.metrics import FAILED, OK, SKIPPED, run_rollup, run_status
from snapdelta.plans.loads import Landed, load_delta, load_full
from snapdelta.sinks.landing import SnapshotWriter
from snapdelta.sinks.layout import Layout, snapshot_date
from snapdelta.sources.tables import Source
from snapdelta.state.watermark import WatermarkTable

LOG_SCHEMA = (
    "load_type string, database string, schema string, table_name string, status string, "
    "seconds double, n_rows bigint, error string, mode string, cutoff string, low string, high string, "
    "n_rejected bigint, causes array<struct<exc_type string, message string>>"
)


@dataclass(frozen=True)
class Outcome:
    load_type: str
    database: str
    schema: str
    table_name: str
    status: str
    seconds: float = 0.0
    n_rows: int | None = None
    error: str | None = None
    mode: str | None = None
    cutoff: str | None = None
    low: str | None = None
    high: str | None = None
    n_rejected: int | None = None
    causes: tuple[tuple[str, str], ...] = ()

    @property
    def entry(self) -> str:
        return f"{self.database}.{self.schema}.{self.table_name}: {self.error}"


@dataclass(frozen=True)
class PhaseSettings:
    """Tables run ``parallel_tables`` at a time, so that a small table's last tasks do not leave the
    cluster idle. Only passing faults are tried again. Each table's Spark jobs carry a tag of its own, and run in
    the scheduler ``pool`` if one is named; a table that takes longer than ``table_timeout_seconds`` has its jobs
    cancelled and fails, the others go on."""

    parallel_tables: int = 4
    attempts: int = 1
    retry_delay_seconds: float = 20.0
    stop_on_failure: bool = False
    table_timeout_seconds: float | None = None
    pool: str | None = None


@dataclass(frozen=True)
class JobSettings:
    """``mode`` is ``full``, ``delta`` or ``both``; ``floor`` is where first increments start."""

    day: str
    mode: str = "both"
    base_name: str = "snapdelta"
    floor: object = "1970-01-01T00:00:00"
    keep_existing_snapshot: bool = False
    replace_in_place: bool = False
    full: PhaseSettings = PhaseSettings()
    delta: PhaseSettings = PhaseSettings()
    exit_on_failures: bool = False
    rows_per_file: int = 0
    order_first_load: bool = False
    file_manifest: bool = False

    def __post_init__(self):
        if self.mode not in ("full", "delta", "both"):
            raise ValueError(f"mode must be full, delta or both, not {self.mode!r}")


def day_from(document: dict) -> str:
    """The date part of the paths, by the document's ``snapshot`` section."""
    snapshot = document.get("snapshot") or {}
    return snapshot_date(snapshot.get("mode") or "current_date", snapshot.get("date_format") or "%Y/%m/%d")


def layout_from(document: dict, root: str, dataset: str | None = None) -> Layout:
    """The folders that a settings document names (sections ``pipeline`` and ``destination``).

    A layout's last part, if it names files, is left to the writer. Files are Parquet.
    """
    pipeline, destination = (document.get(name) or {} for name in ("pipeline", "destination"))
    kind = destination.get("file_format") or "parquet"
    if kind != "parquet":
        raise ValueError(f"unsupported file format: {kind}")

    def template(name: str, default: str) -> str:
        folders, _, last = (destination.get(name) or default).strip("/").rpartition("/")
        found = folders if any(part in last for part in ("{file_id}", "{load_id}", "{ext}")) else f"{folders}/{last}".strip("/")
        if "{table_name}" not in found.split("{snapshot_date}")[0]:
            raise ValueError(f"{name} must hold {{table_name}}, before any {{snapshot_date}}: {found}")
        return found

    return Layout(
        root,
        dataset or pipeline.get("dataset_name") or Layout.dataset,
        template("full_load_layout", Layout.full_template),
        template("delta_load_layout", Layout.delta_template),
    )


def settings_from(document: dict, day: str | None = None, mode: str = "both") -> JobSettings:
    """Job settings from a settings document (sections ``pipeline``, ``snapshot``, ``delta``, ``runtime``)."""
    runtime = document.get("runtime") or {}
    snapshot = document.get("snapshot") or {}

    def given(key: str, default):
        value = runtime.get(key)
        return default if value is None else value

    def phase(name: str, fallback: PhaseSettings) -> PhaseSettings:
        timeout = given(f"{name}_load_table_timeout_seconds", fallback.table_timeout_seconds)
        return PhaseSettings(
            int(given(f"max_workers_{name}", 4)),
            int(given(f"{name}_load_max_attempts", fallback.attempts)),
            float(given(f"{name}_load_retry_delay_seconds", fallback.retry_delay_seconds)),
            bool(given(f"{name}_load_fail_fast", False)),
            None if timeout is None else float(timeout),
            given(f"{name}_load_pool", fallback.pool),
        )

    full = phase("full", PhaseSettings())
    replaces = snapshot.get("delete_existing_full_load_snapshot", True)
    return JobSettings(
        day=day or day_from(document),
        mode=mode,
        base_name=(document.get("pipeline") or {}).get("name", "snapdelta"),
        floor=(document.get("delta") or {}).get("initial_cursor_value"),
        keep_existing_snapshot=bool(runtime.get("skip_delete_existing_snapshot") or not replaces),
        replace_in_place=bool(given("replace_in_place", False)),
        full=full,
        delta=phase("delta", full),
        exit_on_failures=bool(runtime.get("exit_on_table_failures")),
        rows_per_file=int(given("rows_per_file", 0)),
        order_first_load=bool(given("order_first_load", False)),
        file_manifest=bool(given("file_manifest", False)),
    )


class TableTimeout(RuntimeError):
    """A table whose jobs were cancelled because it took too long."""


@contextmanager
def _watched(spark: SparkSession, settings: PhaseSettings, label: str) -> Iterator[None]:
    """Run a table's Spark jobs under a tag, and cancel them when its time is up."""
    context, tag, late = spark.sparkContext, f"table-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        # jobs that start between two looks are met by the next one
        while not done.wait(0.2):
            context.cancelJobsWithTag(tag)

    done = threading.Event()
    timer = threading.Timer(settings.table_timeout_seconds, stop) if settings.table_timeout_seconds else None
    context.addJobTag(tag)
    if settings.pool:
        context.setLocalProperty("spark.scheduler.pool", settings.pool)
    if timer:
        timer.daemon = True
        timer.start()
    try:
        yield
    except Exception as error:
        if late.is_set():
            raise TableTimeout(f"{label}: cancelled after {settings.table_timeout_seconds:g} s") from error
        raise
    finally:
        done.set()
        if timer:
            timer.cancel()
        context.removeJobTag(tag)
        if settings.pool:
            context.setLocalProperty("spark.scheduler.pool", None)


def _attempt(spark: SparkSession, settings: PhaseSettings, load_once) -> Landed:
    for attempt in range(1, max(1, settings.attempts) + 1):
        try:
            return load_once()
        except Exception as error:
            if attempt >= settings.attempts or isinstance(error, TableTimeout) or error_class(error) != "transient":
                raise
            time.sleep(settings.retry_delay_seconds * 2 ** (attempt - 1))


def _phase(
    spark: SparkSession, load_type: str, loads: Sequence[FullLoad], settings: PhaseSettings, load_one
) -> list[Outcome]:
    """Run the loads of one phase. A failure ends its own table only, unless asked to stop."""
    failed: list[str] = []

    def run(load: FullLoad) -> Outcome:
        place = (load_type, load.database, load.schema, load.output_name)
        if settings.stop_on_failure and failed:
            return Outcome(*place, SKIPPED)
        start = time.monotonic()
        try:
            # One run id for all attempts, so that a retry writes over what the first one left.
            run_id = uuid.uuid4().hex
            with _watched(spark, settings, load.label):
                landed = _attempt(spark, settings, lambda: load_one(load, run_id))
        except Exception as error:
            failed.append(load.label)
            spent = time.monotonic() - start
            causes = tuple((type(each).__name__, str(each)) for each in cause_chain(error))
            return Outcome(*place, FAILED, spent, None, f"{type(error).__name__}: {error}", causes=causes)
        cutoff = None if landed.cutoff is None else str(landed.cutoff)
        about = (landed.mode, cutoff, landed.low, landed.high, landed.n_rejected)
        return Outcome(*place, OK, time.monotonic() - start, landed.n_rows, None, *about)

    # Loads that share an output name run one after another, in config order.
    by_output: dict[str, list[FullLoad]] = {}
    for load in loads:
        by_output.setdefault(load.output_name, []).append(load)
    with ThreadPoolExecutor(max(1, settings.parallel_tables)) as pool:
        done = pool.map(lambda group: [run(load) for load in group], by_output.values())
        return [outcome for group in done for outcome in group]


def run_job(
    spark: SparkSession,
    source: Source,
    layout: Layout,
    settings: JobSettings,
    full: Sequence[FullLoad] = (),
    delta: Sequence[DeltaLoad] = (),
) -> list[Outcome]:
    """Snapshots first, then increments. The second phase runs whatever became of the first."""
    full = [load for load in full if load.enabled] if settings.mode != "delta" else []
    delta = [load for load in delta if load.enabled] if settings.mode != "full" else []
    if not full and not delta:
        raise ValueError("no enabled tables to load")
    writer = SnapshotWriter(settings.keep_existing_snapshot, settings.replace_in_place)
    watermarks = WatermarkTable(spark, layout.state)

    def one_full(load: FullLoad, run_id: str) -> Landed:
        return load_full(source(load), load, layout, settings.day, writer, settings.rows_per_file)

    def one_delta(load: DeltaLoad, run_id: str) -> Landed:
        return load_delta(
            source(load),
            load,
            layout,
            settings.day,
            watermarks,
            settings.base_name,
            settings.floor,
            run_id,
            settings.rows_per_file,
            settings.order_first_load,
            settings.file_manifest,
        )

    outcomes = _phase(spark, "FULL", full, settings.full, one_full)
    return outcomes + _phase(spark, "DELTA", delta, settings.delta, one_delta)


def load_log(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    return spark.createDataFrame([astuple(outcome) for outcome in outcomes], LOG_SCHEMA)


def write_run_summary(
    log: DataFrame, layout: Layout, day: str, job_id: str, exit_on_failures: bool = False, **about: str
) -> str:
    """The run as JSON lines: one ``run`` row, one ``phase`` row per phase and one ``failure`` row per
    failed table. ``about`` adds facts of the job, such as its name, to the run row."""
    facts = [F.lit(value).alias(name) for name, value in {"snapshot_date": day, **about}.items()]
    run = run_status(log, exit_on_failures).select(F.lit("run").alias("kind"), *facts, "*")
    phases = run_rollup(log).select(F.lit("phase").alias("kind"), "*")
    label = F.concat_ws(".", "database", "schema", "table_name")
    failures = log.filter(F.col("status") == FAILED).select(
        F.lit("failure").alias("kind"), "load_type", label.alias("table_ref"), "error"
    )
    folder = layout.summary(day, job_id)
    union_outputs([run, phases, failures]).write.mode("overwrite").json(folder)
    return folder
