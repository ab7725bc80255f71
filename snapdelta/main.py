"""Run a load job from config files: ``python -m snapdelta.main --configs ... --root ...``."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

from snapdelta.config import DeltaLoad, read_document, read_loads, select_loads
from snapdelta.plans.job import layout_from, load_log, run_job, settings_from, write_run_summary
from snapdelta.sources.jdbc import connections_from, fetch_rows_from, postgres_tables
from snapdelta.sources.tables import parquet_tables


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="snapdelta")
    parser.add_argument("--configs", required=True, help="folder with full_load/ and delta_load/ config files")
    parser.add_argument("--root", required=True, help="where tables, state and summaries are written")
    parser.add_argument("--dataset", help="folder below the root; by default as the settings name it")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--parquet", help="read <folder>/<table>.parquet")
    source.add_argument("--connections", help="JSON or YAML file: database alias -> connection settings")
    parser.add_argument("--settings", help="JSON or YAML settings document")
    parser.add_argument("--mode", default="both", choices=("full", "delta", "both"))
    parser.add_argument("--database", help="only this alias")
    parser.add_argument("--table", help="only this source table")
    parser.add_argument("--day", help="date part of the paths, e.g. 2024/01/31; by default today as the settings write it")
    parser.add_argument("--rows-per-file", type=int, help="cut files at so many rows")
    parser.add_argument("--order-first-load", action="store_true", help="sort the files of first increments by cursor")
    parser.add_argument("--replace-in-place", action="store_true", help="plain files instead of versioned snapshots")
    parser.add_argument("--file-manifest", action="store_true", help="keep the cursor's bounds per landed file")
    parser.add_argument("--summary-id", help="write a run summary under this id")
    return parser


def run(spark: SparkSession, arguments: list[str]) -> int:
    """Run the job and return the exit code."""
    args = _parser().parse_args(arguments)
    configs = Path(args.configs)
    loads = []
    if args.mode != "delta":
        loads += read_loads(configs / "full_load")
    if args.mode != "full":
        loads += read_loads(configs / "delta_load", delta=True)
    loads = select_loads(loads, args.database, args.table)
    delta = [load for load in loads if isinstance(load, DeltaLoad)]
    full = [load for load in loads if not isinstance(load, DeltaLoad)]

    document = read_document(args.settings) if args.settings else {}
    settings = settings_from(document, args.day, args.mode)
    asked = {name: getattr(args, name) for name in ("rows_per_file", "order_first_load", "replace_in_place", "file_manifest")}
    settings = replace(settings, **{name: value for name, value in asked.items() if value})
    if args.parquet:
        source = parquet_tables(spark, args.parquet)
    else:
        source = postgres_tables(spark, connections_from(read_document(args.connections), document), fetch_rows_from(document))
    layout = layout_from(document, args.root, args.dataset)
    outcomes = run_job(spark, source, layout, settings, full, delta)
    for outcome in outcomes:
        detail = outcome.error or f"rows={outcome.n_rows}"
        print(f"{outcome.load_type:5} {outcome.status:7} {outcome.table_name} {outcome.seconds:.1f}s {detail}")
    if args.summary_id:
        log = load_log(spark, outcomes)
        write_run_summary(log, layout, settings.day, args.summary_id, settings.exit_on_failures)
    failed = any(outcome.status == "failed" for outcome in outcomes)
    return int(failed and settings.exit_on_failures)


if __name__ == "__main__":
    session = SparkSession.builder.appName("snapdelta").getOrCreate()
    sys.exit(run(session, sys.argv[1:]))
