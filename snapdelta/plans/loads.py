"""One table's load: a lazy scan, projection and filter that ends in one write."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F, types as T

from snapdelta.config import DeltaLoad, FullLoad
from snapdelta.operators.cursor import above, first_floor, greatest_columns, in_cursor_order
from snapdelta.operators.projection import quoted
from snapdelta.operators.schema import REJECTED, conform, stable_text, text_for_complex
from snapdelta.sinks.folders import Folders
from snapdelta.sinks.landing import SnapshotWriter, even_files, mark_run, unmark_run, write_run
from snapdelta.sinks.layout import Layout
from snapdelta.sinks.manifest import write_manifest
from snapdelta.sources.landed import read_above
from snapdelta.state.schemas import SchemaStore
from snapdelta.state.watermark import WatermarkTable, state_key, stored_text


@dataclass(frozen=True)
class Landed:
    n_rows: int
    mode: str
    cutoff: object = None
    low: str | None = None
    high: str | None = None
    n_rejected: int = 0


def declared(rows: DataFrame, load: FullLoad) -> DataFrame:
    """The rows in the types that the load declares; what does not fit is NULL and kept in ``_rejected``."""
    if not load.column_types:
        return rows
    types = dict(load.column_types)
    unknown = sorted(set(types) - set(rows.columns))
    if unknown:
        raise ValueError(f"{load.label}: column_types names columns that are not read: {', '.join(unknown)}")
    if isinstance(load, DeltaLoad) and load.cursor_column in types:
        raise ValueError(f"{load.label}: the cursor column keeps its own type")
    if REJECTED in rows.columns:
        raise ValueError(f"{load.label}: a column is named {REJECTED}")
    parsed = T.StructType.fromDDL(", ".join(f"{quoted(name)} {kind}" for name, kind in types.items()))
    by_name = {field.name: field.dataType for field in parsed.fields}
    wanted = T.StructType([T.StructField(f.name, by_name.get(f.name, f.dataType)) for f in rows.schema.fields])
    return conform(rows, wanted, on_bad_value="reject")


def _rejects(load: FullLoad) -> dict:
    return {"n_rejected": F.count_if(F.col(REJECTED).isNotNull())} if load.column_types else {}


def stable_types(df: DataFrame) -> DataFrame:
    """Types that stay the same from run to run: stable text columns, complex values as JSON text."""
    return text_for_complex(stable_text(df))


def load_full(
    rows: DataFrame, load: FullLoad, layout: Layout, day: str, writer: SnapshotWriter, rows_per_file: int = 0
) -> Landed:
    """Scan, project, write. There is no shuffle; the files follow the scan's tasks."""
    folder = layout.snapshot(load.output_name, day)
    found = writer.write(declared(rows, load), folder, rows_per_file, stable_types, **_rejects(load))
    return Landed(found["n_rows"], "full_table", n_rejected=found.get("n_rejected", 0))


def extract(rows: DataFrame, load: DeltaLoad, last_value) -> DataFrame:
    """Rows above ``last_value``; ``rows`` already has the cursor column."""
    return above(rows, load.cursor_column, last_value, load.cursor_expression)


def land_run(
    rows: DataFrame, load: DeltaLoad, layout: Layout, day: str, run_id: str, rows_per_file: int = 0, manifest: bool = False
) -> dict:
    """Write one run of a table's log under the table's schema version, which the run widens if it has to.

    Gives what ``write_run`` does, with the lowest and highest cursor as state text. ``manifest`` adds the
    cursor's bounds per file, for readers that skip files by them.
    """
    spark, table = rows.sparkSession, load.output_name
    log, folder = layout.delta_log(table), f"{layout.delta(table, day)}/{run_id}"
    place = layout.delta(table, day).removeprefix(log)
    version, schema = SchemaStore(spark, layout.schemas).admit(table, stable_types(rows).schema)
    Folders(spark).delete(folder)  # of an earlier try, maybe under another version
    mark_run(spark, log, place, run_id, version)
    cursor, data_type = F.col(quoted(load.cursor_column)), rows.schema[load.cursor_column].dataType
    found = write_run(
        rows,
        folder,
        rows_per_file,
        lambda df: conform(stable_types(df), schema),
        low=stored_text(F.min(cursor), data_type),
        high=stored_text(F.max(cursor), data_type),
        **_rejects(load),
    )
    if not found["n_rows"]:
        unmark_run(spark, log, place, run_id)
    elif manifest:
        tracked = [load.cursor_column, *greatest_columns(load.cursor_expression)]
        write_manifest(spark.read.schema(schema).parquet(folder), log, place, run_id, tracked)
    return found


def window_start(cutoff, window: str):
    """The cursor ``window`` below ``cutoff``: an interval such as ``2 days`` for times, a number for numbers."""
    if isinstance(cutoff, date):
        number, unit = window.split()
        return cutoff - timedelta(**{unit if unit.endswith("s") else unit + "s": float(number)})
    return cutoff - type(cutoff)(window)


def _reader_of_log(rows: DataFrame, layout: Layout, load: DeltaLoad) -> Callable[[object], DataFrame]:
    return lambda value: read_above(rows.sparkSession, layout, load, value)


def _not_yet_landed(chosen: DataFrame, load: DeltaLoad, landed: DataFrame) -> DataFrame:
    """Rows whose key and cursor the log lacks. A changed row has a new cursor, so it is not left out."""
    names = [*load.keys, load.cursor_column]
    seen = landed.select([F.col(quoted(name)).alias(f"_landed_{nth}") for nth, name in enumerate(names)]).distinct()
    # compared in the types the log has, which a wider batch may have changed
    same = [F.col(quoted(name)).cast(seen.schema[nth].dataType).eqNullSafe(F.col(f"_landed_{nth}")) for nth, name in enumerate(names)]
    return chosen.join(seen, reduce(and_, same), "left_anti")


def load_delta(
    rows: DataFrame,
    load: DeltaLoad,
    layout: Layout,
    day: str,
    watermarks: WatermarkTable,
    base_name: str = "snapdelta",
    floor=None,
    run_id: str | None = None,
    rows_per_file: int = 0,
    order_first_load: bool = False,
    manifest: bool = False,
    landed_before: Callable[[object], DataFrame] | None = None,
) -> Landed:
    """Land the rows above the saved cursor (or the floor), then save the new cursor.

    The files come first and the state second: a crash in between repeats rows, never loses them,
    and a second attempt with the same ``run_id`` writes over the first one's files. The new cursor
    is the highest one written, taken during the write. Each run needs an id of its own. Types that
    changed since the last run widen the log's schema; declared ones are kept to, and counted where not met.

    With a ``late_window`` the run looks that far back below the saved cursor, for rows that arrived late, and
    leaves out those the log has already (``landed_before`` gives them from a cursor on; by default it reads
    the log). The saved cursor still never moves back.
    """
    run_id = run_id or uuid.uuid4().hex
    key = state_key(base_name, "delta", load.database, load.schema, load.output_name)
    saved = watermarks.saved(key)
    if saved.run_id == run_id:
        raise ValueError(f"{load.label}: run {run_id} is already complete")
    first = saved.value is None
    cutoff = first_floor(load.initial_value, floor) if first else saved.value
    data_type = rows.schema[load.cursor_column].dataType

    back = cutoff
    if load.late_window and not first:
        lowest = first_floor(load.initial_value, floor)
        back = window_start(cutoff, load.late_window)
        back = back if lowest is None else max(back, lowest)
    chosen = extract(rows, load, back)
    if back != cutoff:
        chosen = _not_yet_landed(chosen, load, (landed_before or _reader_of_log(rows, layout, load))(back))
    chosen = declared(chosen, load)
    # A later increment keeps few rows of each scan task: they are gathered and put in cursor order.
    # A first load keeps most rows, so its files follow the scan: no shuffle, and a sort only on request.
    if not first:
        chosen = even_files(chosen)
    if order_first_load or not first:
        chosen = in_cursor_order(chosen, load.cursor_column)
    found = land_run(chosen, load, layout, day, run_id, rows_per_file, manifest)
    watermarks.advance(key, found["high"], data_type.simpleString(), found["n_rows"], run_id, after=saved)
    mode = "full_table" if cutoff is None else "incremental"
    return Landed(found["n_rows"], mode, cutoff, found["low"], found["high"], found.get("n_rejected", 0))
