"""What to load: one frozen record per table, read from YAML or JSON files or held in a DataFrame."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class FullLoad:
    """A table to land whole.

    ``select_sql`` wins over ``columns`` when it is not blank; with neither, all columns are read.
    ``output_columns`` documents the result of a ``select_sql`` and only prunes a plain table scan.
    ``read_slices`` is how many tasks should read the table from a database, by ranges of ``slice_columns``
    (the later ones only where a value of the former is very frequent).
    ``column_types`` declares types as (column, Spark type); values that do not fit are NULL and reported.
    """

    database: str
    schema: str
    table: str
    output_table_name: str | None = None
    columns: tuple[str, ...] | None = None
    select_sql: str | None = None
    output_columns: tuple[str, ...] | None = None
    enabled: bool = True
    extract_chunk_size: int | None = None
    read_slices: int | None = None
    slice_columns: tuple[str, ...] | None = None
    column_types: tuple[tuple[str, str], ...] | None = None

    @property
    def output_name(self) -> str:
        return self.output_table_name or self.table

    @property
    def label(self) -> str:
        return f"{self.database}.{self.schema}.{self.output_name}"

    @property
    def projection(self) -> str:
        """Which of the three forms applies: ``select_sql``, ``columns`` or ``all``."""
        if (self.select_sql or "").strip():
            return "select_sql"
        return "columns" if self.columns else "all"


@dataclass(frozen=True, kw_only=True)
class DeltaLoad(FullLoad):
    """A table to land above its last cursor value.

    With ``keys`` (what tells rows apart) and a ``late_window`` (``2 days``, or a number for number cursors) a
    run also lands rows that arrived late, up to that far below the saved cursor.
    """

    cursor_column: str
    cursor_expression: str | None = None
    initial_value: object = None
    keys: tuple[str, ...] | None = None
    late_window: str | None = None

    def __post_init__(self):
        if not self.cursor_column:
            raise ValueError(f"{self.label}: a delta table must set cursor_column")
        if self.cursor_expression and self.projection == "all":
            raise ValueError(f"{self.label}: cursor_expression needs select_sql or columns")
        if self.late_window and not self.keys:
            raise ValueError(f"{self.label}: late_window needs keys")


def load_from_entry(database: str, entry: dict, delta: bool) -> FullLoad:
    """One table entry of a config file as a record."""
    kind = DeltaLoad if delta else FullLoad
    known = {name: entry[name] for name in kind.__dataclass_fields__ if entry.get(name) is not None}
    for listed in ("columns", "output_columns", "slice_columns", "keys"):
        if listed in known:
            known[listed] = tuple(known[listed])
    if "late_window" in known:
        known["late_window"] = str(known["late_window"])
    if "column_types" in known:
        known["column_types"] = tuple(dict(known["column_types"]).items())
    if delta:
        known["cursor_column"] = entry.get("cursor_column") or entry.get("cursor") or ""
    known["database"] = database
    return kind(**known)


def read_document(path: str | Path) -> dict:
    """A YAML or JSON file as a dict."""
    path = Path(path)
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text) or {}
    import yaml  # only needed by those who keep their configs in YAML

    return yaml.safe_load(text) or {}


def read_loads(folder: str | Path, delta: bool = False) -> list[FullLoad]:
    """All enabled tables of a folder of ``<database alias>.yaml`` (or ``.json``) files."""
    files = sorted(p for p in Path(folder).glob("*") if p.suffix in (".yaml", ".yml", ".json"))
    return [
        load_from_entry(path.stem, entry, delta)
        for path in files
        for entry in read_document(path).get("tables") or []
        if entry.get("enabled", True)
    ]


def select_loads(loads: list[FullLoad], database: str | None = None, table: str | None = None):
    """Enabled loads of one alias and/or one *source* table; nothing left is an error."""
    kept = [
        load
        for load in loads
        if load.enabled
        and (not database or load.database == database)
        and (not table or load.table == table)
    ]
    if not kept:
        raise ValueError(f"no tables selected (database={database or '*'}, table={table or '*'})")
    return kept


def enabled_loads(configs: DataFrame, database: str | None = None, table: str | None = None):
    """The same selection when the configs are rows: ``database, table, enabled, output_table_name``."""
    keep: Column = F.coalesce(F.col("enabled"), F.lit(True))
    if database:
        keep = keep & (F.col("database") == database)
    if table:
        keep = keep & (F.col("table") == table)
    given = F.nullif(F.col("output_table_name"), F.lit(""))
    return configs.filter(keep).withColumn("output_name", F.coalesce(given, F.col("table")))
