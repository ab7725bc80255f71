"""Where landed tables, state and run summaries live under one root."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, functions as F


def snapshot_date(mode: str = "current_date", date_format: str = "%Y/%m/%d", today: date | None = None) -> str:
    """The date part of a path; ``current_date`` is the only mode."""
    if mode != "current_date":
        raise ValueError(f"unsupported snapshot mode: {mode}")
    return (today or date.today()).strftime(date_format)


def folder_column(template: str, table: Column, day: Column) -> Column:
    """A path template filled in per row; ``day`` is a date or timestamp."""
    dated = F.replace(F.lit(template), F.lit("{snapshot_date}"), F.date_format(day, "yyyy/MM/dd"))
    return F.replace(dated, F.lit("{table_name}"), table)


# Folders under the dataset, and the folder of run summaries.
FULL_TEMPLATE = "full_load/{table_name}/{snapshot_date}"
DELTA_TEMPLATE = "delta_load/{table_name}/{snapshot_date}"
SUMMARY_FOLDER = "_batch_run_summaries"


@dataclass(frozen=True)
class Layout:
    root: str
    dataset: str = "landing"
    full_template: str = FULL_TEMPLATE
    delta_template: str = DELTA_TEMPLATE

    @property
    def base(self) -> str:
        return "/".join(part.rstrip("/") for part in (self.root, self.dataset.strip("/")) if part)

    def _folder(self, template: str, table: str, day: str) -> str:
        filled = template.format(table_name=table, snapshot_date=day)
        return f"{self.base}/{filled.strip('/')}"

    def snapshot(self, table: str, day: str) -> str:
        return self._folder(self.full_template, table, day)

    def delta(self, table: str, day: str) -> str:
        return self._folder(self.delta_template, table, day)

    def delta_log(self, table: str) -> str:
        """The folder above all dates of a delta table."""
        before_date = self.delta_template.split("{snapshot_date}")[0]
        return self._folder(before_date, table, "")

    @property
    def state(self) -> str:
        return f"{self.base}/_load_state"

    @property
    def schemas(self) -> str:
        return f"{self.base}/_load_schemas"

    def summary(self, day: str, job_id: str) -> str:
        return f"{self.base}/{SUMMARY_FOLDER}/{day.strip('/')}/{job_id}.json"
