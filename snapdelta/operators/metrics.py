"""Row counts and run roll-ups over landed rows and load logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: tables whose name starts so belong to the loader, not to the user.
INTERNAL_PREFIX = "_dlt"

# A load log has one row per table load. status is one of these.
OK, FAILED, SKIPPED = "ok", "failed", "skipped"


def row_counts(landed: DataFrame, table_column: str = "table_name") -> DataFrame:
    """Rows per output table, the loader's own tables left out."""
    own = F.col(table_column).startswith(INTERNAL_PREFIX)
    return landed.filter(~own).groupBy(table_column).agg(F.count("*").alias("n_rows"))


def loaded_row_counts(tables: DataFrame, counts: DataFrame) -> DataFrame:
    """Every table with its count; a table without landed rows has zero, which is a known count."""
    return tables.join(counts, "table_name", "left").select(
        "table_name", F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows")
    )


def total_rows(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("total_rows"))


def _count_status(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def run_rollup(load_log: DataFrame) -> DataFrame:
    """Per phase and in total (``ALL``): tables, outcomes, rows of the successful ones, status."""
    loaded = F.sum(F.when(F.col("status") == OK, F.col("n_rows")))
    totals = load_log.rollup("load_type").agg(
        F.grouping("load_type").alias("_is_total"),
        F.count("*").alias("tables"),
        _count_status(OK).alias("ok"),
        _count_status(FAILED).alias("failed"),
        _count_status(SKIPPED).alias("skipped"),
        F.coalesce(loaded, F.lit(0)).cast("bigint").alias("n_rows"),
    )
    return totals.select(
        F.when(F.col("_is_total") == 1, "ALL").otherwise(F.col("load_type")).alias("phase"),
        "tables",
        "ok",
        "failed",
        "skipped",
        "n_rows",
        F.when(F.col("failed") == 0, "SUCCESS").otherwise("FAILED").alias("status"),
    )


def run_status(load_log: DataFrame, exit_on_failures: bool = False) -> DataFrame:
    """One row: the run's status text and exit code. The code is 1 only when asked for."""

    def failures(phase: str) -> Column:
        return F.count_if((F.col("status") == FAILED) & (F.col("load_type") == phase))

    counts = load_log.agg(failures("FULL").alias("full_failed"), failures("DELTA").alias("delta_failed"))
    full, delta = F.col("full_failed"), F.col("delta_failed")
    parts = F.concat_ws(
        ", ",
        F.when(full > 0, F.concat(F.lit("full_failed="), full.cast("string"))),
        F.when(delta > 0, F.concat(F.lit("delta_failed="), delta.cast("string"))),
    )
    failed = (full > 0) | (delta > 0)
    return counts.select(
        full,
        delta,
        F.when(failed, F.concat(F.lit("FAILED ("), parts, F.lit(")"))).otherwise("SUCCESS").alias("status"),
        F.when(failed & F.lit(exit_on_failures), 1).otherwise(0).alias("exit_code"),
    )


def database_groups(configs: DataFrame) -> DataFrame:
    """Per database alias: how many tables, and the first and last of them in config order.

    The groups stay rows: no list of a whole group is built in one task.
    """
    first = F.min_by("table", "ordinal")
    last = F.max_by("table", "ordinal")
    return configs.groupBy("database").agg(
        F.count("*").alias("tables"), first.alias("first_table"), last.alias("last_table")
    )


def in_database_order(configs: DataFrame) -> DataFrame:
    """The configs group after group: aliases sorted, config order kept inside each."""
    return configs.orderBy("database", "ordinal")
