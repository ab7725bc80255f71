"""Which columns a load reads, under which names, and its derived cursor column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from snapdelta.config import DeltaLoad, FullLoad


def quoted(name: str) -> str:
    """A column name as Spark SQL text."""
    return "`" + name.replace("`", "``") + "`"


def select_text(df: DataFrame, select_sql: str) -> DataFrame:
    """Apply a select list written as Spark SQL text, commas and all."""
    text = select_sql.strip().rstrip(",").replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT {text} FROM {{source}}", source=df)


def prune(df: DataFrame, keep: Sequence[str] | None) -> DataFrame:
    """Drop the columns outside ``keep``; an empty list keeps all."""
    if not keep:
        return df
    return df.select([quoted(name) for name in df.columns if name in set(keep)])


def project(df: DataFrame, load: FullLoad, enforce_output: bool = False) -> DataFrame:
    """The load's projection.

    ``output_columns`` prunes a scan of all columns. It does not touch the other two forms unless
    ``enforce_output`` is set.
    """
    if load.projection == "select_sql":
        rows = select_text(df, load.select_sql)
    elif load.projection == "columns":
        rows = df.select([quoted(name) for name in load.columns])
    else:
        return prune(df, load.output_columns)
    return prune(rows, load.output_columns) if enforce_output else rows


def with_cursor(df: DataFrame, load: DeltaLoad) -> DataFrame:
    """Add the cursor; its expression sees the projected names, not the source's."""
    if not load.cursor_expression:
        return df
    return df.withColumn(load.cursor_column, F.expr(load.cursor_expression))


def nullable(df: DataFrame) -> DataFrame:
    """The same rows with every top-level column allowed to be NULL."""
    # A condition without an ELSE may be NULL as far as the schema knows; the optimizer drops it.
    tight = {f.name: F.col(quoted(f.name)) for f in df.schema.fields if not f.nullable}
    loose = {name: F.when(column.isNotNull(), column) for name, column in tight.items()}
    return df.withColumns(loose) if loose else df
