"""One current row per key out of tables that hold a key many times."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from snapdelta.operators.projection import quoted


def latest_per_key(
    df: DataFrame, keys: Sequence[str], cursor: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest cursor for each key.

    Ties go to the highest ``tiebreak`` columns, then to the highest remaining ones in table order;
    NULL is lowest. A maximum is folded inside each task before the shuffle, so a key that holds a
    third of all rows sends one row per task, and no task sorts or holds that key's rows.
    """
    first = [cursor, *tiebreak]
    rest = [name for name in df.columns if name not in {*keys, *first}]
    # Rows with a column that has no order (a map) are carried along, not compared.
    ordered = [name for name in [*first, *rest] if "map<" not in df.schema[name].dataType.simpleString()]
    carried = [name for name in [*first, *rest] if name not in ordered]
    rank = F.struct([F.col(quoted(name)) for name in ordered])
    best = F.max_by(F.struct([F.col(quoted(n)) for n in [*ordered, *carried]]), rank) if carried else F.max(rank)
    grouped = df.groupBy([F.col(quoted(name)) for name in keys]).agg(best.alias("_best"))
    return grouped.select(
        [
            F.col(quoted(name)) if name in keys else F.col("_best").getField(name).alias(name)
            for name in df.columns
        ]
    )


def repeated_keys(df: DataFrame, keys: Sequence[str], cursor: str) -> DataFrame:
    """Keys that occur more than once, with their count and first and last cursor."""
    column = F.col(quoted(cursor))
    return (
        df.groupBy([F.col(quoted(name)) for name in keys])
        .agg(
            F.count("*").alias("copies"),
            F.min(column).alias("first_cursor"),
            F.max(column).alias("last_cursor"),
        )
        .filter("copies > 1")
    )


def union_outputs(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several loads that share one output; a column some lack is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def current_state(
    snapshot: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    cursor: str,
    unique_snapshot: bool = False,
) -> DataFrame:
    """Snapshot plus later deltas, newest row per key.

    With ``unique_snapshot`` the caller states that the snapshot holds each key once. Then only the
    snapshot rows whose key the delta touches are compared. The rest pass by an anti join, which
    Spark turns into a broadcast (no shuffle of the snapshot) when the delta's keys are small.
    """
    if not unique_snapshot:
        return latest_per_key(union_outputs([snapshot, delta]), keys, cursor)
    newest = latest_per_key(delta, keys, cursor)
    named = [F.col(quoted(name)).alias(f"_key_{nth}") for nth, name in enumerate(keys)]
    touched_keys = delta.select(named).distinct()
    # a NULL key is a key here, as it is in a grouping
    same = reduce(and_, [F.col(quoted(name)).eqNullSafe(F.col(f"_key_{nth}")) for nth, name in enumerate(keys)])
    touched = snapshot.join(touched_keys, same, "left_semi")
    untouched = snapshot.join(touched_keys, same, "left_anti")
    compared = latest_per_key(union_outputs([touched, newest]), keys, cursor)
    return union_outputs([untouched, compared])


def late_rows(arrivals: DataFrame, cursor: str, high_water_mark) -> DataFrame:
    """New arrivals that the exclusive cursor filter can never load: at or below the mark, or NULL."""
    from snapdelta.operators.cursor import cursor_literal

    column = F.col(quoted(cursor))
    mark = cursor_literal(high_water_mark, arrivals.schema[cursor].dataType)
    return arrivals.filter(column.isNull() | (column <= mark))
