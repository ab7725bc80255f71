"""Plan the slices of a partitioned read from how often values occur.

A slice is a SQL condition. Together the conditions hold every row once, and each holds about as many rows:
ranges of a column are cut at quantiles, and a value that alone would fill a slice gets conditions of its
own, cut further by the next column. The planner asks for counts and quantiles only, so it works the same
for a database table, which answers them itself, and for a frame.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Dialect:
    """How names and times without a zone are written."""

    quote: str
    timestamp: str

    def name(self, column: str) -> str:
        return self.quote + column.replace(self.quote, self.quote * 2) + self.quote

    def value(self, value) -> str:
        if isinstance(value, datetime):
            kind = self.timestamp if value.tzinfo is None else "TIMESTAMP WITH TIME ZONE" if self.quote == '"' else "TIMESTAMP_LTZ"
            return f"{kind} '{value.isoformat(sep=' ')}'"
        if isinstance(value, date):
            return f"DATE '{value.isoformat()}'"
        if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
            return str(value).upper() if isinstance(value, bool) else "'" + str(value).replace("'", "''") + "'"
        if isinstance(value, float):
            return f"CAST('{value!r}' AS double precision)" if self.quote == '"' else f"{value!r}D"
        return str(value)


POSTGRES = Dialect('"', "TIMESTAMP")
SPARK = Dialect("`", "TIMESTAMP_NTZ")


class DatabaseCounts:
    """Counts that a database gives: ``rows`` runs a query text, ``source`` is a table or sub-query text."""

    dialect = POSTGRES

    def __init__(self, rows: Callable[[str], Sequence], source: str):
        self._rows = rows
        self._source = source

    def _from(self, where: Sequence[str]) -> str:
        return f" FROM {self._source}" + (" WHERE " + " AND ".join(f"({each})" for each in where) if where else "")

    def sizes(self, column: str, where: Sequence[str]) -> tuple[int, int]:
        """Rows, and rows that lack the column."""
        name = self.dialect.name(column)
        rows, filled = self._rows(f"SELECT count(*) AS n, count({name}) AS filled{self._from(where)}")[0]
        return rows, rows - filled

    def frequent(self, column: str, least: int, where: Sequence[str]) -> list[tuple]:
        """(value, rows) of the values that at least ``least`` rows hold."""
        name = self.dialect.name(column)
        text = f"SELECT {name} AS held, count(*) AS n{self._from([*where, f'{name} IS NOT NULL'])} GROUP BY {name} HAVING count(*) >= {least}"
        return [tuple(row) for row in self._rows(text)]

    def cuts(self, column: str, shares: Sequence[float], where: Sequence[str]) -> list:
        """The values below which these shares of the rows lie."""
        name = self.dialect.name(column)
        asked = ", ".join(f"percentile_disc({share!r}) WITHIN GROUP (ORDER BY {name}) AS cut_{nth}" for nth, share in enumerate(shares))
        return list(self._rows(f"SELECT {asked}{self._from(where)}")[0])


class FrameCounts:
    """The same counts of a frame; its quantiles come from a mergeable sketch, off by a ten-thousandth at most."""

    dialect = SPARK
    ACCURACY = 10_000

    def __init__(self, frame: DataFrame):
        self._frame = frame

    def _chosen(self, where: Sequence[str]) -> DataFrame:
        return reduce(lambda frame, each: frame.filter(each), where, self._frame)

    def sizes(self, column: str, where: Sequence[str]) -> tuple[int, int]:
        rows, filled = self._chosen(where).agg(F.count("*"), F.count(self.dialect.name(column))).first()
        return rows, rows - filled

    def frequent(self, column: str, least: int, where: Sequence[str]) -> list[tuple]:
        name = self.dialect.name(column)
        counted = self._chosen(where).filter(f"{name} IS NOT NULL").groupBy(F.col(name).alias("held")).agg(F.count("*").alias("n"))
        return [tuple(row) for row in counted.filter(F.col("n") >= least).collect()]  # as many as slices at most

    def cuts(self, column: str, shares: Sequence[float], where: Sequence[str]) -> list:
        found = F.percentile_approx(self.dialect.name(column), list(shares), self.ACCURACY)
        return list(self._chosen(where).agg(found).first()[0] or [])


def plan_slices(counts: DatabaseCounts | FrameCounts, columns: Sequence[str], parts: int) -> list[str]:
    """Conditions for about ``parts`` slices, by ranges of the first column; every row fulfils exactly one.

    An even share is a ``parts``-th of the rows. A range of values holds at most twice that (and the sketch's
    error). A value, or NULL, that holds an even share or more gets a condition of its own, and ranges of the
    next column inside it where there is one. The outer ranges are open and NULL always has a place, so rows
    that arrive later are read too. Columns must have an order; a frame's are numbers, dates or times.
    """
    rows, _ = counts.sizes(columns[0], [])
    return _slices(counts, list(columns), max(1, math.ceil(rows / max(1, parts))), [])


def _slices(counts, columns: list[str], share: int, where: list[str]) -> list[str]:
    column, *rest = columns
    name, value = counts.dialect.name(column), counts.dialect.value
    rows, empty = counts.sizes(column, where)
    heavy = sorted(counts.frequent(column, share, where), key=lambda pair: str(pair[0])) if rows > share else []
    found = []

    def add(condition: str, n: int) -> None:
        inside = [*where, condition]
        if rest and n > share:
            found.extend(_slices(counts, rest, share, inside))
        else:
            found.append(" AND ".join(f"({each})" for each in inside))

    for held, n in heavy:
        add(f"{name} = {value(held)}", n)
    without = f"{name} NOT IN ({', '.join(value(held) for held, _ in heavy)})" if heavy else ""
    others = rows - empty - sum(n for _, n in heavy)
    parts = math.ceil(others / share)
    cuts: list = []
    if parts > 1:
        asked = [*where, f"{name} IS NOT NULL", *([without] if without else [])]
        cuts = sorted(set(counts.cuts(column, [nth / parts for nth in range(1, parts)], asked)))
    apart = empty >= share
    if apart:
        add(f"{name} IS NULL", empty)
    edges = [None, *cuts, None]
    for low, high in zip(edges, edges[1:]):
        sides = [f"{name} >= {value(low)}"] * (low is not None) + [f"{name} < {value(high)}"] * (high is not None)
        condition = " AND ".join([*sides, *([without] if without else [])]) or f"{name} IS NOT NULL"
        if low is None and not apart:
            condition = f"({condition}) OR {name} IS NULL"
        found.append(" AND ".join(f"({each})" for each in [*where, condition]))
    return found


def sliced(frame: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """The rows of a frame, read once per condition and put together again."""
    return reduce(DataFrame.unionAll, [frame.filter(condition) for condition in conditions])
