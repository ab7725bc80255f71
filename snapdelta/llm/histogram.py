"""Exact cuts in the order of a key, by counts of weight below ever finer probes.

A key is a text of hexadecimal digits, spread evenly. Each round counts the weight that lies below
the candidate boundaries inside the open intervals, over all partitions, and narrows the intervals
to one candidate step. A round moves at most ``cuts x 16**digits`` counts, however many rows there are.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass
from os.path import commonprefix

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Cut:
    """Where a target falls: in ``key`` (or at the start of the keys from ``key`` on, if ``within`` is 0)."""

    group: int
    target: int
    key: str
    below: int
    within: int
    rows: int


def find_cuts(
    keys: DataFrame,
    targets: list[tuple[int, int]],
    digits: int = 2,
    tolerance: int = 0,
    whole_prefix: int = 0,
) -> dict[tuple[int, int], Cut]:
    """The cut of each (group, target): the key whose rows hold the target's unit of weight.

    ``keys`` has the columns ``group`` int, ``key`` text and ``weight`` long, and should be stored.
    A candidate boundary within ``tolerance`` of the target ends the search early. No probe spans
    the end of a prefix of ``whole_prefix`` digits, so boundaries between such prefixes come first.
    A target of at most 0 cuts before all keys, one beyond the weight of its group after all of them.
    """
    found: dict[tuple[int, int], Cut] = {}
    open_at = {(group, target): ("", 0) for group, target in set(targets)}
    while open_at:
        wanted = defaultdict(set)
        for (group, _), (prefix, _) in open_at.items():
            wanted[len(prefix)].add((group, prefix))
        counted = defaultdict(list)
        depth = {}
        for length, pairs in wanted.items():
            depth[length] = length + digits
            if length < whole_prefix < depth[length]:
                depth[length] = whole_prefix
            chosen = keys
            if length:
                within = F.struct(F.col("group"), F.substring("key", 1, length))
                chosen = keys.filter(within.isin([F.struct(F.lit(g), F.lit(p)) for g, p in sorted(pairs)]))
            step = F.substring("key", 1, depth[length]).alias("step")
            rows = chosen.groupBy("group", step).agg(
                F.sum("weight").alias("weight"),
                F.count(F.lit(1)).alias("rows"),
                F.min("key").alias("low"),
                F.max("key").alias("high"),
            )
            for row in rows.collect():
                counted[row["group"], row["step"][:length]].append(row)
        still = {}
        for (group, target), (prefix, below) in open_at.items():
            steps = sorted(counted[group, prefix], key=lambda row: row["step"])
            starts = [below]
            for row in steps:
                starts.append(starts[-1] + row["weight"])
            at = max(0, bisect_right(starts, target - 1) - 1)
            if not prefix and target <= 0:
                found[group, target] = Cut(group, target, "", 0, 0, 0)
            elif at >= len(steps):
                found[group, target] = Cut(group, target, "g", starts[-1], 0, 0)
            else:
                row = steps[at]
                near = min((starts[at], row["step"]), (starts[at + 1], None), key=lambda x: abs(x[0] - target))
                if tolerance and abs(near[0] - target) <= tolerance:
                    # the end of a step is the start of what follows: one character past its last digit
                    key = near[1] if near[1] is not None else row["step"] + "g"
                    found[group, target] = Cut(group, target, key, near[0], 0, 0)
                elif row["low"] == row["high"]:
                    found[group, target] = Cut(group, target, row["low"], starts[at], row["weight"], row["rows"])
                else:
                    # what all keys of the step share needs no further round
                    shared = commonprefix([row["low"], row["high"]])
                    if len(row["step"]) < whole_prefix < len(shared):
                        shared = shared[:whole_prefix]
                    still[group, target] = (shared, starts[at])
        open_at = still
    return found
