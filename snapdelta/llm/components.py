"""Connected components of a graph that no task holds whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snapdelta.llm.frames import gathered, kept


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of ``edges`` (a, b): the least node that links reach.

    Stars are drawn together in turns: each node hands its greater neighbours to its least one (large
    star), then its smaller neighbours (small star), until no edge moves. The number of rounds grows
    with the logarithm of the nodes. All grouping is a minimum by node, so a node of many links costs
    no task more than its partial minima, and the joins on it can be split.
    """
    # an edge always goes from the greater node to the smaller
    now = kept(_tidy(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))))
    now = gathered(now, now.count())
    before = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _tidy(large)
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_least.select("u", F.col("m").alias("v")))
        now = kept(_tidy(small))
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        now = gathered(now, mark[0])
        if mark == before:
            break
        before = mark
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.filter("u > v").select("u", "v").distinct()
