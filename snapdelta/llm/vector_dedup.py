"""Near-duplicate vectors by int8 tile products with proven error bounds.

Unit vectors are quantised to int8 with a scale of their own. For two vectors u = s q + e and
v = t p + f (e and f what rounding left over) the cosine differs from s t (q . p) by
(s q) . f + e . (t p) + e . f, so by at most |sq| |f| + |e| |tp| + |e| |f|; the norms are kept with
each vector. The products q . p are whole numbers, computed tile by tile with the matrix product of
float32 (exact while a partial sum is below 2**24, so dimensions go in runs of 1,024). Only pairs
whose bounds straddle the threshold are computed again in double precision.

Equal vectors are one representative with a count. Each pair of tiles is a task's unit of work; it
sends link counts and a spanning forest of its links, never the links of a whole group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from snapdelta.llm.components import components
from snapdelta.llm.frames import kept

THRESHOLD = 0.95
#: Vectors in a tile: the work of a pair of tiles takes some tens of MB whatever the input.
TILE = 2_048
RUN = 1_024
#: More than the rounding errors of the bounds themselves, in double precision.
SLACK = 1e-9


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale, norm of what they stand for and norm of the rest, by row."""
    scale = np.maximum(np.abs(unit).max(axis=1, initial=0), 1e-300) / 127.0
    values = np.rint(unit / scale[:, None])
    stands = values * scale[:, None]
    return values.astype(np.int8), scale, np.linalg.norm(stands, axis=1), np.linalg.norm(unit - stands, axis=1)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows over their norms, scaled first so that no square over- or underflows."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products, in float32 as long as one run holds all dimensions."""
    parts = (a[:, at : at + RUN].astype(np.float32) @ b[:, at : at + RUN].astype(np.float32).T for at in range(0, a.shape[1], RUN))
    if a.shape[1] <= RUN:
        return next(parts)
    return sum(part.astype(np.float64) for part in parts)


def link_pairs(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of unit rows with a cosine of at least ``threshold``, in order of rows.

    A pair is looked at by its own bounds if its product reaches the threshold with the widest bounds of the tile.
    """
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    qa, sa, na, ea = quantise(a)
    qb, sb, nb, eb = quantise(b)
    products = int8_products(qa, qb)
    # the products are exact; the scales are rounded to float32 three times
    widest = na.max() * eb.max() + ea.max() * nb.max() + ea.max() * eb.max() + SLACK + 1e-6
    products32 = products * sa[:, None].astype(np.float32)
    products32 *= sb[None, :].astype(np.float32)
    i, j = np.nonzero(products32 >= np.float32(threshold - widest))
    found = np.zeros(len(i), bool)
    for at in range(0, len(i), 100_000):
        x, y = i[at : at + 100_000], j[at : at + 100_000]
        about = products[x, y].astype(np.float64) * sa[x] * sb[y]
        error = na[x] * eb[y] + ea[x] * nb[y] + ea[x] * eb[y] + SLACK
        sure = about - error >= threshold
        unsure = np.flatnonzero((about + error >= threshold) & ~sure)
        sure[unsure] = np.einsum("ij,ij->i", a[x[unsure]], b[y[unsure]]) >= threshold
        found[at : at + 100_000] = sure
    return i[found], j[found]


def linked(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs of unit rows have a cosine of at least ``threshold``, as a boolean matrix."""
    found = np.zeros((len(a), len(b)), bool)
    found[link_pairs(a, b, threshold)] = True
    return found


def forest(count: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``count`` nodes: each node but the least of its component, and that least."""
    least = np.arange(count)
    while True:
        before = least.copy()
        both = np.minimum(least[i], least[j])
        np.minimum.at(least, i, both)
        np.minimum.at(least, j, both)
        least = least[least]
        if (least == before).all():
            break
    moved = np.flatnonzero(least != np.arange(count))
    return moved, least[moved]


def _tile_pairs(tiled: DataFrame, tiles: int) -> DataFrame:
    """Each vector in every pair of tiles that its tile is part of, keyed by the pair."""
    others = F.sequence(F.lit(0), F.lit(tiles - 1))
    other = tiled.select("*", F.explode(others).alias("other"))
    return other.select(
        F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "tile", "rep", "copies", "vector"
    )


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(size, np.int64)
    np.add.at(total, at, values)
    return total


def _compare(threshold: float):
    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, second = key
        rows = rows.sort_values("rep", kind="stable")
        left = rows[rows.tile == first]
        right = rows[rows.tile == second]
        empty = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "links": np.zeros(0, np.int64)})
        if not len(left) or not len(right):
            return empty
        a, b = (unit_rows(np.stack(side.vector.to_numpy()).astype(np.float64)) for side in (left, right))
        i, j = link_pairs(a, b, threshold)
        same = first == second
        if same:
            i, j = i[i != j], j[i != j]
        counts = [(left.rep.to_numpy(), _sums(i, right.copies.to_numpy()[j], len(left)))]
        if same:
            i, j = i[i < j], j[i < j]
            reps = left.rep.to_numpy()
        else:
            counts.append((right.rep.to_numpy(), _sums(j, left.copies.to_numpy()[i], len(right))))
            reps = np.concatenate([left.rep.to_numpy(), right.rep.to_numpy()])
            j = j + len(left)
        x, y = forest(len(reps), i, j)
        found = [(reps[x], reps[y], np.zeros(len(x), np.int64))]
        found += [(rep[n > 0], rep[n > 0], n[n > 0].astype(np.int64)) for rep, n in counts]
        a, b, links = (np.concatenate(column) for column in zip(*found, strict=True))
        return pd.DataFrame({"a": a, "b": b, "links": links})

    return compare


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per row of ``vectors``: the id, n_links, component_id and kept.

    Two vectors are linked if their cosine in double precision is at least ``threshold``. A vector
    that is null, empty, all zero, or holds a null or a number that is not finite links with nothing
    and is a component of its own; so is one whose id is null (its component is null, and it is kept).
    Vectors of unequal length do not link. Equal rows are linked like any others: a repeated id counts
    each row. An empty table gives an empty one; other columns are not read.
    """
    spark = vectors.sparkSession
    doubles = F.col(vector_col).cast("array<double>")
    sound = (
        F.col(vector_col).isNotNull()
        & (F.size(doubles) > 0)
        & F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(doubles, lambda x: x != 0)
    )
    # 0.0 and -0.0 are the same number
    same = F.when(F.coalesce(sound, F.lit(False)), F.transform(doubles, lambda x: x + F.lit(0.0)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), same.alias("vector"))
    rows = kept(rows.withColumn("digest", F.when(F.col("id").isNotNull() & F.col("vector").isNotNull(), F.md5(F.to_json("vector").cast("string")))))

    reps = rows.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    reps = kept(reps.withColumn("width", F.size("vector")))
    # a repeated id with unequal vectors: the digest tells its representatives apart
    numbered = kept(reps.sort("width", "rep", "digest").withColumn("place", F.monotonically_increasing_id()))
    parts = sorted(numbered.groupBy(F.shiftright("place", 33).cast("int").alias("part"), "width").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least")).collect())
    pairs, first_tile, node_at = [], 0, 0
    offsets = []
    by_width: dict[int, list] = {}
    for part, width, n, least in parts:
        by_width.setdefault(width, []).append((part, n, least))
    spans = {}
    for width in sorted(by_width):
        start = node_at
        for part, n, least in sorted(by_width[width]):
            offsets.append((part, width, node_at - least))
            node_at += n
        spans[width] = (first_tile, start, -(-(node_at - start) // tile))
        first_tile += spans[width][2]
    if not offsets:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    shift = spark.createDataFrame(offsets, "part int, width int, shift long")
    nodes = numbered.withColumn("part", F.shiftright("place", 33).cast("int")).join(F.broadcast(shift), ["part", "width"])
    nodes = nodes.select("digest", "copies", "vector", "width", (F.col("place") + F.col("shift")).alias("rep"))
    nodes = kept(nodes)

    edges = None
    for width, (_, start, tiles) in spans.items():
        of_width = nodes.filter(F.col("width") == width)
        tiled = of_width.withColumn("tile", F.floor((F.col("rep") - start) / tile).cast("int"))
        found = _tile_pairs(tiled, tiles).groupBy("first", "second").applyInPandas(_compare(threshold), "a long, b long, links long")
        edges = found if edges is None else edges.unionByName(found)
    edges = kept(edges)
    links = edges.filter("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(edges.filter("links = 0").select("a", "b"))

    classes = nodes.select("digest", "rep", "copies").join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "rep").alias("root")
    )
    members = rows.join(classes, "digest", "left").select("id", "links", "root")
    least = members.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("component_id"))
    found = members.join(least, "root", "left")
    component = F.coalesce("component_id", "id")
    return found.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
