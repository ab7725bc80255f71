"""Near-duplicate texts by DartMinHash signatures, banded joining and an exact check.

A text is a weighted set of five-word shingles. Darts are thrown into the plane of weight and rank:
for each shingle the plane is cut into cells whose edges double, and hashes of the shingle and the
cell say how many darts (Poisson) lie in it and where. A dart counts if its weight is below the
shingle's; it belongs to one of the coordinates, and the dart of least rank is the coordinate's value.
Two texts agree in a coordinate with a probability of their weighted Jaccard similarity. Ranks are
looked into only as far as needed to fill all coordinates, so the work does not grow with their number.

Texts that share a band of coordinates meet in a bucket. No bucket is expanded into its pairs: its members are
compared with one pivot, and only members that the links found so far do not already hold together go on to
further pivots. What is left is compared exactly, so no link is lost: small buckets pair by pair, large ones in
tiles of members, each two of which meet in a task that hands out nothing but the links it finds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapdelta.llm.components import components
from snapdelta.llm.frames import gathered, kept, stored, text_of
from snapdelta.llm.rows import text_slices
from snapdelta.llm.words import WORD, mixed, shingles, word_hashes

WIDTH = 5
SIMILARITY = 0.8
#: At a similarity of 0.8 a pair meets in one of 20 bands of 5 with a probability of 0.9997.
BANDS, ROWS = 20, 5
DARTS = BANDS * ROWS
#: The rank up to which the first cell of a shingle reaches; the next ones double it.
FIRST_RANK = 0.25
#: Pivots a bucket is compared with before the rest is compared pair by pair.
PIVOTS = 3
#: An open bucket is compared pair by pair up to this size, and tile by tile beyond it; both ways find all similar
#: pairs, so the size decides on the cost alone.
SMALL = 64
#: Members of a tile, and bytes of their texts, in the mean.
TILE, TILE_BYTES = 512, 8_000_000
#: Tasks that the pairs of one pivot are dealt to at most.
SALTS = 256
#: Bytes of text that a task turns into strings at once.
AT_ONCE = 500_000


class Shingler:
    """Shingles of texts with their weights: 1 for each distinct shingle, or its count."""

    def __init__(self, width: int = WIDTH, counts: bool = False):
        self._width = width
        self._counts = counts

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found, counts = np.unique(shingles(word_hashes(WORD.findall(text.lower())), self._width), return_counts=True)
        return found, counts.astype(np.float64) if self._counts else np.ones(len(found))


def _uniform(numbers: np.ndarray) -> np.ndarray:
    return (numbers >> np.uint64(11)).astype(np.float64) / 2.0**53


def _poisson(area: float, uniform: np.ndarray) -> np.ndarray:
    """The Poisson count of each uniform number, for a mean of ``area``."""
    chance, total, steps = np.exp(-area), np.exp(-area), [np.exp(-area)]
    at = 0
    while total < 1 - 1e-15 and at < area + 20 * np.sqrt(area) + 20:
        at += 1
        chance *= area / at
        total += chance
        steps.append(total)
    return np.searchsorted(np.array(steps), uniform, side="right")


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], darts: int = DARTS) -> np.ndarray:
    """One row of dart numbers per weighted set, none of them empty."""
    best = np.full(len(sets) * darts, np.inf)
    value = np.zeros(len(sets) * darts, np.uint64)
    element = np.concatenate([found for found, _ in sets])
    weight = np.concatenate([weights for _, weights in sets])
    owner = np.repeat(np.arange(len(sets)), [len(found) for found, _ in sets])
    totals = np.bincount(owner, weight, len(sets))
    # as many darts as fill all coordinates but with a chance of e**-2
    reach = darts * (np.log(darts) + 2) / totals
    steps = np.maximum(1, 1 + np.ceil(np.log2(reach / FIRST_RANK))).astype(np.int64)
    at, alive = 0, np.ones(len(sets), bool)
    while alive.any():
        low, high = (0.0, FIRST_RANK) if at == 0 else (FIRST_RANK * 2 ** (at - 1), FIRST_RANK * 2**at)
        chosen = np.flatnonzero(alive[owner])
        top = int(max(0, np.ceil(np.log2(weight[chosen].max()))))
        for cell in range(top + 1):  # weights from 0 to 1, 1 to 2, 2 to 4 and so on
            floor, ceiling = (0.0, 1.0) if cell == 0 else (2.0 ** (cell - 1), 2.0**cell)
            inside = chosen[weight[chosen] > floor]
            seed = at * 64 + cell
            count = _poisson((high - low) * (ceiling - floor), _uniform(mixed(element[inside], seed)))
            hit = np.flatnonzero(count)
            source = np.repeat(inside[hit], count[hit])
            nth = np.arange(len(source)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
            dart = mixed(mixed(element[source], 10_000 + seed) + nth.astype(np.uint64), 1)
            if ceiling > 1 or (weight[source] < 1).any():
                below = floor + (ceiling - floor) * _uniform(mixed(dart, 2)) < weight[source]
                dart, source = dart[below], source[below]
            rank = low + (high - low) * _uniform(mixed(dart, 3))
            slot = owner[source] * darts + (mixed(dart, 4) % np.uint64(darts)).astype(np.int64)
            np.minimum.at(best, slot, rank)
            first = rank == best[slot]
            value[slot[first]] = dart[first]
        at += 1
        alive = (at < steps) | np.isinf(best.reshape(len(sets), darts)).any(axis=1)
    return value.reshape(len(sets), darts)


def band_keys(marks: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One number per band of a signature."""
    split = marks.reshape(len(marks), bands, -1)
    found = np.broadcast_to(np.arange(bands, dtype=np.uint64), split.shape[:2]).copy()
    for at in range(split.shape[2]):
        found = mixed(found + split[:, :, at], at)
    return found.astype(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    total = float(a[1].sum() + b[1].sum()) - both
    return both / total if total else 0.0


def _banded(texts: DataFrame) -> DataFrame:
    """(node, bands) of each row; a text without words has no bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            found: list = []
            for _, some in text_slices(batch.column("body"), AT_ONCE):
                sets = [shingler.of(text) for text in some]
                full = [at for at, (own, _) in enumerate(sets) if len(own)]
                own: list = [None] * len(some)
                if full:
                    for at, keys in zip(full, band_keys(signatures([sets[at] for at in full])), strict=True):
                        own[at] = keys
                found += own
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["node", "bands"])

    return texts.select("node", "body").mapInArrow(sign, "node string, bands array<bigint>")


def _similar(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar. The text of ``a`` goes once to each task that holds some of its pairs."""
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    bodies = texts.select("node", "body")
    ones = dealt.select("a", "salt").distinct().join(bodies, F.col("a") == F.col("node")).select("a", "salt", F.lit(None).cast("string").alias("b"), "body")
    others = dealt.join(bodies, F.col("b") == F.col("node")).select("a", "salt", "b", "body")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, own = Shingler(), None
        for batch in batches:
            good = []
            other = batch.column("b").is_valid().to_pylist()
            for at, some in text_slices(batch.column("body"), AT_ONCE):
                for nth, text in enumerate(some, at):
                    found = shingler.of(text)
                    if not other[nth]:
                        own = found  # a null comes first, so what follows are its partners
                    good.append(other[nth] and weighted_jaccard(own, found) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = ones.unionByName(others).repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
    return both.select("a", "b", "body").mapInArrow(compare, "a string, b string")


def _pairs_with_pivot(entries: DataFrame, nth: int) -> DataFrame:
    """Each member of a bucket with the bucket's nth pivot, where links do not yet hold them together."""
    draw = F.xxhash64(F.lit(nth), "node")
    pivots = entries.groupBy("band").agg(F.min(F.struct(draw.alias("draw"), "node", "root")).alias("pivot"))
    met = entries.join(pivots.select("band", F.col("pivot.node").alias("pivot"), F.col("pivot.root").alias("pivot_root")), "band")
    met = met.filter("root != pivot_root")
    return met.select(F.col("pivot").alias("a"), F.col("node").alias("b"))


def _small_pairs(sized: DataFrame) -> DataFrame:
    """The pairs of different roots in each small bucket."""
    small = sized.filter(F.col("n") <= SMALL).select("band", "node", "root")
    other = small.select("band", F.col("node").alias("b"), F.col("root").alias("other_root"))
    return small.join(other, "band").filter("root != other_root AND node < b").select(F.col("node").alias("a"), "b")


@dataclass
class _Member:
    tile: int
    node: str
    root: str
    bands: list[int]
    shingles: np.ndarray


def links_of_tiles(band: int, low: list[_Member], high: list[_Member], least: float) -> list[tuple[str, str]]:
    """The similar pairs of different roots between two tiles of a bucket (or inside one, given twice), but for
    pairs that meet in a bucket of a lower number too: their link is found there."""
    inside = low is high
    flat = np.concatenate([member.shingles for member in high])
    owner = np.repeat(np.arange(len(high)), [len(member.shingles) for member in high])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    sizes = np.array([len(member.shingles) for member in high])
    roots = np.array([member.root for member in high])
    holders: dict[int, np.ndarray] = {}
    for nth, member in enumerate(high):
        for each in member.bands:
            if each < band:
                holders.setdefault(each, np.zeros(len(high), bool))[nth] = True
    found = []
    for nth, member in enumerate(low):
        wanted = roots != member.root
        if inside:
            wanted[: nth + 1] = False
        for each in member.bands:
            if each in holders:
                wanted &= ~holders[each]
        if not wanted.any():
            continue
        start, end = np.searchsorted(flat, member.shingles, "left"), np.searchsorted(flat, member.shingles, "right")
        count = end - start
        held = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        both = np.bincount(owner[held], minlength=len(high)).astype(np.float64)
        alike = both / (len(member.shingles) + sizes - both) >= least
        found += [(member.node, high[at].node) for at in np.flatnonzero(wanted & alike)]
    return found


def _tile_links(sized: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The links (a, b) of large buckets: every two tiles of a bucket meet in one place, which emits links only."""
    large = kept(sized.filter(F.col("n") > SMALL).join(texts.select("node", F.octet_length("body").alias("bytes")), "node"))
    cut = F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum("bytes") / TILE_BYTES)).cast("int")
    tiles = large.groupBy("band").agg(cut.alias("tiles"))
    bands = large.groupBy("node").agg(F.collect_list("band").alias("bands"))  # as many as bands at most
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile")
    members = large.select("band", "node", "root").join(tiles, "band").join(bands, "node").select("*", tile)
    places = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    places = places.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, key, held = Shingler(), None, []

        def links() -> pa.RecordBatch:
            low, high = ([member for member in held if member.tile == tile] for tile in key[1:])
            found = links_of_tiles(key[0], low, low if key[1] == key[2] else high, least) if low and high else []
            return pa.RecordBatch.from_arrays([pa.array([pair[side] for pair in found], pa.string()) for side in (0, 1)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("band", "low", "high", "tile", "node", "root", "bands")]
            for at, some in text_slices(batch.column("body"), AT_ONCE):
                for nth, text in enumerate(some, at):
                    band, low, high, *about = [column[nth] for column in columns]
                    if key != (band, low, high):
                        if held:
                            yield links()
                        key, held = (band, low, high), []
                    held.append(_Member(*about, shingler.of(text)[0]))
        if held:
            yield links()

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = places.join(texts.select("node", "body"), "node").select("band", "low", "high", "tile", "node", "root", "bands", "body")
    met = met.repartition(parts, "band", "low", "high").sortWithinPartitions("band", "low", "high", "node")
    return met.mapInArrow(compare, "a string, b string")


def _tidy(pairs: DataFrame) -> DataFrame:
    # the pivot, which many pairs share, stays on its side; a pair in both orders is one
    return pairs.withColumn("low", F.least("a", "b")).withColumn("high", F.greatest("a", "b")).groupBy("low", "high").agg(F.min("a").alias("a"))


def _open_entries(entries: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Entries with the root of their node, of the buckets whose members have more than one root."""
    entries = entries.select("band", "node")
    if roots is None:
        rooted = entries.withColumn("root", F.col("node"))
    else:
        rooted = entries.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    apart = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    return rooted.join(apart.select("band"), "band", "left_semi")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``node`` (the digest of the text), class_id and kept.

    Rows are in one class if a chain of texts links them, each at least ``least`` similar to the next
    (equal texts are). class_id is the least id of the class; kept is true where the id is that one. A
    text shorter than five words is one shingle; null, empty and wordless texts link with nothing, nor
    with each other. A null id never names a class that has another; rows without any named row in their
    class are kept. Repeated rows fare alike. An empty table gives an empty one; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("body")).withColumn("node", F.md5("body"))
    signed = kept(_banded(rows))
    entries = signed.filter(F.col("bands").isNotNull()).dropDuplicates(["node"]).select("node", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low != high").select("band")
    entries = kept(entries.join(shared, "band", "left_semi"))
    wanted = entries.select("node").distinct()
    texts = stored(rows.select("node", "body").join(wanted, "node", "left_semi").groupBy("node").agg(F.first("body").alias("body")), "near-texts")

    edges, compared, roots = None, None, None
    for turn in range(PIVOTS + 1):
        entries = kept(_open_entries(entries, roots))
        entries = gathered(entries, entries.count())
        last = turn == PIVOTS
        sized = kept(entries.join(entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")), "band")) if last else None
        pairs = _tidy(_small_pairs(sized) if last else _pairs_with_pivot(entries, turn))
        if compared is not None:
            pairs = pairs.join(compared, ["low", "high"], "left_anti")
        pairs = kept(pairs.select("low", "high", "a", F.when(F.col("a") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("b")))
        found, n_pairs = None, pairs.count()
        pairs = gathered(pairs, n_pairs)
        if n_pairs:
            found = kept(_similar(pairs.select("a", "b"), texts, least))
            done = pairs.select("low", "high")
            compared = done if compared is None else compared.unionByName(done)
        if last and not sized.filter(F.col("n") > SMALL).isEmpty():
            more = kept(_tile_links(sized, texts, least))
            found = more if found is None else found.unionByName(more)
        if found is not None:
            found = gathered(found, found.count())
            edges = found if edges is None else edges.unionByName(found)
            roots = components(edges)
    members = rows.select("id", "node")
    wordless = signed.filter(F.col("bands").isNull()).select("node").distinct()
    members = members.join(wordless.withColumn("wordless", F.lit(True)), "node", "left")
    if roots is not None:
        members = members.join(roots, "node", "left")
    else:
        members = members.withColumn("root", F.lit(None).cast("string"))
    members = members.withColumn("root", F.when(F.col("wordless").isNull(), F.coalesce("root", "node")))
    named = members.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("class_id"))
    joined = members.join(named, "root", "left").withColumn("class_id", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("class_id")))
    return joined.select(F.col("id").alias(id_col), "node", "class_id", (F.col("class_id").isNull() | F.coalesce(F.col("id") == F.col("class_id"), F.lit(False))).alias("kept"))


def one_of_each(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns; of rows equal in id and text one."""
    stays = near_duplicates(docs, least, id_col, text_col).filter("kept")
    stays = kept(stays.groupBy(F.col(id_col).alias("id"), "node").agg(F.count(F.lit(1)).alias("rows")))
    # the row travels as one value, so that no column of the caller's meets one of ours
    given = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id"), F.md5(text_of(F.col(text_col))).alias("own"))
    joined = given.join(stays, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("node")))
    single = joined.filter("rows = 1")
    repeated = joined.filter("rows > 1").dropDuplicates(["own_id", "own"])
    return single.unionByName(repeated).select("row.*")
