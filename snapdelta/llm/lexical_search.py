"""Ranked lexical search over bit-sliced Bloom signatures.

Each document is a row of a Bloom filter of its terms; the filters of documents of like size lie side by
side in a block, cut the other way into slices, one bitmap over the documents per filter position. The
documents that may hold a term are the AND of a few slices. Terms go in once for each level of their
frequency that they reach (1, 2, 3, 4, 6, 8, 12 ...), so the highest level whose bits are set bounds the
frequency from above, and with the document's length, stored exactly, the term's share of the score. The
weighted sum over an item's terms is an upper bound of the score: filters give too much, never too little.

A search reads the blocks, not the texts: the documents of the highest bounds are scored exactly first, and
the last of the wanted ranks among them is a score that every result reaches. All documents whose bound does
reach it are then scored exactly from their texts; the rest are provably out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from snapdelta.llm.frames import kept, stored
from snapdelta.llm.rows import numbered, text_slices
from snapdelta.llm.words import mixed, text_hashes

RANKS = 50
#: Filter positions per entry of the fullest document of a block, and positions that an entry sets.
BITS, SETS = 12, 6
#: Bytes of text whose signatures a task makes together.
AT_ONCE = 4_000_000
#: Documents of the highest bounds per item that are scored first; more give a better bar, not other results.
FIRST = 2 * RANKS
#: Bytes of item text that are searched for in one pass over the blocks.
PIECE_BYTES = 2_000_000
#: Chosen documents are sent to the texts up to this size, and joined with them by a shuffle beyond it.
BROADCAST_BYTES = 8_000_000

#: Fixed values of the terms: A-Z in lower case; what is neither a letter, a digit nor beyond ASCII parts terms.
_FOLD = bytes(
    at + 32 if 0x41 <= at <= 0x5A else 32 if at < 0x30 or 0x3A <= at <= 0x40 or 0x5B <= at <= 0x60 or 0x7B <= at <= 0x7F else at
    for at in range(256)
)


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def _levels() -> np.ndarray:
    """The least frequency of each level: powers of two and what lies in the middle between them."""
    powers = [1 << at for at in range(40)]
    return np.array(sorted({*powers, *(3 * power // 2 for power in powers[1:])}), np.int64)


LEVELS = _levels()


def _positions(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The filter positions of entries, one row each."""
    start = mixed(hashes, 100 + level)
    stride = mixed(start, 1) | np.uint64(1)
    return ((start[:, None] + np.arange(SETS, dtype=np.uint64) * stride[:, None]) % np.uint64(width)).astype(np.int64)


BLOCK = (
    "rows array<bigint>, n array<bigint>, width bigint, slices binary, terms array<binary>, df array<bigint>, "
    "n_docs bigint, n_terms bigint"
)


def _blocks_of(rows: np.ndarray, texts: list[str]) -> Iterator[dict]:
    """The blocks of some texts, one for each power of two of entries; the first carries the counts of all terms."""
    terms: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for nth, text in enumerate(texts):
        own = terms_of(text)
        counts[nth] = len(own)
        terms += own
    if not terms:
        return
    coded = pa.array(terms, pa.binary()).dictionary_encode()
    del terms
    size = len(coded.dictionary)
    owner = np.repeat(np.arange(len(texts)), counts)
    pair, often = np.unique(owner * size + coded.indices.to_numpy(), return_counts=True)
    owner, term = pair // size, pair % size
    hashes = text_hashes(coded.dictionary)
    reached = np.searchsorted(LEVELS, often, "right")  # levels that each (document, term) enters
    entries = np.bincount(owner, reached, len(texts)).astype(np.int64)
    shelf = np.where(entries > 0, np.frexp(entries)[1], 0)
    seen = {"terms": coded.dictionary.to_pylist(), "df": np.bincount(term, minlength=size).tolist(), "n_docs": int((counts > 0).sum()), "n_terms": int(counts.sum())}
    for at in np.unique(shelf[shelf > 0]):
        docs = np.flatnonzero(shelf == at)
        place = np.full(len(texts), -1)
        place[docs] = np.arange(len(docs))
        inside = place[owner] >= 0
        column, own, depth = place[owner[inside]], hashes[term[inside]], reached[inside]
        width = BITS * int(entries[docs].max())
        bits = np.zeros((width, len(docs)), bool)
        for level in range(int(depth.max())):
            deep = depth > level
            bits[_positions(own[deep], level, width), column[deep][:, None]] = True
        yield {"rows": rows[docs].tolist(), "n": counts[docs].tolist(), "width": width, "slices": np.packbits(bits, axis=1).tobytes(), **seen}
        seen = {"terms": [], "df": [], "n_docs": 0, "n_terms": 0}


@dataclass(frozen=True)
class Index:
    """``rows`` (row, id, body) and the signature ``blocks`` over them, both stored."""

    rows: DataFrame
    blocks: DataFrame


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Signatures of all rows of ``docs``; a row without a term (null and empty texts) has none."""
    rows = numbered(docs, id_col, text_col, "search-texts")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("rows", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("width", pa.int64()), ("slices", pa.binary()),
             ("terms", pa.list_(pa.binary())), ("df", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_terms", pa.int64())]
        )
        for batch in batches:
            numbers = batch.column("row").to_numpy()
            for at, texts in text_slices(batch.column("body"), AT_ONCE):
                for block in _blocks_of(numbers[at : at + len(texts)], texts):
                    yield pa.RecordBatch.from_pylist([block], schema)

    return Index(rows, stored(rows.select("row", "body").mapInArrow(sign, BLOCK), "search-blocks"))


@dataclass(frozen=True)
class Questions:
    """Some items as lists of term numbers, with the hash and weight of each term and the sizes of the corpus."""

    items: list[int]
    words: list[list[bytes]]
    numbers: list[np.ndarray]
    hashes: np.ndarray
    weights: dict[bytes, int]
    weight: np.ndarray
    n_docs: int
    n_terms: int

    def norms(self, n: np.ndarray) -> np.ndarray:
        """The length part of the score: 100 - 50 + 50 n / (mean n), rounded down."""
        return 50 + 50 * n * self.n_docs // self.n_terms

    def bounds(self, width: int, n: np.ndarray, slices: bytes) -> np.ndarray:
        """The upper bound of each item's score in each document of a block."""
        bits = np.frombuffer(slices, np.uint8).reshape(width, -1)
        norms = self.norms(n)
        share = np.zeros((len(self.hashes), len(n)), np.int64)
        alive = np.arange(len(self.hashes))
        before = np.full((len(alive), bits.shape[1]), 255, np.uint8)
        for level in range(len(LEVELS)):
            held = before & np.bitwise_and.reduce(bits[_positions(self.hashes[alive], level, width)], axis=1)
            some = held.any(axis=1)
            alive, before = alive[some], held[some]
            if not len(alive):
                break
            which, doc = np.nonzero(np.unpackbits(before, axis=1, count=len(n)))
            # a term that reaches this level and no higher one occurs at most so often
            most = np.minimum(LEVELS[level + 1] - 1 if level + 1 < len(LEVELS) else n.max(), n[doc])
            share[alive[which], doc] = 1_000_000_000 * most // (1000 * most + 20 * norms[doc])
        share *= self.weight[:, None]
        return np.stack([share[own].sum(axis=0) for own in self.numbers])

    def score(self, nth: int, found: Counter, n: int) -> int:
        norm = 50 + 50 * n * self.n_docs // self.n_terms
        return sum(self.weights[word] * (1_000_000_000 * found[word] // (1000 * found[word] + 20 * norm)) for word in self.words[nth] if found[word])


def _questions(spark: SparkSession, index: Index, items: list, n_docs: int, n_terms: int) -> Questions:
    words = [sorted(set(terms_of(row["body"]))) for row in items]
    known = sorted(set().union(*words))
    asked = spark.createDataFrame([(word,) for word in known], "term binary")
    counted = index.blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).select("x.terms", "x.df")
    counted = counted.withColumnRenamed("terms", "term").join(asked, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    df = {bytes(row["term"]): row["df"] for row in counted.collect()}  # terms of the items at most
    weights = {word: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(word, 0) + 1))) for word in known}
    place = {word: at for at, word in enumerate(known)}
    numbers = [np.array([place[word] for word in own], np.int64) for own in words]
    hashes = text_hashes(pa.array(known, pa.binary())) if known else np.zeros(0, np.uint64)
    weight = np.array([weights[word] for word in known], np.int64)
    return Questions([row["row"] for row in items], words, numbers, hashes, weights, weight, n_docs, n_terms)


def _highest(index: Index, asked, most: int) -> DataFrame:
    """(row, items): the ``most`` documents of the highest bounds of each item."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = asked.value
        rows = np.zeros((len(questions.items), 0), np.int64)
        best = np.zeros((len(questions.items), 0), np.int64)
        for batch in batches:
            for block in _read(batch):
                bounds = questions.bounds(*block[1:])
                best = np.concatenate([best, bounds], axis=1)
                rows = np.concatenate([rows, np.broadcast_to(block[0], bounds.shape)], axis=1)
                if best.shape[1] > most:
                    top = np.argpartition(best, best.shape[1] - most, axis=1)[:, -most:]
                    best, rows = np.take_along_axis(best, top, 1), np.take_along_axis(rows, top, 1)
        item, column = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(rows[item, column]), pa.array(best[item, column])], names=["item", "row", "bound"])

    found = index.blocks.select("rows", "n", "width", "slices").mapInArrow(look, "item int, row long, bound long")
    # in two steps, so that no task ranks the offers of all tasks for an item
    order = [F.desc("bound"), "row"]
    for keys in (["item", F.pmod("row", F.lit(64))], ["item"]):
        found = found.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("nth") <= most).drop("nth")
    return found.groupBy("row").agg(F.collect_list("item").alias("items"))  # at most all items of a piece


def _possible(index: Index, asked, bars: list[int]) -> DataFrame:
    """(row, items): the documents whose bound for the items is at least 1 and the item's bar."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bar = np.maximum(np.array(bars, np.int64), 1)[:, None]
        for batch in batches:
            for block in _read(batch):
                doc, item = np.nonzero((asked.value.bounds(*block[1:]) >= bar).T)
                docs, first = np.unique(doc, return_index=True)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)), pa.int32()), pa.array(item, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(block[0][docs]), lists], names=["row", "items"])

    return index.blocks.select("rows", "n", "width", "slices").mapInArrow(look, "row long, items array<int>")


def _read(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int, np.ndarray, bytes]]:
    for at in range(len(batch)):
        row = batch.slice(at, 1)
        yield row.column("rows")[0].values.to_numpy(), row.column("width")[0].as_py(), row.column("n")[0].values.to_numpy(), row.column("slices")[0].as_py()


def _scored(index: Index, asked, chosen: DataFrame) -> DataFrame:
    """(item, row, id, score) of the chosen (row, items), from the texts; only scores above 0."""
    docs, pairs = chosen.agg(F.count(F.lit(1)), F.sum(F.size("items"))).first()
    if 40 * docs + 4 * (pairs or 0) <= BROADCAST_BYTES:
        chosen = F.broadcast(chosen)
    id_type = index.rows.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = asked.value
        for batch in batches:
            for at, texts in text_slices(batch.column("body"), AT_ONCE):
                part = batch.slice(at, len(texts))
                took, items, scores = [], [], []
                for nth, (text, wanted) in enumerate(zip(texts, part.column("items").to_pylist(), strict=True)):
                    terms = terms_of(text)
                    found = Counter(terms)
                    for item in wanted:
                        took.append(nth)
                        items.append(item)
                        scores.append(questions.score(item, found, len(terms)))
                own = part.take(pa.array(took, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), own.column("row"), own.column("id"), pa.array(scores, pa.int64())], names=["item", "row", "id", "score"])

    found = index.rows.join(chosen, "row").select("row", "id", "body", "items")
    return found.mapInArrow(score, f"item int, row long, id {id_type}, score long").filter("score > 0")


def _ranked(scored: DataFrame, ranks: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)


def search(
    index: Index, items: DataFrame, ranks: int = RANKS, item_col: str = "item_id", text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(item id, rank, document id, score) of the ``ranks`` best rows of the index for each row of ``items``.

    Terms are maximal runs of ASCII letters and digits and characters beyond ASCII, A-Z in lower case. With N
    rows that hold a term, L terms in all, n in a row, df rows that hold the term and tf its count in the row,
    a term weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))); a row's score is the sum, over the item's
    different terms, of w ((10^9 tf) div (1000 tf + 20 m)) with m = 50 + (50 n N) div L. Only scores above 0
    are ranks; equal scores go by ascending id, null ids last, then by place in the table. A repeated row is a
    document of its own, a repeated item a question of its own. A null or empty text, of a row or an item, has
    no terms: it finds nothing and is not found. Empty tables give an empty one; other columns are not read.
    """
    spark = items.sparkSession
    asked_items = numbered(items, item_col, text_col, "search-items")
    size = asked_items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    pieces = size // PIECE_BYTES + 1
    total = index.blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    results = None
    for piece in range(pieces):
        rows = sorted(asked_items.filter(F.pmod(F.xxhash64("row"), F.lit(pieces)) == piece).select("row", "body").collect())
        if not rows or not total[0]:
            continue
        questions = _questions(spark, index, rows, *total)
        asked = spark.sparkContext.broadcast(questions)  # a piece of items
        first = _ranked(_scored(index, asked, kept(_highest(index, asked, max(ranks, FIRST)))), ranks)
        last = {row["item"]: row["score"] for row in first.filter(F.col("rank") == ranks).select("item", "score").collect()}
        chosen = kept(_possible(index, asked, [last.get(nth, 0) for nth in range(len(rows))]))
        best = kept(_ranked(_scored(index, asked, chosen), ranks))
        names = spark.createDataFrame([(nth, row["row"]) for nth, row in enumerate(rows)], "item int, row long")
        named = best.drop("row").join(names, "item").select("row", "rank", "id", "score")
        results = named if results is None else results.unionByName(named)
    if results is None:
        id_type = index.rows.schema["id"].dataType.simpleString()
        results = spark.createDataFrame([], f"row long, rank int, id {id_type}, score long")
    found = results.join(asked_items.select("row", F.col("id").alias("item")), "row")
    return found.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
