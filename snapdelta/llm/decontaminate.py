"""Benchmark decontamination by a BM25 index of the test items.

The items are indexed by their words, with BM25 weights divided by what an item scores against
itself. Every training passage (windows of words that overlap by half, over the whole text) queries
the index by block-max WAND: the items lie in blocks, each word has its greatest weight in each block,
and a block is looked into only if those bounds add up to the threshold. All items at or above the
threshold are retrieved, and a hit stands if enough of the item's five-word shingles are in the text
around it, of its question and of its answer.

Items lie in classes by their length. The passages of a class are at least twice as long as its longest
item, so that a copy of an item of any length lies whole in some passage, wherever it stands; a hit is
verified in its passages and as many words as the item has on both sides.

The index is built in pieces of a bounded size, and each piece is taken to all passages.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from snapdelta.llm.frames import kept, text_of
from snapdelta.llm.rows import text_slices
from snapdelta.llm.words import REMEMBERED, chunks

K1, B = 1.2, 0.75
#: Marks around a word.
EDGES = string.punctuation + "“”‘’„…–—«»¿¡"
#: Words of the shortest passages, those of the items of up to half as many; those of longer items are twice as
#: long, and so on. The next passage starts half as many words on.
WINDOW = 64
#: A passage is a hit if it scores this share of what the item scores against itself.
SCORE = 0.55
#: Shares of the item's, the question's and the answer's shingles that the text around a hit must hold.
OVERLAP = 0.5
PART_OVERLAP = 0.3
SHINGLE = 5
#: Items in a block, runs of blocks of a class whose bounds are added up for every passage, and bytes of item text in a piece
#: of the index that is sent to all executors.
BLOCK = 4
RUNS = 32
PIECE_BYTES = 8_000_000


def bare(token: str) -> str:
    return token.strip(EDGES)


class Rows(dict):
    """The index row of a token, remembered; -1 if the index lacks it."""

    def __init__(self, rows: dict[str, int]):
        self._rows = rows

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        row = self[token] = self._rows.get(bare(token), -1)
        return row


def words_of(text: str) -> list[str]:
    """The words between white space, in small letters, without the marks around them."""
    return [word for token in text.lower().split() if (word := bare(token))]


def grams(words: list[str], width: int = SHINGLE) -> list[tuple[str, ...]]:
    """Runs of ``width`` words; of fewer words, the one run of them all."""
    return [tuple(words[at : at + width]) for at in range(max(1, len(words) - width + 1))] if words else []


def window_of(count: int) -> int:
    """Words of the passages that ask for an item of ``count`` words, marks that stand alone among them."""
    window = WINDOW
    while window < 2 * count:
        window *= 2
    return window


def question_and_answer(words: list[str]) -> tuple[list[str], list[str]]:
    """An item without marked parts: its last quarter, at least a shingle, counts as the answer."""
    answer = min(len(words), max(SHINGLE, len(words) // 4))
    return (words[:-answer] or words), words[-answer:]


@dataclass
class LengthClass:
    """The blocks from ``first`` up to ``end``, whose items are asked by passages of ``window`` words."""

    window: int
    first: int
    end: int
    run_bounds: np.ndarray


@dataclass
class Index:
    """Blocks of items, each of one length class, the bounds of each word by block, and the postings within each block."""

    ids: list
    items: list[list[str]]
    rows: dict[str, int] = field(default_factory=dict)
    bounds: np.ndarray | None = None
    lengths: list[int] = field(default_factory=list)
    classes: list[LengthClass] = field(default_factory=list)
    seen: Rows | None = None
    postings: list[dict[int, tuple[np.ndarray, np.ndarray]]] = field(default_factory=list)

    @classmethod
    def of(cls, items: list[tuple], frequency: dict[str, int], count: int, mean_words: float) -> Index:
        """``frequency``: in how many of all ``count`` items a word stands."""
        ranked = sorted(((len(text.split()), words_of(text), item) for item, text in items), key=lambda x: (window_of(x[0]), x[1], str(x[2])))
        made = cls([item for _, _, item in ranked], [words for _, words, _ in ranked], lengths=[length for length, _, _ in ranked])
        weights = []
        for words in made.items:
            tally: dict[str, int] = {}
            for word in words:
                tally[word] = tally.get(word, 0) + 1
            scale = K1 * (1 - B + B * len(words) / max(1.0, mean_words))
            own = {w: log(1 + (count - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * (K1 + 1) / (n + scale) for w, n in tally.items()}
            total = sum(own.values()) or 1.0
            weights.append({w: x / total for w, x in own.items()})
        for own in weights:
            for word in own:
                made.rows.setdefault(word, len(made.rows))
        windows = [window_of(length) for length in made.lengths]
        block_of, blocks, spans = [], 0, []
        for window in sorted(set(windows)):
            count_of = windows.count(window)
            block_of += [blocks + at // BLOCK for at in range(count_of)]
            spans.append((window, blocks, blocks - (-count_of // BLOCK)))
            blocks = spans[-1][2]
        made.bounds = np.zeros((len(made.rows), blocks), np.float32)
        lists: list[dict[int, tuple[list, list]]] = [{} for _ in range(blocks)]
        for at, own in enumerate(weights):
            block = block_of[at]
            for word, x in own.items():
                row = made.rows[word]
                made.bounds[row, block] = max(made.bounds[row, block], np.nextafter(np.float32(x), np.float32(2)))
                items_of, weights_of = lists[block].setdefault(row, ([], []))
                items_of.append(at)
                weights_of.append(x)
        # no word is row -1, which bounds nothing
        made.bounds = np.vstack([made.bounds, np.zeros((1, blocks), np.float32)])
        for window, first, end in spans:
            runs = np.arange(0, end - first, -(-(end - first) // RUNS))
            made.classes.append(LengthClass(window, first, end, np.maximum.reduceat(made.bounds[:, first:end], runs, axis=1)))
        made.postings = [{row: (np.array(i), np.array(x)) for row, (i, x) in block.items()} for block in lists]
        return made

    def numbers(self, tokens: list[str]) -> np.ndarray:
        if self.seen is None:
            self.seen = Rows(self.rows)
        return np.fromiter(map(self.seen.__getitem__, tokens), np.int64, len(tokens))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": None}

    def wand(self, rows: np.ndarray, blocks: np.ndarray, least: float) -> list[tuple[int, float]]:
        """Items that a passage of distinct words scores at least ``least``, among blocks whose bounds allow it.

        The words of a block are opened from the greatest bound on; an item comes into play only while the
        bounds of the words not yet opened could still carry it to the threshold."""
        found = []
        for block in blocks:
            lists = self.postings[block]
            here = [row for row in rows if row in lists]
            bound = self.bounds[here, block].astype(np.float64)
            order = np.argsort(-bound, kind="stable")
            rest = float(bound.sum())
            scores: dict[int, float] = {}
            for at in order:
                fresh = rest >= least
                rest -= bound[at]
                for item, x in zip(*lists[here[at]], strict=True):
                    if item in scores:
                        scores[item] += x
                    elif fresh:
                        scores[item] = x
            found += [(item, score) for item, score in scores.items() if score >= least]
        return found


def passages(count: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Windows over ``count`` words, each half a window on; the last one ends with the text."""
    step = window // 2
    return [(at, min(count, at + window)) for at in range(0, max(1, count - step), step)]


def _bounded(own: LengthClass, numbers: list[np.ndarray], least: float) -> Iterator[tuple[int, int, int]]:
    """(text, first word, end word) of the passages that some run of blocks of a class allows to reach ``least``.

    A passage is two halves; the greatest weights of a half's distinct words are added up for each run of
    blocks at once, for all texts."""
    step = own.window // 2
    lengths = np.array([len(rows) for rows in numbers], np.int64)
    halves = np.maximum(1, -(-lengths // step))
    first_half = np.concatenate([[0], np.cumsum(halves)])
    flat = np.concatenate(numbers)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    half = np.repeat(first_half[:-1], lengths) + inside // step
    known = flat >= 0
    width = len(own.run_bounds)
    distinct = np.unique(half[known] * width + flat[known])
    at, rows = distinct // width, distinct % width
    sums = np.zeros((first_half[-1], own.run_bounds.shape[1]), np.float32)
    if len(at):
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        sums[at[starts]] = np.add.reduceat(own.run_bounds[rows], starts, axis=0)
    both = sums.copy()
    both[:-1] += sums[1:]
    last = first_half[1:] - 1
    both[last] = sums[last]
    owner = np.repeat(np.arange(len(numbers)), halves)
    for place in np.flatnonzero(both.max(axis=1, initial=0) >= least - 1e-4):
        text = owner[place]
        start = (place - first_half[text]) * step
        # the last half of a text is a passage of its own only if it is the only one
        if start == 0 or start + step < lengths[text]:
            yield int(text), int(start), int(min(lengths[text], start + own.window))


def hits_of(index: Index, texts: list[list[str]], least: float = SCORE) -> list[dict[int, tuple[float, int, int]]]:
    """For each text (its tokens) the items that its passages retrieve: best score, first and end word of the hits."""
    found: list[dict[int, tuple[float, int, int]]] = [{} for _ in texts]
    if not texts or not index.ids:
        return found
    numbers = [index.numbers(words) for words in texts]
    for own in index.classes:
        for text, start, end in _bounded(own, numbers, least):
            rows = np.unique(numbers[text][start:end])
            rows = rows[rows >= 0]
            blocks = own.first + np.flatnonzero(index.bounds[rows, own.first : own.end].sum(axis=0, dtype=np.float64) >= least)
            for item, score in index.wand(rows, blocks, least) if len(blocks) else ():
                old = found[text].get(item)
                found[text][item] = (score, start, end) if old is None else (max(score, old[0]), min(start, old[1]), max(end, old[2]))
    return found


def verified(item: list[str], around: list[str]) -> tuple[float, float, float]:
    """Shares of the item's, its question's and its answer's distinct shingles that a stretch of text holds."""
    parts = (item, *question_and_answer(item))
    # a stretch shorter than a shingle holds runs of the part's own width
    shares = []
    for part in parts:
        width = min(SHINGLE, len(part))
        held = set(grams(around, width)) if width else set()
        own = set(grams(part, width)) if width else set()
        shares.append(len(own & held) / len(own) if own else 0.0)
    return tuple(shares)


def _pieces(items: DataFrame) -> Iterator[list[tuple]]:
    """Items in pieces of at most ``PIECE_BYTES`` of text (or one item), read one after the other."""
    held, size = [], 0
    for row in items.toLocalIterator():
        size += len(row["body"])
        if held and size > PIECE_BYTES:
            yield held
            held, size = [], len(row["body"])
        held.append((row["item"], row["body"]))
    if held:
        yield held


#: Bytes of text that a task turns into strings at once.
AT_ONCE = 1_000_000


def leaks_of(index: Index, texts: list[str], least: float = SCORE, overlap: float = OVERLAP) -> list[list[tuple]]:
    """For each text (item, score, shares of item, question and answer, first word, end word) of each item that it leaks."""
    found = []
    for some in chunks(texts, 1_000_000):
        tokens = [text.lower().split() for text in some]
        for own, hits in zip(tokens, hits_of(index, tokens, least), strict=True):
            leaks = []
            for at, (score, start, end) in hits.items():
                around = own[max(0, start - index.lengths[at]) : end + index.lengths[at]]
                shares = verified(index.items[at], [word for token in around if (word := bare(token))])
                if shares[0] >= overlap and min(shares[1:]) >= PART_OVERLAP:
                    leaks.append((index.ids[at], score, *shares, start, end))
            found.append(leaks)
    return found


def _indexes(benchmark: DataFrame, item_col: str, item_text_col: str) -> Iterator[Broadcast]:
    """The index in pieces of bounded size, each sent to all executors."""
    spark = benchmark.sparkSession
    items = kept(benchmark.select(F.col(item_col).alias("item"), text_of(item_text_col).alias("body")).filter("body != ''"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(text) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(own) for own in words], pa.int32()), pa.array([sorted(set(own)) for own in words], pa.list_(pa.string()))], names=["n", "words"])

    counted = kept(items.select("body").mapInArrow(split, "n int, words array<string>"))
    count, mean = counted.agg(F.count(F.lit(1)), F.avg("n")).first()
    listed = counted.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    for piece in _pieces(items):
        own: dict[str, int] = {}
        for _, text in piece:
            for word in set(words_of(text)):
                own[word] = own.get(word, 0) + 1
        if len(piece) < count:  # in how many items of all pieces; the words of a piece are as bounded as it is
            wanted = spark.createDataFrame([(word,) for word in sorted(own)], "word string")
            own |= {word: max(own[word], n) for word, n in listed.join(F.broadcast(wanted), "word").collect()}
        yield spark.sparkContext.broadcast(Index.of(piece, own, count, float(mean)))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    least: float = SCORE,
    overlap: float = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item, score, overlap, question_overlap, answer_overlap, first_word, end_word): one row for each row of
    ``docs`` and item that it leaks.

    Items without words match nothing; of fewer words than a shingle, an item is one shingle. Null texts
    are empty and leak nothing; a repeated row or item gives its rows again; empty tables give an empty
    one; other columns are not read. All passages of all texts are asked.
    """
    kinds = (docs.schema[id_col].dataType, benchmark.schema[item_col].dataType)
    shares = ("score", "overlap", "question_overlap", "answer_overlap")
    result = StructType([StructField("id", kinds[0]), StructField("item", kinds[1])])
    for name in shares:
        result.add(name, "double")
    result.add("first_word", "integer").add("end_word", "integer")
    arrow = to_arrow_schema(result)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("body"))
    found = docs.sparkSession.createDataFrame([], result)
    for index in _indexes(benchmark, item_col, item_text_col):

        def look(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                leaks = [
                    (ids[at], *leak)
                    for first, texts in text_slices(batch.column(1), AT_ONCE)
                    for at, own in enumerate(leaks_of(index.value, texts, least, overlap), first)
                    for leak in own
                ]
                columns = zip(*leaks, strict=True) if leaks else [[]] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        found = found.unionByName(rows.mapInArrow(look, result))
    return found.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least: float = SCORE,
    overlap: float = OVERLAP,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns: a filter for each piece of the index, no shuffle."""
    for index in _indexes(benchmark, item_col, item_text_col):

        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                stays = []
                for _, texts in text_slices(batch.column(text_col), AT_ONCE):
                    stays += [not leaks for leaks in leaks_of(index.value, [text or "" for text in texts], least, overlap)]
                yield batch.filter(pa.array(stays, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
