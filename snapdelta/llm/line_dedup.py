"""Lines that many documents share, as a compressed keep bitmap per document.

Every line is reduced to a 128-bit hash of its key and the number of its row and its place. These narrow
rows are dealt by ranges of (hash, row) and sorted by (hash, row, place), so that one pass over a task's
rows meets each key's occurrences in a stretch, first occurrence first, and knows how many documents hold
it without remembering the key. A very common key is cut over several tasks by the same ranges: only such
keys, at most one per border of two tasks, are counted on their own. What comes back are places to drop,
gathered per document into a bitmap; texts are not moved to find them.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapdelta.llm.frames import kept
from snapdelta.llm.rows import numbered, text_slices

#: A key found in this many documents is boilerplate.
LEAST_DOCS = 10
#: What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
#: Bytes of text that a task turns into strings at once.
AT_ONCE = 2_000_000


def _lines(rows: DataFrame) -> DataFrame:
    """(high, low, row, at) of each line whose key is not empty; the two numbers are the hash of its key."""
    plain = F.translate("body", string.ascii_uppercase, string.ascii_lowercase)
    lines = rows.select("row", F.posexplode(F.split(plain, "\n", -1)).alias("at", "line"))
    keys = lines.select("row", "at", F.btrim("line", F.lit(BLANKS)).alias("key")).filter("key != ''")
    return keys.select(F.xxhash64("key").alias("high"), F.xxhash64(F.lit(1), "key").alias("low"), "row", "at")


def _crossing(ordered: DataFrame) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(documents, row and place of the first occurrence) of each key that goes on in the next task."""
    key = F.struct("high", "low")
    ends = ordered.groupBy(F.spark_partition_id().alias("part")).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    ends = sorted(ends.collect())  # a row per task
    keys = {tuple(left["last"]) for left, right in pairwise(ends) if left["last"] == right["first"]}
    if not keys:
        return {}
    some = ordered.filter(F.col("high").isin([high for high, _ in keys]))
    # a key's documents are apart by task already, so its count is folded in each task
    found = some.groupBy("high", "low", "row").agg(F.min("at").alias("at"))
    found = found.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "at")).alias("first"))
    return {(r["high"], r["low"]): (r["n"], r["first"]["row"], r["first"]["at"]) for r in found.collect() if (r["high"], r["low"]) in keys}


class _Stream:
    """One pass over sorted (high, low, row, at) arrays; gives the (row, at) of the lines to drop."""

    def __init__(self, least_docs: int, keep_first: bool, crossing: dict):
        self._least = least_docs
        self._keep_first = keep_first
        self._crossing = crossing
        self._key: tuple[int, int] | None = None  # of the stretch that the last arrays ended in
        self._docs, self._last_row = 0, -1
        self._pending: list[tuple[np.ndarray, np.ndarray]] = []  # its lines, while it may still stay

    def take(self, high: np.ndarray, low: np.ndarray, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turn = np.flatnonzero((high[1:] != high[:-1]) | (low[1:] != low[:-1])) + 1
        starts = np.concatenate([[0], turn])
        ends = np.concatenate([turn, [len(row)]])
        other_doc = np.ones(len(row), np.int64)
        other_doc[1:] = row[1:] != row[:-1]
        other_doc[starts] = 1
        docs = np.add.reduceat(other_doc, starts)
        keep = np.zeros(len(row), bool)
        goes_on = self._key == (int(high[0]), int(low[0]))
        if self._keep_first:
            keep[starts[int(goes_on) :]] = True
        pending = self._pending if goes_on else []
        if goes_on:
            docs[0] += self._docs - int(row[0] == self._last_row)
        for nth in {0, len(starts) - 1}:  # only the outer stretches may go on in other tasks
            known = self._crossing.get((int(high[starts[nth]]), int(low[starts[nth]])))
            if known:
                own = slice(starts[nth], ends[nth])
                keep[own] = self._keep_first & (row[own] == known[1]) & (at[own] == known[2])
                docs[nth] = known[0]
        often = docs >= self._least
        dropped = np.repeat(often, ends - starts) & ~keep
        out = (row[dropped], at[dropped])
        if often[0] and pending:
            out = tuple(np.concatenate([*parts]) for parts in zip(*pending, out, strict=True))
        last = slice(starts[-1], ends[-1])
        self._key = (int(high[-1]), int(low[-1]))
        self._docs, self._last_row = int(docs[-1]), int(row[-1])
        before = pending if len(starts) == 1 else []
        self._pending = [] if often[-1] else [*before, (row[last][~keep[last]], at[last][~keep[last]])]
        return out


def _dropped(ordered: DataFrame, least_docs: int, keep_first: bool) -> DataFrame:
    """(row, at) of every line to drop."""
    crossing = _crossing(ordered)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Stream(least_docs, keep_first, crossing)
        for batch in batches:
            if len(batch):
                row, at = state.take(*[batch.column(name).to_numpy() for name in ("high", "low", "row", "at")])
                yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(at, pa.int32())], names=["row", "at"])

    return ordered.mapInArrow(stream, "row long, at int")


def packed(keep: np.ndarray) -> bytes:
    """A keep bitmap, one bit a line, compressed."""
    return zlib.compress(np.packbits(keep).tobytes())


def unpacked(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(rows: DataFrame, least_docs: int = LEAST_DOCS, keep_first: bool = False) -> DataFrame:
    """(row, id, n_lines, n_dropped, keep) of each of the ``numbered`` rows.

    A text is split at line feeds; the key of a line is the line without blanks at both ends, A-Z in lower
    case. The lines of a key that at least ``least_docs`` rows hold are dropped, with ``keep_first`` all but
    the first one (by row number, then place). ``keep`` is the ``packed`` bitmap of the lines that stay, null
    where all do. An empty key is never dropped; an empty text is one empty line. Each row is a document of
    its own, also where its id is null or repeats. Keys are told apart by 128 bits of hash.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _lines(rows).repartitionByRange(parts, "high", "low", "row")
    ordered = kept(dealt.sortWithinPartitions("high", "low", "row", "at"))
    # a list of places is no longer than its document's lines
    places = _dropped(ordered, least_docs, keep_first).groupBy("row").agg(F.collect_list("at").alias("at"))
    n_lines = (F.length("body") - F.length(F.replace("body", F.lit("\n"))) + 1).cast("long")
    found = rows.select("row", "id", n_lines.alias("n_lines")).join(places, "row", "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, bitmaps = [], []
            for n, at in zip(batch.column("n_lines").to_pylist(), batch.column("at"), strict=True):
                counts.append(len(at) if at.is_valid else 0)
                if at.is_valid:
                    keep = np.ones(n, bool)
                    keep[at.values.to_numpy()] = False
                    bitmaps.append(packed(keep))
                else:
                    bitmaps.append(None)
            own = [batch.column(name) for name in ("row", "id", "n_lines")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(counts, pa.int64()), pa.array(bitmaps, pa.binary())], names=["row", "id", "n_lines", "n_dropped", "keep"])

    id_type = rows.schema["id"].dataType.simpleString()
    return found.mapInArrow(pack, f"row long, id {id_type}, n_lines long, n_dropped long, keep binary")


def cleaned(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(row, id, n_lines, n_dropped, body) of each row: the lines that its bitmap keeps, joined by line feeds."""
    joined = rows.select("row", "body").join(bitmaps.select("row", "id", "n_lines", "n_dropped", "keep"), "row")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, bodies in text_slices(batch.column("body"), AT_ONCE):
                part = batch.slice(at, len(bodies))
                texts = []
                for body, bitmap, n in zip(bodies, part.column("keep").to_pylist(), part.column("n_lines").to_pylist(), strict=True):
                    if bitmap is not None:
                        stays = unpacked(bitmap, n)
                        body = "\n".join(line for line, stay in zip(body.split("\n"), stays.tolist(), strict=True) if stay)
                    texts.append(body)
                own = [part.column(name) for name in ("row", "id", "n_lines", "n_dropped")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string())], names=["row", "id", "n_lines", "n_dropped", "body"])

    id_type = rows.schema["id"].dataType.simpleString()
    return joined.mapInArrow(apply, f"row long, id {id_type}, n_lines long, n_dropped long, body string")


def without_common_lines(
    docs: DataFrame, least_docs: int = LEAST_DOCS, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_lines, n_dropped, text) of each row of ``docs`` without the lines that ``keep_bitmaps`` drops.

    A null text is the empty one. Rows that repeat count as often as they stand there and fare alike (but for
    ``keep_first``). An empty table gives an empty one; other columns are not read.
    """
    rows = numbered(docs, id_col, text_col, "line-texts")
    found = cleaned(rows, keep_bitmaps(rows, least_docs, keep_first))
    return found.select(F.col("id").alias(id_col), "n_lines", "n_dropped", F.col("body").alias(text_col))
