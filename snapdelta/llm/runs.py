"""Periodic runs of words, found by block convolution.

A run is a stretch that repeats with a period. For each dyadic scale the words of a text are cut into
blocks at a fixed stride; the first period of any run of that scale holds a whole block, and the block
comes back one period later. Where a block comes back is read off the squared differences between the
block and all places of the following window,

    sum (x[i] - y[d + i])^2 = sum x^2 + sum y^2 - 2 sum x y,

whose last term is a correlation of whole numbers, taken with a number-theoretic transform modulo 65537.
A distance without mismatch has a zero there (one zero in 65537 others is by chance and is refused by a look
at the words). Each distance is a seed that is extended to both sides as long as words a period apart agree.
Distances below the least scale are compared directly. The work grows with n log n words (and beyond
windows of 65536 words with n^2 / 10^9), the memory with the longest text and a fixed number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapdelta.llm.frames import text_of
from snapdelta.llm.rows import text_slices

LEAST_LENGTH = 12
#: The prime of the transform and a generator of its units: it has roots of unity of all orders to 65536.
PRIME, GENERATOR = 65537, 3
#: Windows of the transforms, in words. A block is a sixteenth of its window, the stride three quarters.
LEAST_WINDOW, MOST_WINDOW = 64, 65536
#: Numbers that the transforms of a task hold at once.
CELLS = 1 << 18
#: Bytes of text that a task looks at together.
AT_ONCE = 1_000_000


def _least_distance(window: int) -> int:
    """Any stretch of this many words holds a whole block of the scale."""
    return window * 3 // 4 + window // 16 - 1


@cache
def _powers(order: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // order, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    found = np.ones(order, np.int64)
    for at in range(1, order):
        found[at] = found[at - 1] * root % PRIME
    return found


@cache
def _table(order: int, rows: int, columns: int, inverse: bool) -> np.ndarray:
    """The root of an order to the power of row times column."""
    return _powers(order, inverse)[np.outer(np.arange(rows), np.arange(columns)) % order].astype(np.float64)


def _reduced(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers, held as doubles, modulo the prime; a rounded quotient may leave them one prime off."""
    numbers -= np.floor(numbers * (1.0 / PRIME)) * PRIME
    return numbers


def transformed(numbers: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of each row (an inverse one is not yet divided by the length).

    A longer row is laid out as rows times columns, transformed along its columns, twisted and transformed along
    its rows, all as products of matrices: no sum passes 256 x 65537^2, so doubles hold it exactly.
    """
    count, length = numbers.shape
    if length <= 128:
        return _reduced(numbers @ _table(length, length, length, inverse))
    rows = 1 << (length.bit_length() // 2)
    columns = length // rows
    stepped = _reduced(np.matmul(_table(rows, rows, rows, inverse), numbers.reshape(count, rows, columns)))
    stepped *= _table(length, rows, columns, inverse)
    stepped = _reduced(np.matmul(_reduced(stepped), _table(columns, columns, columns, inverse)))
    # entry (r, c) is coefficient c * rows + r
    return np.ascontiguousarray(stepped.transpose(0, 2, 1)).reshape(count, length)


def correlated(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """sum blocks[i] * windows[d + i] modulo the prime, for each row and each distance of the window (cyclic)."""
    length = windows.shape[1]
    padded = np.zeros(windows.shape)
    padded[:, 0] = blocks[:, 0]
    # turned around, so that the product of transforms correlates
    padded[:, length - blocks.shape[1] + 1 :] = blocks[:, :0:-1]
    product = _reduced(transformed(padded) * transformed(windows.astype(np.float64)))
    found = transformed(product, inverse=True) * pow(length, -1, PRIME)
    return _reduced(found).astype(np.int64)


class _Found:
    """The runs of some texts that lie end to end, by place."""

    def __init__(self, words: np.ndarray, least_length: int):
        self.words = words
        self.least = least_length
        self.runs: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period

    def add(self, start: int, end: int, period: int) -> None:
        # ascending periods: a stretch that is known has a smaller one
        if end - start >= 2 * period:
            self.runs.setdefault((start, end), period)

    def short_periods(self, most: int) -> None:
        words = self.words
        for period in range(1, min(most, len(words) // 2) + 1):
            same = np.flatnonzero(words[period:] != words[:-period])
            edges = np.concatenate([[-1], same, [len(words) - period]])
            for at in np.flatnonzero(np.diff(edges) > max(period, self.least - period)):
                self.add(int(edges[at]) + 1, int(edges[at + 1]) + period, period)

    def extend(self, place: np.ndarray, distance: np.ndarray) -> None:
        """Follow seeds (a word and how far on it comes back), in order of distance and place."""
        known: tuple[int, int, int] = (-1, -1, -1)
        for at, period in zip(place.tolist(), distance.tolist(), strict=True):
            if known[0] == period and known[1] <= at < known[2]:
                continue
            end = at + self._agreeing(at, period, 1)
            start = at + 1 - self._agreeing(at, period, -1)
            known = (period, start, end)
            if end - start >= period:
                self.add(start, end + period, period)

    def _agreeing(self, at: int, period: int, step: int) -> int:
        """How many words from ``at`` on (or back) agree with those a period further on."""
        words, count, size = self.words, 0, 64
        while True:
            if step > 0:
                low, high = at + count, min(at + count + size, len(words) - period)
            else:
                low, high = max(0, at + 1 - count - size), at + 1 - count
            if low >= high:
                return count
            differ = np.flatnonzero(words[low:high] != words[low + period : high + period])
            if len(differ):
                return count + int(differ[0] if step > 0 else high - low - 1 - differ[-1])
            count += high - low
            size *= 2


def _seeds(coded: np.ndarray, squares: np.ndarray, starts: np.ndarray, first: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of the places where a block may come back, ``first`` words on and further."""
    size = window // 16
    lags = window - size + 1
    blocks = coded[starts[:, None] + np.arange(size)]
    windows = coded[(starts + first)[:, None] + np.arange(window)]
    own = (blocks * blocks % PRIME).sum(axis=1)
    there = starts[:, None] + first + np.arange(lags)
    others = squares[there + size] - squares[there]
    differences = (own[:, None] + others - 2 * correlated(blocks, windows)[:, :lags]) % PRIME
    which, lag = np.nonzero(differences == 0)
    return starts[which], lag + first


def _hopeful(words: np.ndarray, place: np.ndarray, distance: np.ndarray, size: int) -> np.ndarray:
    """Which seeds may grow to a run: the block does come back, and so does the text on one side of it, as far as a
    period's other words reach (looked at in a few places)."""
    good = np.ones(len(place), bool)
    for at in range(size):
        some = np.flatnonzero(good)
        good[some] = words[place[some] + at] == words[place[some] + at + distance[some]]
    some = np.flatnonzero(good)
    place, distance = place[some], distance[some]
    left, right = np.ones(len(some), bool), np.ones(len(some), bool)
    for nth in range(1, 9):
        away = (distance - size) // 2 * nth // 8
        before, after = np.maximum(place - away, 0), np.minimum(place + size - 1 + away, len(words) - 1 - distance)
        left &= (words[before] == words[before + distance]) & (place >= away)
        right &= (words[after] == words[after + distance]) & (place + size - 1 + away < len(words) - distance)
    good[some] = left | right
    return good


def runs_of(texts: list[list[bytes]], least_length: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, by start, then period.

    A run is a stretch of words with smallest period q, at least ``least_length`` and 2 q long, that cannot be
    made longer on either side with words q apart still equal.
    """
    numbers: dict[bytes, int] = {}
    lengths = np.array([len(words) for words in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    words = np.zeros(begins[-1], np.int64)
    for nth, own in enumerate(texts):
        words[begins[nth] : begins[nth] + len(own)] = [numbers.setdefault(word, len(numbers)) for word in own]
    # a word of its own ends each text, so that no run crosses it
    words[begins[1:] - 1] = len(numbers) + np.arange(len(texts))
    found = _Found(words, least_length)
    found.short_periods(_least_distance(LEAST_WINDOW) - 1)
    window = LEAST_WINDOW
    first = _least_distance(window)
    longest = int(lengths.max(initial=0))
    if longest >= 2 * first:
        # words as numbers scattered over the prime
        coded = np.concatenate([(words * 40503 + 1) % PRIME, np.zeros(min(MOST_WINDOW, longest) + 1, np.int64)])
        squares = np.concatenate([[0], np.cumsum(coded * coded % PRIME)])
    while longest >= 2 * first:
        size, stride = window // 16, window * 3 // 4
        following = first + window - size + 1
        if window < MOST_WINDOW:
            following = min(following, _least_distance(2 * window))
        long = np.flatnonzero(lengths >= 2 * first)
        starts = [np.arange(begins[nth], begins[nth] + lengths[nth] - first - size + 1, stride) for nth in long]
        limits = np.repeat(begins[long] + lengths[long], [len(own) for own in starts])
        starts = np.concatenate(starts)
        places, distances = [], []
        step = max(1, CELLS // window)
        for low in range(0, len(starts), step):
            place, distance = _seeds(coded, squares, starts[low : low + step], first, window)
            end = limits[low + np.searchsorted(starts[low : low + step], place)]
            inside = (distance < following) & (place + distance + size <= end)
            places.append(place[inside])
            distances.append(distance[inside])
        place, distance = np.concatenate(places), np.concatenate(distances)
        place, distance = _unknown(found, place, distance, size)
        good = _hopeful(words, place, distance, size)
        order = np.lexsort((place[good], distance[good]))
        found.extend(place[good][order], distance[good][order])
        first = following
        window = min(2 * window, MOST_WINDOW)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owner = np.searchsorted(begins, [start for start, _ in found.runs], "right") - 1
    for (start, end), period, nth in zip(found.runs, found.runs.values(), owner.tolist(), strict=True):
        if end - start >= least_length:
            out[nth].append((start - int(begins[nth]), end - start, period))
    return [sorted(own, key=lambda run: (run[0], run[2])) for own in out]


def _unknown(found: _Found, place: np.ndarray, distance: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds without those that lie in a known run and are a multiple of its period: they give the same run again."""
    if not len(place):
        return place, distance
    order = np.argsort(place, kind="stable")
    place, distance = place[order], distance[order]
    stays = np.ones(len(place), bool)
    shortest = int(distance.min()) + size
    for (start, end), period in found.runs.items():
        if end - start >= shortest:
            low, high = np.searchsorted(place, [start, end])
            own = slice(low, high)
            stays[own] &= (distance[own] % period != 0) | (place[own] + distance[own] + size > end)
    return place[stays], distance[stays]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by single spaces: of each run its first period stays."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    stays = np.cumsum(gone[:-1]) == 0
    return b" ".join(word for word, stay in zip(words, stays.tolist(), strict=True) if stay)


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def find_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed) of each row of ``docs``: all runs of its words as start, length and period (in words, by
    start, then period), and the words left when each run is cut to its first period, joined by single spaces.

    Words are what lies between blanks (space, tab, line feed, vertical tab, form feed, carriage return). A null text
    is the empty one, which has no words, no runs and an empty ``collapsed``. Rows are looked at one by one, so
    repeated rows and null ids fare like others; an empty table gives an empty one; other columns are not read.
    """
    id_type = docs.select(F.col(id_col).alias("id")).schema["id"].dataType

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for at, texts in text_slices(batch.column("body"), AT_ONCE):
                split = [text.encode().split() for text in texts]
                runs = runs_of(split, least_length)
                left = [collapsed(words, own).decode() for words, own in zip(split, runs, strict=True)]
                named = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
                ids = batch.column("id").slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(named, run_type), pa.array(left, pa.string())], names=["id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("body"))
    found = rows.mapInArrow(look, f"id {id_type.simpleString()}, runs array<{RUN}>, collapsed string")
    return found.select(F.col("id").alias(id_col), "runs", "collapsed")
