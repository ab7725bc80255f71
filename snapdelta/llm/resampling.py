"""A quality classifier by importance resampling.

Two generative models of hashed n-grams (words, word pairs, and the first letters of words): one of target text (labelled as good and not
toxic), one of all raw text. A document's log weight is the sum of the log ratios of its n-grams over
the cutoff, and the documents are drawn without replacement by the Gumbel top-k rule: the k greatest
sums of log weight and seeded standard Gumbel noise stay.

The target model is fitted on a bounded sample of labelled rows (``SAMPLE``); the raw model counts
every document. The other half of the sample sets the cutoff, the mean log ratio that parts its good
rows from its bad ones, and with it k: the number of documents whose mean is not below it. The noise
is worth one n-gram or two of evidence: it draws among documents near the cutoff, mostly short
ones, and a text of many words that are plainly good or bad stays or goes whatever its noise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from snapdelta.llm.frames import kept
from snapdelta.llm.histogram import find_cuts
from snapdelta.llm.rows import text_slices
from snapdelta.llm.words import mixed, text_hashes

#: Labelled rows used at most, the ones with the smallest hash of their id; half fit, half set the cutoff.
SAMPLE = 20_000
#: Families of n-grams: words, word pairs, first letters of words. Each n-gram has a bucket in each of two
#: hash tables of its family; of their two ratios the one nearer to none counts, so that a rare
#: n-gram does not take over the ratio of a frequent one that shares a bucket with it.
FAMILIES = 3
BUCKETS = 1 << 16
TABLES = 2 * FAMILIES
#: Letters of a word's start, which inflected forms of a stem share.
START = 4
#: Counts added to both sides of a ratio: buckets with less evidence weigh little.
PRIOR = 5.0
#: A ratio counts if it is this far from none, in standard deviations and as a log; the rest is noise.
SURE = 6.0
LEAST_RATIO = 0.7
#: Log weights are divided by this before the noise is added; 1 draws in proportion to the weights.
TEMPERATURE = 1.0
TOKEN = re.compile(r"\w+|[^\w\s]+")
SAME = np.uint64(1)
FIT_GOOD, CUT_GOOD, CUT_BAD = 1, 2, 3


class Features:
    """Bucket numbers of the n-grams of texts. A word that repeats the one before is a mark of its own."""

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The two buckets of each n-gram of the texts (two rows), and the position of its text."""
        split = [TOKEN.findall(text.lower()) for text in texts]
        lengths = np.array([len(words) for words in split], np.int64)
        owner = np.repeat(np.arange(len(texts)), lengths)
        if not len(owner):
            return np.zeros((2, 0), np.int64), owner
        # each different word is hashed once
        coded = pa.array([word for words in split for word in words], pa.string()).dictionary_encode()
        at = coded.indices.to_numpy()
        numbers = text_hashes(coded.dictionary)
        starts = mixed(text_hashes(pc.utf8_slice_codeunits(coded.dictionary, 0, START)), 13)
        follows = owner[1:] == owner[:-1]
        marked = numbers[at]
        marked[1:][follows & (at[1:] == at[:-1])] = SAME
        pairs = mixed(mixed(marked[:-1], 7) + marked[1:], 11)[follows]
        count = len(marked)
        rows = np.empty((2, 2 * count + len(pairs)), np.int64)
        for table, shift in enumerate((0, 32)):
            rows[table, :count] = _buckets(marked, shift, table)
            rows[table, count:-count] = _buckets(pairs, shift, 2 + table)
            rows[table, -count:] = _buckets(starts, shift, 4 + table)[at]
        return rows, np.concatenate([owner, owner[1:][follows], owner])


def _buckets(hashes: np.ndarray, shift: int, table: int) -> np.ndarray:
    return ((hashes >> np.uint64(shift)) & np.uint64(BUCKETS - 1)).astype(np.int64) + table * BUCKETS


#: Bytes of text that a task turns into strings at once.
AT_ONCE = 500_000


def _texts(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """A few texts at a time, with the place of the first; a null is the empty text."""
    for at, some in text_slices(texts, AT_ONCE):
        yield at, [text or "" for text in some]


@dataclass
class ResamplingModel:
    """Log ratios by bucket, the key from which on a document stays, and how k came about."""

    ratios: np.ndarray
    seed: int
    cutoff: float = float("-inf")
    k: int | None = None
    least_key: float = float("-inf")

    def means(self, features: Features, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The mean log ratio of each text's n-grams, and how many it has."""
        means, counts = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for at, some in _texts(texts):
            buckets, owner = features.of(some)
            first, second = self.ratios[buckets]
            ratio = np.where(first * second > 0, np.where(np.abs(first) < np.abs(second), first, second), 0.0)
            total = np.bincount(owner, ratio, len(some))
            count = np.bincount(owner, minlength=len(some))
            means[at : at + len(some)] = total / np.maximum(count, 1)
            counts[at : at + len(some)] = count
        return means, counts

    def log_weights(self, means: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The log ratio of whole texts, summed over their n-grams, over the cutoff."""
        return counts * (means - (self.cutoff if np.isfinite(self.cutoff) else 0.0))

    def keys(self, ids: list, log_weights: np.ndarray) -> np.ndarray:
        """Log weight plus Gumbel noise that the id and the seed decide; a null id has noise of its own."""
        draws = np.array([xxhash.xxh64_intdigest(str(i), self.seed) for i in ids], np.float64)
        uniform = (draws + 0.5) / 2.0**64
        return log_weights / TEMPERATURE - np.log(-np.log(np.clip(uniform, 1e-15, 1 - 1e-15)))


def labelled_sample(labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most ``most`` labelled documents: those whose ids hash lowest. Of several labels the worst counts."""
    named = labels.select(F.col("doc_id").alias("label_id"), "quality", "toxic").dropna()
    worst = named.groupBy("label_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    chosen = worst.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    fits = F.xxhash64(F.lit("half"), "label_id") % 2 == 0
    part = F.when(good & fits, FIT_GOOD).when(good, CUT_GOOD).otherwise(CUT_BAD)
    return chosen.select("label_id", part.alias("part"))


def _counts(marked: DataFrame) -> np.ndarray:
    """Counts of the raw model and of the target model by bucket; a task sends one row per bucket it saw."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        totals = np.zeros((2, TABLES * BUCKETS), np.int64)
        for batch in batches:
            fits = np.array([part == FIT_GOOD for part in batch.column("part").to_pylist()], bool)
            for at, some in _texts(batch.column("body")):
                buckets, owner = features.of(some)
                totals[0] += np.bincount(buckets.ravel(), minlength=TABLES * BUCKETS)
                totals[1] += np.bincount(buckets[:, fits[at + owner]].ravel(), minlength=TABLES * BUCKETS)
        seen = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(totals[0][seen]), pa.array(totals[1][seen])], names=["bucket", "raw", "target"]
        )

    found = marked.mapInArrow(count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    totals = np.zeros((2, TABLES * BUCKETS))
    for batch in found.toArrow().to_batches():  # one row per bucket at most
        at = batch.column("bucket").to_numpy()
        totals[0][at] = batch.column("raw").to_numpy()
        totals[1][at] = batch.column("target").to_numpy()
    return totals


def log_ratios(totals: np.ndarray) -> np.ndarray:
    """Log of what the target holds over what the raw text leads one to expect, each table by itself."""
    found = np.zeros(TABLES * BUCKETS)
    for table in range(TABLES):
        raw, target = totals[:, table * BUCKETS : (table + 1) * BUCKETS]
        if raw.sum() and target.sum():
            expected = raw * (target.sum() / raw.sum())
            ratio = np.log((target + PRIOR) / (expected + PRIOR))
            sure = (np.abs(target - expected) >= SURE * np.sqrt(expected + 1)) & (np.abs(ratio) >= LEAST_RATIO)
            found[table * BUCKETS : (table + 1) * BUCKETS] = np.where(sure, ratio, 0.0)
    return found


def best_cutoff(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight that parts the two with the fewest errors, each side counted by its share; halfway into the gap."""
    if not len(good) or not len(bad):
        return float("-inf")
    values = np.concatenate([good, bad])
    order = np.argsort(values, kind="stable")
    is_good = np.concatenate([np.ones(len(good)), np.zeros(len(bad))])[order]
    # cutting before position i rejects the first i values
    errors = np.concatenate([[0], np.cumsum(is_good / len(good))]) + np.concatenate([[len(bad)], len(bad) - np.cumsum(1 - is_good)]) / len(bad)
    ranked = values[order]
    ranked = np.concatenate([[ranked[0] - 1], ranked, [ranked[-1] + 1]])
    least = np.flatnonzero(errors <= errors.min() + 1e-12)
    at = least[len(least) // 2]
    return float((ranked[at] + ranked[at + 1]) / 2)


def descending(keys: np.ndarray) -> list[str]:
    """Hexadecimal texts that sort as the keys do from the greatest to the least."""
    bits = np.ascontiguousarray(keys, np.float64).view(np.uint64)
    rising = np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))
    return [f"{number:016x}" for number in (~rising).tolist()]


def _scored(rows: DataFrame, model: ResamplingModel) -> DataFrame:
    """id, part, mean log ratio and number of n-grams of each row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            means, counts = model.means(features, batch.column("body"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("part"), pa.array(means), pa.array(counts)], names=["id", "part", "mean", "n_grams"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, part int, mean double, n_grams long")


def _drawn(scored: DataFrame, model: ResamplingModel) -> DataFrame:
    """id, log_weight, gumbel_key, key (text that sorts from the greatest) of each scored row."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = model.log_weights(batch.column("mean").to_numpy(), batch.column("n_grams").to_numpy())
            keys = model.keys(batch.column("id").to_pylist(), weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(weights), pa.array(keys), pa.array(descending(keys), pa.string())],
                names=["id", "log_weight", "gumbel_key", "key"],
            )

    kind = scored.schema["id"].dataType.simpleString()
    return scored.select("id", "mean", "n_grams").mapInArrow(draw, f"id {kind}, log_weight double, gumbel_key double, key string")


def fit(
    docs: DataFrame, labels: DataFrame, seed: int = 1, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[ResamplingModel, DataFrame]:
    """The fitted model, its k and least key set, and the stored keys of all rows of ``docs``."""
    sampled = labelled_sample(labels, sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    # at most `sample` rows of two numbers
    marked = texts.join(F.broadcast(sampled), F.col("id") == F.col("label_id"), "left").select("id", "body", "part")
    model = ResamplingModel(log_ratios(_counts(marked)), seed)
    scored = kept(_scored(marked, model))
    tried = scored.filter(F.col("part") > FIT_GOOD).select("id", "part", "mean").dropDuplicates(["id", "mean"]).toPandas()
    good, bad = (tried["mean"][tried.part == part].to_numpy() for part in (CUT_GOOD, CUT_BAD))
    model.cutoff = best_cutoff(good, bad)
    model.k = scored.filter(F.col("mean") >= model.cutoff).count()
    drawn = kept(_drawn(scored, model))
    if model.k:
        keys = drawn.select(F.lit(0).alias("group"), "key", F.lit(1).cast("long").alias("weight"))
        cut = find_cuts(keys, [(0, model.k)], digits=3)[0, model.k]
        bits = ~int(cut.key, 16) & (2**64 - 1)
        bits = bits & (2**63 - 1) if bits >> 63 else ~bits & (2**64 - 1)
        model.least_key = float(np.array([bits], np.uint64).view(np.float64)[0])
    else:
        model.least_key = float("inf")
    return model, drawn


def classify(docs: DataFrame, labels: DataFrame, seed: int = 1, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, log_weight, gumbel_key and kept.

    A null text is the empty one and weighs 0, so noise alone draws it. Equal rows get equal keys, so ties stay or go together.
    Labels with a null in them are not used; without good or without bad labels there is nothing to
    part, and all rows stay. An empty table gives an empty one; other columns are not read.
    """
    model, drawn = fit(docs, labels, seed, sample, id_col, text_col)
    return drawn.select(F.col("id").alias(id_col), "log_weight", "gumbel_key", (F.col("gumbel_key") >= model.least_key).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, seed: int = 1, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``classify`` keeps, with all their columns. Rows are scored where they lie; none is shuffled."""
    model, _ = fit(docs, labels, seed, sample, id_col, text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            weights = model.log_weights(*model.means(features, batch.column(text_col)))
            good = model.keys(batch.column(id_col).to_pylist(), weights) >= model.least_key
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
