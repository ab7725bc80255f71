"""Token counts with a cache of digests.

A text is normalised as its tokenizer does before it looks at it (the byte-level files normalise
nothing; a null text is the empty one), digested, and joined to stored counts of the same tokenizer
version. Only distinct texts that the cache lacks are encoded, and their counts are appended to it.

The words between two single blanks are encoded apart, since no token of a byte-level tokenizer
that splits before blanks spans such a blank, and a task remembers the counts of recent words. So
the text is counted whole, whatever its length, with little memory.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from snapdelta.llm.frames import text_of
from snapdelta.sinks.folders import Folders

CACHE = StructType(
    [
        StructField("content_digest", BinaryType()),
        StructField("tokenizer_digest", StringType()),
        StructField("n_tokens", LongType()),
    ]
)
#: Distinct words whose counts a task remembers; beyond it the memory is emptied.
REMEMBERED = 600_000
#: Words encoded in one call.
BATCH = 2_000


def tokenizer_version(path: str) -> str:
    """The digest of the tokenizer's file and of the library that reads it."""
    import tokenizers

    return hashlib.sha256(Path(path).read_bytes() + tokenizers.__version__.encode()).hexdigest()


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class TextCounter:
    """Counts tokens of texts, word by word, with the counts of recent words at hand."""

    def __init__(self, path: str):
        import tokenizers

        spec = json.loads(Path(path).read_text())
        cutter = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        if any(added["lstrip"] or added["rstrip"] or " " in added["content"] for added in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that reach over blanks")
        self._tokenizer = tokenizers.Tokenizer.from_file(path)
        self._known: dict[str, int] = {}

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text cut before each blank that stands between two characters that are no white space."""
        found = []
        for word in text.split(" "):
            if not found:
                found.append(word)
            elif word and not word[0].isspace() and found[-1] and not found[-1][-1].isspace():
                found.append(" " + word)
            else:
                found[-1] += " " + word
        return found

    def counts(self, texts: list[str]) -> list[int]:
        cut = [self.pieces(text) for text in texts]
        if len(self._known) > REMEMBERED:
            self._known.clear()
        known = self._known
        missing = [piece for piece in {piece for pieces in cut for piece in pieces} if piece not in known]
        for start in range(0, len(missing), BATCH):
            some = missing[start : start + BATCH]
            for piece, encoded in zip(some, self._tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                known[piece] = len(encoded.ids)
        return [sum(map(known.__getitem__, pieces)) for pieces in cut]


@lru_cache(maxsize=2)
def counter(path: str) -> TextCounter:
    return TextCounter(path)


def encode_misses(misses: DataFrame, path: str, version: str) -> DataFrame:
    """Count the tokens of each distinct text; the library runs inside the tasks."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = counter(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = count.counts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([version] * part.num_rows, pa.string()), pa.array(found, pa.int64())],
                    names=CACHE.names,
                )

    return misses.mapInArrow(encode, CACHE)


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """Stored counts of a tokenizer version, one row per digest though two jobs may have appended the same."""
    if not Folders(spark).has_data(folder):
        return spark.createDataFrame([], CACHE).select("content_digest", "n_tokens")
    stored = spark.read.schema(CACHE).parquet(folder).filter(F.col("tokenizer_digest") == version)
    return stored.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    cache: str,
    tokenizer: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: the id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    ``cache`` is a folder that all executors reach; it is made if missing and grows by the texts it
    lacked. A null text counts as the empty one (no bytes, no tokens). Repeated rows and equal texts
    each get their row; a null id is kept; an empty table gives an empty one; other columns are not read.
    Special strings inside texts are what the library makes of them; none are added.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("body")).withColumn("content_digest", content_digest(F.col("body")))
    distinct = texts.groupBy("content_digest").agg(F.first("body").alias("body"))
    if Folders(spark).has_data(cache):
        distinct = distinct.join(read_cache(spark, cache, version), "content_digest", "left_anti")
    encode_misses(distinct.select("content_digest", "body"), tokenizer, version).write.mode("append").parquet(cache)

    sizes = texts.select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), "content_digest")
    counted = sizes.join(read_cache(spark, cache, version), "content_digest")
    return counted.select(
        F.col("doc_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
