"""Rows under numbers of their own, and their texts a few at a time, for operators that come back to a row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from snapdelta.llm.frames import stored, text_of


def numbered(docs: DataFrame, id_col: str, text_col: str, label: str) -> DataFrame:
    """(row, id, body) of each row, written once, so that every later pass sees a row under the same number."""
    chosen = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("body"))
    return stored(chosen.select(F.monotonically_increasing_id().alias("row"), "id", "body"), label)


def text_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of an Arrow column as strings, lists of about ``most`` bytes, each with the place of its
    first text: a batch of long texts is never turned into strings at once. A text beyond ``most`` is a list alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        below = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, below + most, "right")))
        yield at, texts.slice(at, to - at).to_pylist()
        at = to
