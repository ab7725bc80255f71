"""Words of texts as 64-bit numbers, for code that runs inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

WORD = re.compile(r"\w+")
#: Words that one task keeps the number of; beyond it the memory is emptied, which changes no result.
REMEMBERED = 150_000


def mixed(numbers: np.ndarray, seed: int = 0) -> np.ndarray:
    """A scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = numbers + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_hashes(texts: pa.StringArray | pa.BinaryArray) -> np.ndarray:
    """A 64-bit hash of each text of an Arrow array: a sum over its bytes, each scrambled with its place."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    offsets -= offsets[0]
    lengths = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(data + (place.astype(np.uint64) << np.uint64(8))))])
    return mixed(running[offsets[1:]] - running[offsets[:-1]] + lengths.astype(np.uint64))


def word_hashes(words: list[str]) -> np.ndarray:
    """The hash of each word; each different one is hashed once, and none is remembered."""
    coded = pa.array(words, pa.string()).dictionary_encode()
    return text_hashes(coded.dictionary)[coded.indices.to_numpy()] if words else np.zeros(0, np.uint64)


def shingles(numbers: np.ndarray, width: int) -> np.ndarray:
    """A number for each run of ``width`` words; a shorter text is one shingle of all its words."""
    if not len(numbers):
        return numbers
    width = min(width, len(numbers))
    total = np.zeros(len(numbers) - width + 1, np.uint64)
    for at in range(width):
        total = mixed(total + numbers[at : at + len(total)])
    return total


def chunks(texts: Iterable[str], most: int) -> Iterable[list[str]]:
    """Consecutive texts, in lists of about ``most`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held
