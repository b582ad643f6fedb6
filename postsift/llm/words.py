"""Words of many texts at once, as numpy arrays over the UTF-8 bytes.

A word is a run of bytes that are no separators; all separators are ASCII, so
no character is ever split. The texts of an Arrow batch lie in one buffer and
are cut and hashed together, a window at a time, which bounds the memory.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACES = bytes([0x20, *range(0x09, 0x0E)])
WINDOW = 1 << 18  # bytes hashed at a time
BATCH_ROWS = 1000  # rows of an Arrow batch of texts, where an operator writes a table itself
SLICE = 2 << 20  # bytes of text worked on at a time
FACTOR = 0x9E3779B97F4A7C15 | 1  # of the polynomial hash; odd, so that it has an inverse

# Of a join's keys, so many go to every executor (8 bytes each); more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others, one to one."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass(frozen=True)
class Runs:
    """Words of a run of texts: byte range and hash of each word, and per text
    the number of its first word (one entry more than texts)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text starts and the last ends. Null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets.astype(np.int64) - int(offsets[0])


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a part have at most ``limit`` bytes, or the part one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(upto, upto[row] + limit, "right")) - 1)
            yield batch.slice(row, end - row)
            row = end


class Words:
    """Cuts texts into words and hashes them to 64 bits."""

    def __init__(self, separators: bytes = SPACES, lower: bool = False):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        self.table = np.arange(256, dtype=np.uint8)
        if lower:
            self.table[65:91] += 32
        self.powers = np.cumprod(np.full(WINDOW, FACTOR, np.uint64), dtype=np.uint64)
        self.inverse = np.cumprod(np.full(WINDOW, pow(FACTOR, -1, 1 << 64), np.uint64), dtype=np.uint64)

    def __call__(self, texts: pa.Array, hashed: bool = True) -> Runs:
        raw, offsets = text_bytes(texts)
        data = self.table[raw]
        word = self.is_word[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], word[:-1]]) if len(word) else word
        after = np.concatenate([word[1:], [False]]) if len(word) else word
        starts = np.flatnonzero(word & (~before | edge[:-1]))
        ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        hashes = self.hashes(data, starts, ends) if hashed else np.zeros(0, np.uint64)
        return Runs(starts, ends, hashes, np.searchsorted(starts, offsets), data, offsets)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            base = int(starts[i])
            j = int(np.searchsorted(ends, base + WINDOW, "right"))
            if j <= i:  # a word longer than the window
                out[i] = xxhash.xxh3_64_intdigest(data[base : int(ends[i])].tobytes())
                i += 1
                continue
            part = data[base : int(ends[j - 1])].astype(np.uint64) + np.uint64(1)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * self.powers[: len(part)], dtype=np.uint64)])
            s, e = starts[i:j] - base, ends[i:j] - base
            out[i:j] = mixed((sums[e] - sums[s]) * self.inverse[s] + (e - s).astype(np.uint64))
            i = j
        return out


def listed(values: np.ndarray, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Within this, texts go to Python in Arrow batches of at most ``rows`` rows, which bounds what
    a task holds twice, in the JVM and in Python. The session's own setting comes back after it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _few(keys: DataFrame) -> DataFrame:
    """Marked to be broadcast if there are at most BROADCAST_KEYS, else to be shuffled."""
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return F.broadcast(keys) if few else keys.hint("merge")


def rows_with_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is among the distinct ``keys``."""
    return df.join(_few(keys), key, "left_semi")


def rows_without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not among the distinct ``keys``, or null."""
    return df.join(_few(keys), key, "left_anti")
