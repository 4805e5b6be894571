"""Helpers shared by the text operators: Arrow batches, word and window hashes, row tables."""
from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlab.session import checkpoint_dir, ship

#: A broadcast from these operators never passes this many bytes; beyond it a shuffle join is used.
BROADCAST_BYTES = 64 << 20
WORD_CACHE = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package made importable on the executors.  Python workers outlive their
    tasks: what a task has freed goes back to the system at its end, or idle workers would hold it."""
    ship(df.sparkSession)

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory of this process to the system (where the C library can)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def reliable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder; executors may be lost afterwards."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a materialised ``df`` for broadcast only if its counted size is within ``limit``."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def values(column: pa.Array):
    """UTF-8 bytes of each value of a string column; None for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    valid = column.is_valid().to_pylist() if column.null_count else None
    for i in range(len(column)):
        yield None if valid is not None and not valid[i] else bytes(view[at[i]:at[i + 1]])


class WordHashes(dict):
    """64-bit hash of each word, kept for the words seen lately (bounded)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix: spreads every bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(h: np.ndarray, k: int, salt: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (none if there are fewer).

    Doubling: the hash of a run of 2j words is made of the hashes of its halves, so a
    run of 50 words costs six vector operations, not fifty.
    """
    if len(h) < k:
        return h[:0]
    m, have, out, span = np.uint64(salt | 1), mixed(h + np.uint64(salt & (2**63 - 1))), None, 0
    size = 1
    while True:
        if k & size:
            n = len(h) - (span + size) + 1
            out = have[:n].copy() if out is None else mixed(out[:n] * m + have[span:span + n])
            span += size
        if size * 2 > k:
            return out
        n = len(have) - size
        have = mixed(have[:n] * m + have[size:size + n])
        size *= 2


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column from numpy arrays."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))
