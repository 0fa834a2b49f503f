"""Requests from blocks of documents to shares of a global key space, and the answers back.

A block is some megabytes of documents kept together in one row of bytes. It asks for each distinct key
once; a share of the key space gathers the requests of all blocks and answers each of them in order. So
a word that stands in every document costs one entry for each block, not one for each occurrence, and
no task holds more than its share of the distinct keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from trialspark.llm.common import texts_of, text_blocks, written

#: Characters of a block.
BLOCK_CHARS = 16_000_000
#: Rows of the exchange: share -1 is the block itself.
SCHEMA = "block long, share int, kind int, a binary, b binary, c binary, d binary"
NAMES = ["block", "share", "kind", "a", "b", "c", "d"]
_TYPES = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
SELF = -1


def rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [[]] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], NAMES)


def pack_planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight stand together, so that small numbers compress well."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack_planes(blob: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys by their differences."""
    return pack_planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(blob, np.uint64), dtype=np.uint64)


def shares_for(docs: DataFrame) -> int:
    """As many shares as keep the distinct keys of each at some megabytes: they grow with the input."""
    per_task = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(per_task, 4 * docs.select("text").rdd.getNumPartitions())


def share_edges(keys: np.ndarray, shares: int) -> np.ndarray:
    """Where each share of the key space begins in ascending keys; equal ranges of hashes are equal shares."""
    bounds = np.array([(i << 64) // shares for i in range(shares)], np.uint64)
    return np.append(np.searchsorted(keys, bounds), len(keys))


def blocks(
    docs: DataFrame, build: Callable[[list, list[str]], list[tuple]], purpose: str, replayed: bool = False
) -> DataFrame:
    """Rows of ``build(ids, texts)`` for each block, written to the shared folder.

    ``build`` gives (share, kind, a, b, c, d); the number of a block is the task's and its place there.
    Where ``docs`` is a plain read of files, every reading gives the same rows in the same tasks;
    ``replayed`` then saves the copy on disk and builds the blocks as often as they are used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for ids, texts, _ in text_blocks(batches, BLOCK_CHARS):
            yield rows([(block, *row) for row in build(ids, texts)])
            block += 1

    built = texts_of(docs).mapInArrow(run, SCHEMA)
    return built if replayed else written(built, purpose)


def pack_ids(ids: list) -> bytes:
    """Document ids with their nulls."""
    values = np.array([0 if i is None else i for i in ids], np.int64)
    null = np.array([i is None for i in ids], np.int64)
    return pack_planes(np.concatenate([values, null]))


def unpack_ids(blob: bytes) -> pa.Array:
    both = unpack_planes(blob, np.int64)
    half = len(both) // 2
    return pa.array(both[:half], pa.int64(), mask=both[half:].astype(bool))
