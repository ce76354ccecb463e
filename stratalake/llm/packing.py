"""Numpy arrays as packed binary columns: one row per block of work instead of one per item."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext

# Compression level: the arrays are hashes and counts, on which more effort gains little.
LEVEL = 1


def pack(values: np.ndarray) -> bytes:
    """The values' bytes in planes (all first bytes, all second bytes, ...), compressed."""
    flat = np.ascontiguousarray(values)
    planes = flat.view(np.uint8).reshape(len(flat), flat.dtype.itemsize).T if len(flat) else flat
    return zstandard.compress(planes.tobytes(), LEVEL)


def unpack(packed: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def pack_bits(values: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(values).tobytes(), LEVEL)


def unpack_bits(packed: bytes, count: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.unpackbits(raw, count=count).astype(bool)


def numbered_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batches of a task with numbers that no other task gives."""
    first = TaskContext.get().partitionId() << 32
    for k, batch in enumerate(batches):
        if batch.num_rows:
            yield first + k, batch


def run_edges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]
