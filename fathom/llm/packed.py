"""Exchanging millions of small records as few rows: each row holds the records of one bucket as packed columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Records that a task gathers before it packs them; bounds its memory.
GATHERED = 600_000


def bucket_count(total_bytes: int, bytes_each: int = 4 << 20) -> int:
    """Buckets for an input of so many bytes: enough that a bucket's records fit into a task's memory, at any size."""
    return max(256, -(-total_bytes // bytes_each))


def total_bytes(df: DataFrame, column: str) -> int:
    return int(df.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0)


def pack(kind: int, bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (kind, bucket, c0, c1, ...) with the columns of each bucket's records as bytes, in the given order."""
    small = bucket.astype(np.uint16) if len(bucket) and 0 <= bucket.min() and bucket.max() < 1 << 16 else bucket  # these are sorted by radix
    order = slice(None) if (bucket[1:] >= bucket[:-1]).all() else np.argsort(small, kind="stable")
    sorted_bucket = bucket[order]
    edges = np.flatnonzero(np.diff(sorted_bucket)) + 1
    starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(bucket)]))
    if not len(bucket):
        starts = ends = np.zeros(0, np.int64)
    arrays = [pa.array(np.full(len(starts), kind, np.int32)), pa.array(sorted_bucket[starts].astype(np.int32) if len(bucket) else np.zeros(0, np.int32))]
    for c in columns:
        raw = np.ascontiguousarray(c[order])
        width = raw.dtype.itemsize
        offsets = np.concatenate((starts, [len(bucket)])).astype(np.int32) * width if len(bucket) else np.zeros(1, np.int32)
        arrays.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw.view(np.uint8).reshape(-1))]))
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "bucket", *(f"c{i}" for i in range(len(columns)))])


def unpack(batch: pa.RecordBatch, kinds: dict[int, list]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The records of each row as (kind, columns); kinds gives the dtypes of each kind's columns."""
    kind = batch.column(0).to_pylist()
    for i, k in enumerate(kind):
        yield k, [np.frombuffer(batch.column(2 + j)[i].as_py(), t) for j, t in enumerate(kinds[k])]


def bucketed_by(batches: Iterator[pa.RecordBatch], kinds: dict[int, list]) -> Iterator[tuple[int, dict[int, list[list[np.ndarray]]]]]:
    """Each bucket with its records by kind, from packed rows in the order of buckets; only one bucket is held at a time."""
    current, held = -1, {}
    for batch in batches:
        for bucket, (kind, columns) in zip(batch.column(1).to_pylist(), unpack(batch, kinds), strict=True):
            if bucket != current:
                if held:
                    yield current, held
                current, held = bucket, {}
            held.setdefault(kind, []).append(columns)
    if held:
        yield current, held


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal neighbours, and the run of each position."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1
