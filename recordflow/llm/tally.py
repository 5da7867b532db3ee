"""Words of many texts as spans of bytes, and exact counts of 64-bit keys over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.wordhash import mix

#: Keys that a task holds before it sends them on, and before a merge combines them.
HELD = 1 << 20
#: Bytes of text whose keys meet in one merging task.
MERGED_BYTES = 24 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def byte_set(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words between gap bytes begin and end, and the row of each. No word reaches over rows."""
    inside = ~gap[data]
    head = np.zeros(len(data) + 1, bool)
    head[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | head[1:-1]
    last[:-1] &= ~inside[1:] | head[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    powers = np.full(int(size.max()), _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    at = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(at, size)
    value = (data[np.repeat(starts, size) + place].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mix(np.add.reduceat(value, at))


def span_strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of each span as a string."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[index])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), buffers).cast(pa.string())


def combined(keys: np.ndarray, counts: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their sums and a tag."""
    if not len(keys):
        return keys, counts, tags
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts[order], at), tags[order[at]]


class Held:
    """Counts of keys, combined when many have come together."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.size = 0
        self.floor = 0

    def add(self, keys: np.ndarray, counts: np.ndarray, tags: np.ndarray | None = None) -> None:
        tags = np.zeros(len(keys), np.uint8) if tags is None else tags
        self.parts.append((keys, counts.astype(np.int64), tags))
        self.size += len(keys)
        if self.size > 2 * max(HELD, self.floor):
            self.take(keep=True)

    def take(self, keep: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = self.parts or [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8))]
        out = combined(*(np.concatenate(x) for x in zip(*parts)))
        self.parts, self.floor = ([out], len(out[0])) if keep else ([], 0)
        self.size = self.floor
        return out


def _send(keys_of: Callable, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held()

        def out() -> pa.RecordBatch:
            keys, counts, tags = held.take()
            bucket = (keys % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            some = np.flatnonzero(ends[:-1] < ends[1:])
            blobs = []
            for b in some:
                own = order[ends[b] : ends[b + 1]]
                blobs.append(keys[own].tobytes() + counts[own].astype("<u4").tobytes() + tags[own].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "blob"])

        for keys, counts, tags in keys_of(batches):
            held.add(keys, counts, tags)
            if held.size >= HELD:
                yield out()
        if held.size:
            yield out()

    return run


def _merge(finish: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held()
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                n = len(blob) // 13
                held.add(
                    np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, "<u4", n, 8 * n), np.frombuffer(blob, np.uint8, n, 12 * n)
                )
        keys, counts, tags = held.take()
        if len(keys):
            yield from finish(keys, counts, tags)

    return run


def key_counts(texts: DataFrame, n_bytes: int, keys_of: Callable, finish: Callable, kinds: str) -> DataFrame:
    """Counts of the keys that ``keys_of`` finds in batches of ``texts``.

    ``keys_of(batches)`` yields (keys, counts, tags), with counts below 2**32; ``finish(keys, counts, tags)``
    yields batches of ``kinds`` for all keys of some buckets, each with its whole count. A key is one entry
    of a blob for each million of keys of a task, however often it occurs. The number of merging tasks
    follows ``n_bytes``, the bytes of text.
    """
    parts = max(1, -(-n_bytes // MERGED_BYTES))
    buckets = max(256, 4 * parts)
    blobs = texts.mapInArrow(_send(keys_of, buckets), "bucket int, blob binary")
    parts = max(parts, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return blobs.repartition(parts, "bucket").mapInArrow(_merge(finish), kinds)


def text_bytes_of(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
