"""Packing token sequences into windows of one capacity by minimum bin slack.

A document's ids are cut at every multiple of the capacity; the full windows stand alone. What is
left over, shorter than a window, is dealt to bounded groups. Within a group only the multiset of
remaining lengths counts. Each window takes the longest remaining piece and then the multiset of
further lengths that comes closest to the capacity: subset sums are bits of an integer, a shift by
a length adds a piece, and walking back through the stages gives how many pieces of each length the
best sum takes. A pattern is used as often as the counts allow.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import row_chunks, staged
from recordflow.llm.encode import encoder, with_end

CAPACITY = 1024
#: Left-over pieces that are packed together: enough lengths to fill windows, small for a task.
GROUP_ROWS = 20_000
#: Bytes of text that are encoded at once; a longer text is encoded alone.
CHUNK_BYTES = 1 << 20
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, piece long"


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length fill ``room`` best, of ``counts`` pieces at most."""
    goal, reach, stages = 1 << room, 1, []
    mask = (goal << 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left > 0:
            step = min(step, left)
            stages.append((length, step, reach))
            reach |= (reach << (length * step)) & mask
            left -= step
            step *= 2
        if reach & goal:
            break
    at, taken = reach.bit_length() - 1, {}
    for length, step, before in reversed(stages):
        if not before >> at & 1:
            at -= length * step
            taken[length] = taken.get(length, 0) + step
    return taken


def plan_windows(lengths, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Windows that hold all lengths: (lengths of a window, how often it is used)."""
    counts: dict[int, int] = {}
    for length in lengths:
        counts[length] = counts.get(length, 0) + 1
    out = []
    while counts:
        first = max(counts)
        counts[first] -= 1
        taken = best_fill({k: v for k, v in counts.items() if v}, capacity - first)
        counts[first] += 1
        taken[first] = taken.get(first, 0) + 1
        times = min(counts[k] // v for k, v in taken.items())
        for k, v in taken.items():
            counts[k] -= v * times
            if not counts[k]:
                del counts[k]
        out.append(([k for k in sorted(taken, reverse=True) for _ in range(taken[k])], times))
    return out


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Encode every text, append ``end_id``, and cut: a row per piece, ``piece`` being its own number.

    A null text is empty, so its only id is the end id. Repeated rows are repeated documents.
    Only ``doc_id`` and ``text`` are read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        piece = TaskContext.get().partitionId() << 40
        for batch, data, offsets in row_chunks(batches, "text", CHUNK_BYTES):
            ids, ends = with_end(*coder.encode(data, offsets), end_id)
            ids = ids.astype("<u4")
            tokens = np.diff(ends)
            parts = -(-tokens // capacity)
            doc = np.repeat(np.arange(len(tokens)), parts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * capacity
            length = np.minimum(capacity, tokens[doc] - start)
            begin = ends[doc] + start
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(begin, length)], pa.int64()),
                    pa.array(tokens[doc]),
                    pa.array(np.arange(piece, piece + len(doc))),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece"],
            )
            piece += len(doc)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(cut, _PIECES)


def _fill_group(capacity: int):
    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "piece"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        at = {int(k): int(i) for k, i in zip(*np.unique(lengths, return_index=True))}
        window, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        n = 0
        for pattern, times in plan_windows(lengths.tolist(), capacity):
            for _ in range(times):
                used = 0
                for length in pattern:
                    i = at[length]
                    at[length] = i + 1
                    window[i], offset[i] = n, used
                    used += length
                n += 1
        # Odd ids are packed windows, even ones full pieces.
        rows["sequence_id"] = ((np.int64(key[0]) << 32) + window) * 2 + 1
        rows["offset"] = offset
        return rows.drop(columns="group")

    return fill


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Give every piece its sequence and offset; ``pieces`` must be fixed rows (a written table).

    Groups are as many as the left-over pieces need and dealt by a hash of the piece's own number,
    so no document, length or source decides how large one is.
    """
    full = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_rows))
    kinds = f"{_PIECES}, sequence_id long, offset long"
    packed = (
        rest.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(_fill_group(capacity), kinds)
    )
    alone = full.select("*", (F.col("piece") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Spans of all documents in sequences of at most ``capacity`` ids; an empty table gives no rows."""
    return pack_pieces(staged(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
