"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.session import scratch_path

#: Bytes of text that a Python task works on at once.
CHUNK_BYTES = 4 << 20

#: What separates words in every contract of these operators: space and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: fixed rows, no lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array (null: empty), and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def row_chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple]:
    """Batches cut to about ``limit`` bytes of text: (batch, bytes, offsets). No row is cut."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path in it."""
    if urlparse(uri).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, parts) -> None:
    """Write byte strings under a name of its own attempt, then rename: no half file is ever seen."""
    system, path = filesystem(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    own = f"{path}.{os.urandom(6).hex()}"
    with system.open_output_stream(own, compression=None) as out:
        for part in parts:
            out.write(part)
    system.move(own, path)


def read_array(uri: str, dtype) -> np.ndarray:
    """A flat binary file as an array; memory-mapped where the folder is mounted."""
    system, path = filesystem(uri)
    if isinstance(system, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype=dtype)
