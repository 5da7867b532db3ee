"""Token-id files: flat unsigned integers with 64-bit document offsets.

A shard holds the documents of one range of ``doc_id``, ascending:

* ``shard-*.ids``: the ids of all its documents, one after the other, as little-endian unsigned
  integers (16 bits when the vocabulary allows it, else 32),
* ``shard-*.offsets``: documents + 1 little-endian signed 64-bit offsets into the ids, counted in ids,
* ``shard-*.docs``: the ``doc_id`` of each document as a signed 64-bit integer, and ``shard-*.nulls``
  with a byte of 1 for each document without an id.

The manifest (Parquet) has a row per shard: its number, files, counts and ``base``, the ids of all
shards before it. Bases are prefix sums over the manifest, so ``base + offset`` is a document's
place in the whole corpus and every file can be memory-mapped as it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordflow.llm.common import filesystem, read_array, row_chunks, staged, write_file
from recordflow.llm.encode import encoder, with_end
from recordflow.session import scratch_path

ENCODE_BYTES = 8 << 20
_MANIFEST = "shard long, file string, n_docs long, n_tokens long, dtype string"


def _write_shard(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        dtype = np.dtype("<u2" if max(coder.vocabulary - 1, end_id) < 1 << 16 else "<u4")
        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:08d}"
        ids, nulls, sizes = [], [], []

        def parts():
            for batch, data, offsets in row_chunks(batches, "text", ENCODE_BYTES):
                coded, ends = with_end(*coder.encode(data, offsets), end_id)
                column = batch.column("doc_id")
                nulls.append(np.asarray(column.is_null(), dtype=np.uint8))
                ids.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                sizes.append(np.diff(ends))
                yield coded.astype(dtype).tobytes()

        write_file(f"{name}.ids", parts())
        if not sizes:
            return
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype("<i8")
        write_file(f"{name}.offsets", [offsets.tobytes()])
        write_file(f"{name}.docs", [np.concatenate(ids).tobytes()])
        write_file(f"{name}.nulls", [np.concatenate(nulls).tobytes()])
        yield pa.RecordBatch.from_pydict(
            {
                "shard": [shard],
                "file": [name],
                "n_docs": [len(offsets) - 1],
                "n_tokens": [int(offsets[-1])],
                "dtype": [dtype.str],
            }
        )

    return write


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode every text and write the shards; returns the manifest with ``base``.

    Documents go to shards by ranges of ``doc_id`` (null first), equal ids by a hash of the text,
    so that one id with very many rows is split. A null or empty text is the end id alone. Repeated
    rows are written as often as they occur. An empty table gives an empty manifest. Only ``doc_id``
    and ``text`` are read, so other columns cannot clash. A task that runs again replaces its files.
    """
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = staged(ranged.mapInArrow(_write_shard(folder, tokenizer, end_id), _MANIFEST), "manifest")
    # One row per shard: the running sum is small whatever the corpus.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read_token_files(manifest: DataFrame, block: int = 4096) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, shard.

    ``start`` counts the ids of all documents before it in the corpus; the checksum is over the
    ids as little-endian unsigned 32-bit integers, read through a memory map.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = read_array(f"{row['file']}.ids", row["dtype"])
                offsets = read_array(f"{row['file']}.offsets", "<i8")
                docs = read_array(f"{row['file']}.docs", "<i8")
                nulls = read_array(f"{row['file']}.nulls", "u1")
                for low in range(0, row["n_docs"], block):
                    ends = np.asarray(offsets[low : low + block + 1])
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(ends, ends[1:])]
                    n = len(crc)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.asarray(docs[low : low + n]), mask=np.asarray(nulls[low : low + n]) > 0),
                            pa.array(ends[:-1] + row["base"]),
                            pa.array(np.diff(ends)),
                            pa.array(crc, pa.int64()),
                            pa.array([row["shard"]] * n, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                    )

    spread = manifest.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long")
