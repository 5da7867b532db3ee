"""The newest items of all customers, kept in buckets between the batches of a stream.

    <root>/batches/batch=<id>/bucket=<b>      what a batch brought
    <root>/compacted/upto=<id>/bucket=<b>     the newest items of all batches up to one

A batch reads the folders of its own buckets only: those of the last compaction and of the batches after
it, ``every`` of them at most. Folders that a compaction replaces are removed by a later batch, when the
batch that wrote it can no longer be replayed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.sources.tables import spread_for_write

BUCKET = "bucket"


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def touched_buckets(df: DataFrame) -> list[int]:
    """The buckets that occur, as many as there are buckets at most."""
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


@dataclass(frozen=True)
class BucketStore:
    """``newest`` reduces items to those to be kept; it must give the same for parts and then their union."""

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    newest: Callable[[DataFrame], DataFrame]
    n: int = 64
    every: int = 16

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _folders(self, path: str) -> dict[str, str]:
        """Value and path of the folders ``<name>=<value>`` below a path."""
        fs, at = self._fs(path)
        if not fs.exists(at):
            return {}
        found = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        return {p.getName().partition("=")[2]: p.toString() for p in found}

    def _is_complete(self, path: str) -> bool:
        fs, at = self._fs(f"{path}/_SUCCESS")
        return fs.exists(at)

    def last_compaction(self, before: int) -> int:
        """The newest finished compaction of earlier batches, -1 if there is none."""
        found = self._folders(f"{self.root}/compacted")
        return max([int(k) for k, p in found.items() if int(k) < before and self._is_complete(p)], default=-1)

    def paths(self, batch_id: int, buckets: Iterable[int] | None) -> list[str]:
        """Folders that hold the items of these buckets (or all) as of a batch."""
        upto = self.last_compaction(batch_id)
        tops = [f"{self.root}/compacted/upto={upto}"] if upto >= 0 else []
        batches = self._folders(f"{self.root}/batches")
        tops += [p for k, p in sorted(batches.items(), key=lambda kv: int(kv[0])) if upto < int(k) <= batch_id]
        wanted = None if buckets is None else {str(b) for b in buckets}
        return [p for top in tops for b, p in sorted(self._folders(top).items()) if wanted is None or b in wanted]

    def read(self, batch_id: int, buckets: Iterable[int] | None = None) -> DataFrame:
        """Items as of a batch, of some buckets or of all; an item may be there in several states."""
        found = self.paths(batch_id, buckets)
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*found)

    def _write(self, df: DataFrame, path: str) -> None:
        rows = df.withColumn(BUCKET, bucket_of(self.keys, self.n))
        spread_for_write(rows, [BUCKET]).write.partitionBy(BUCKET).mode("overwrite").parquet(path)

    def put(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Write the items of a batch, replacing what an earlier attempt wrote, and read them back."""
        path = f"{self.root}/batches/batch={batch_id}"
        self._write(df, path)
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(path)

    def compact(self, batch_id: int) -> None:
        """Reduce everything up to this batch to the newest items."""
        self._write(self.newest(self.read(batch_id)), f"{self.root}/compacted/upto={batch_id}")

    def due(self, batch_id: int) -> bool:
        return (batch_id + 1) % self.every == 0

    def purge(self, batch_id: int) -> None:
        """Remove what the last compaction before this batch has replaced. That batch is done for good."""
        upto = self.last_compaction(batch_id)
        old = [p for k, p in self._folders(f"{self.root}/batches").items() if int(k) <= upto]
        old += [p for k, p in self._folders(f"{self.root}/compacted").items() if int(k) < upto]
        for path in old:
            fs, at = self._fs(path)
            fs.delete(at, True)


def write_bucketed_folders(df: DataFrame, path: str, keys: Sequence[str], n: int = 64) -> None:
    """A table in one folder per bucket, so that a batch can read the buckets of its keys alone."""
    rows = df.withColumn(BUCKET, bucket_of(keys, n))
    spread_for_write(rows, [BUCKET]).write.partitionBy(BUCKET).mode("overwrite").parquet(path)
