"""Loads that move files into a table instead of copying rows.

    <table>/load_batch=<batch>/<files>
    <table>/_loads/<batch>          written last: the batch is complete

A batch without its marker is not read. A load that failed on the way is finished by running it again: it
moves what is still there and then writes the marker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MARKERS = "_loads"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Data files of a folder, by name; names that begin with a dot or an underscore are no data."""
    fs, at = _fs(spark, folder)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(at) if s.isFile()]
    return sorted(n for n in found if not n.startswith((".", "_")))


def is_loaded(spark: SparkSession, table: str, batch: str) -> bool:
    fs, marker = _fs(spark, f"{table}/{_MARKERS}/{batch}")
    return fs.exists(marker)


def loaded_batches(spark: SparkSession, table: str) -> list[str]:
    return _names(spark, f"{table}/{_MARKERS}")


def move_files(spark: SparkSession, source: str, table: str, batch: str, replace: bool = False) -> int:
    """Move the files of ``source`` into a batch of the table; how many were moved.

    Names only are touched, so the time does not grow with the bytes (a store without renames copies them).
    A batch that is complete takes no more files unless ``replace`` is given, which removes what it had;
    with nothing left to move, a repeated load does nothing. Source and table must be on one file system.
    """
    if "/" in batch or batch.startswith((".", "_")):
        raise ValueError(f"not a name for a batch: {batch!r}")
    target, marker = f"{table}/load_batch={batch}", f"{table}/{_MARKERS}/{batch}"
    names = _names(spark, source)
    fs, folder = _fs(spark, target)
    if is_loaded(spark, table, batch):
        if not names:
            return 0
        if not replace:
            raise ValueError(f"batch {batch!r} is loaded already")
        # Not to be read until it is whole again.
        fs.delete(_fs(spark, marker)[1], False)
        fs.delete(folder, True)
    fs.mkdirs(folder)
    for name in names:
        if not fs.rename(_fs(spark, f"{source}/{name}")[1], _fs(spark, f"{target}/{name}")[1]):
            raise OSError(f"cannot move {source}/{name}: a file of that name may be there")
    fs.mkdirs(_fs(spark, f"{table}/{_MARKERS}")[1])
    fs.create(_fs(spark, marker)[1], True).close()
    return len(names)


def read_loaded(spark: SparkSession, table: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of all complete batches, with ``load_batch``."""
    whole = T.StructType([*schema.fields, T.StructField("load_batch", T.StringType())])
    batches = [b for b in loaded_batches(spark, table) if _names(spark, f"{table}/load_batch={b}")]
    if not batches:
        return spark.createDataFrame([], whole)
    rows = spark.read.format(fmt).schema(whole).option("basePath", table).load([f"{table}/load_batch={b}" for b in batches])
    return rows.withColumn("load_batch", F.col("load_batch").cast("string"))
