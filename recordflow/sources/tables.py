"""Files and tables: partitioned and dated writes, staging, loads, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from recordflow.session import scratch_path


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read files; a declared schema also fixes the types of partition folders."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder or file on whatever file system the path names, if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A folder that may be absent; absent reads as an empty frame of the schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_table(spark, path, schema, fmt)


def spread_for_write(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Group rows by target folder so that a task writes few files.

    REBALANCE lets the adaptive planner merge small folders into one task and split a folder
    that holds a large share of all rows over several.
    """
    return df.hint("rebalance", *[F.col(p) for p in parts])


def write_partitioned(
    df: DataFrame, path: str, parts: Sequence[str], mode: str = "overwrite", fmt: str = "parquet"
) -> None:
    """Snappy files in one folder per value of the partition columns."""
    (
        spread_for_write(df, parts)
        .write.format(fmt)
        .option("compression", "snappy")
        .partitionBy(*parts)
        .mode(mode)
        .save(path)
    )


def write_dated(df: DataFrame, root: str, date: str, mode: str = "overwrite", date_col: str = "logical_date") -> None:
    """Replace (or extend) the slice of one day and leave the other days alone."""
    (
        df.withColumn(date_col, F.lit(date).cast("date"))
        .write.format("parquet")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .mode(mode)
        .save(root)
    )


def copy_columns(df: DataFrame, cols: Sequence[str], prefix: str = "x_") -> DataFrame:
    """Copies to partition by, so that the originals stay in the file body."""
    return df.withColumns({prefix + c: F.col(c) for c in cols})


def write_text_extract(df: DataFrame, path: str, part: str = "tenant_id", line: str = "line", single_file: bool = False) -> None:
    """Text lines in one folder per tenant. One file per tenant only on request: it is one task."""
    slim = df.select(line, part)
    (slim.repartition(1) if single_file else slim).write.partitionBy(part).mode("overwrite").text(path)


def truncate_with_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Empty a dataset but leave it readable."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def inspect(df: DataFrame, order: Sequence[Column], n: int = 10) -> tuple[str, int, DataFrame]:
    """Schema text, row count (an action) and the first n rows of a total order."""
    return df.schema.simpleString(), df.count(), df.orderBy(*order).limit(n)


def ctas(df: DataFrame, name: str, persistent: bool = False) -> DataFrame:
    """Stage a result. Session-scoped staging is a view: the plan stays whole and lazy."""
    if not persistent:
        df.createOrReplaceTempView(name)
        return df
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a result once to the shared folder and read it back: for results used many times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def copy_table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_into(df: DataFrame, path: str) -> None:
    """Append a query result to a table stored under a path."""
    df.write.mode("append").parquet(path)


def insert_dynamic_partition(df: DataFrame, path: str, col: str) -> None:
    """Append; the named column decides the partition."""
    spread_for_write(df, [col]).write.mode("append").partitionBy(col).parquet(path)


def load_files(
    spark: SparkSession, source: str, table: str, batch: str, overwrite: bool = False, fmt: str = "parquet"
) -> None:
    """Bring staged files into a table as one batch.

    The batch is a partition and is written by dynamic overwrite, so running a load again
    replaces that batch instead of doubling it. ``overwrite`` replaces the whole table.
    """
    incoming = spark.read.format(fmt).load(source).withColumn("load_batch", F.lit(batch))
    (
        incoming.write.option("partitionOverwriteMode", "static" if overwrite else "dynamic")
        .partitionBy("load_batch")
        .mode("overwrite")
        .parquet(table)
    )


def refresh_aggregate(base: DataFrame, path: str, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Recompute a summary table and replace it."""
    summary = base.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])
    summary.write.mode("overwrite").parquet(path)
    return base.sparkSession.read.schema(summary.schema).parquet(path)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    try:
        return spark.table(name)
    except AnalysisException:
        return None
