"""Global row numbers and pages without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordflow.session import cut_lineage

_ROW_BITS = (1 << 33) - 1


def ranged_rows(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """All rows in a global order, with ``_part`` and, ascending within it, ``_idx``.

    Rows are range-partitioned and sorted, and written once to the checkpoint folder (this step runs
    when called): whatever is derived from the partitions must see the very same ones, also after the
    loss of an executor. A hash of the whole row closes the order, so a run of equal sort keys can be
    split between partitions.
    """
    total = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    ranged = df.repartitionByRange(*total).sortWithinPartitions(*total)
    index = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    return cut_lineage(ranged.withColumns({"_part": F.spark_partition_id(), "_idx": index}))


def with_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_nbr") -> DataFrame:
    """Number all rows 1..n in a global order.

    Rows are ordered (``ranged_rows``, which runs when called), numbered inside their partition, and
    shifted by the number of rows in earlier partitions.
    """
    if not df.columns:
        raise ValueError("nothing to number")
    fixed = ranged_rows(df, order)
    # One row per partition: bounded by the partition count, not by the data.
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = fixed.join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_idx") + 1).cast("bigint").alias(name))


def paginate(df: DataFrame, order: Sequence[Column], size: int, col: str = "pagenbr") -> DataFrame:
    """Page number of each row when ``size`` rows go on a page."""
    numbered = with_row_number(df, order, "_row")
    page = F.floor((F.col("_row") + (size - 1)) / size).cast("bigint")
    return numbered.withColumn(col, page).drop("_row")
