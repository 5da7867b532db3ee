"""Latest-row operators.

Three kinds of "latest" differ in their treatment of ties: ``latest_per_key`` returns exactly
one row, ``latest_by_max`` keeps every row that carries the key's maximum, and ``latest_days``
keeps the rows of the n newest distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordflow.operators.paging import ranged_rows


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, where: Column | None = None
) -> DataFrame:
    """The n-th row per key in the given order, one row at most.

    The planner puts a group limit below the shuffle, so each task sends at most n rows per
    key and a very large key does not travel. Give a total order: ties are otherwise open.
    """
    source = df if where is None else df.where(where)
    numbered = source.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = numbered.where(F.col("_rn") <= n)
    return (kept if n == 1 else kept.where(F.col("_rn") == n)).drop("_rn")


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order."""
    return latest_per_key(df, keys, order)


def latest_by_max(
    df: DataFrame, keys: Sequence[str], order: str, where: Column | None = None, max_where: Column | None = None
) -> DataFrame:
    """All rows that carry the maximum of ``order`` within their key.

    ``where`` filters rows and maximum alike; ``max_where`` limits only the rows that define
    the maximum. The maximum is a partially aggregated group-by and the semi join hashes
    (key, value), so no task has to hold one whole key.
    """
    rows = df if where is None else df.where(where)
    base = rows if max_where is None else rows.where(max_where)
    top = base.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(order).alias("_top"))
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)] + [F.col(order) == F.col("_top")]
    return rows.join(top, on, "left_semi")


def latest_days(df: DataFrame, keys: Sequence[str], order: str, n: int = 1) -> DataFrame:
    """Rows whose value is among the n newest distinct values of the key, ties kept."""
    if n == 1:
        return latest_by_max(df, keys, order)
    names = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    days = df.where(F.col(order).isNotNull()).select(*names, F.col(order).alias("_day")).distinct()
    ranked = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy(F.col("_day").desc())
    top = days.withColumn("_rn", F.row_number().over(ranked)).where(F.col("_rn") <= n).drop("_rn")
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)] + [F.col(order) == F.col("_day")]
    return df.join(top, on, "left_semi")


def latest_day(df: DataFrame, day_col: str) -> DataFrame:
    """Rows of the newest day of the whole table.

    The maximum is a scalar subquery: it is found first (from the column alone) and then
    filters the scan like a literal, which skips partitions and row groups of other days.
    """
    return df.where(F.col(day_col) == df.agg(F.max(day_col)).scalar())


def with_partition_max(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """Attach the key's maximum to every row.

    Aggregate and join back instead of a window: the aggregate combines before its shuffle and
    the join can be split by the skew handling of the adaptive planner; a window cannot.
    """
    top = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(col).alias(name))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(top, on, "inner").drop(*[f"_k{i}" for i in range(len(keys))])


def only_sole(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that are alone in their key.

    Counts and any one row come from a single partial aggregate: a key's rows never meet.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.any_value(F.struct(*rest)).alias("_row")
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), packed).where(F.col("_n") == 1)
    fields = {c: F.col("_row")[c] for c in rest}
    return grouped.select(*[fields.get(c, F.col(c)).alias(c) for c in df.columns])


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], before: Column
) -> DataFrame:
    """Newest row per key among those for which ``before`` holds."""
    return latest_per_key(df, keys, order, where=before)


def lag_in_buckets(
    df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Previous ``value`` of the key in the order given, for keys with many rows in few buckets.

    The buckets of a key meet in one task (``lag_carried`` has no such bound), one row each.
    ``bucket`` must not decrease with the order (a day or an hour of the ordering time, say).
    The last value of each (key, bucket) is found by partial aggregation and handed on to the
    key's next bucket as one extra row that stands before all others there. An ordinary lag
    window on (key, bucket) then sees the right predecessor everywhere, so no task has to hold
    more than one bucket of a key, and the data itself is shuffled once.
    """
    # The value is wrapped so that a NULL value can be told from "no previous row".
    rows = df.withColumns({"_bucket": bucket, "_val": F.struct(F.col(value).alias("v"))})
    across = Window.partitionBy(*keys).orderBy("_bucket")
    carried = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.max_by("_val", F.struct(*order)).alias("_val"))
        .withColumn("_bucket", F.lead("_bucket").over(across))
        .where(F.col("_bucket").isNotNull())
        .withColumn("_real", F.lit(0))
    )
    both = rows.withColumn("_real", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    within = Window.partitionBy(*keys, "_bucket").orderBy("_real", *order)
    chained = both.withColumn("_prev", F.lag("_val").over(within)).where(F.col("_real") == 1)
    return chained.select(*df.columns, F.col("_prev.v").alias(name))


def lag_carried(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Previous ``value`` of the key, whatever share of the rows a key or a moment holds.

    All rows are cut into ranges of keys and ``order`` (which runs a range sort when called). Inside a range
    the row before is at hand; the first row of a range takes it from the last row of the range before,
    which comes from a table of one row a range. No window holds a key: one that spans many ranges is worked
    on by as many tasks. ``order`` should be unique within a key.
    """
    # The value is wrapped so that a NULL value can be told from "no previous row".
    told = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(value).alias("v"))
    fixed = ranged_rows(df, [F.col(c) for c in (*keys, *order)])
    # One row per range: bounded by the number of partitions, not by the data.
    ends = fixed.groupBy("_part").agg(F.max_by(told, "_idx").alias("_end"))
    carried = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_carried"))
    before = F.lag(told).over(Window.partitionBy("_part").orderBy("_idx"))
    rows = fixed.withColumn("_before", before).join(F.broadcast(carried), "_part")
    rows = rows.withColumn("_before", F.coalesce("_before", "_carried"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(f"_before.k{i}").eqNullSafe(F.col(k))
    found = F.when(F.col("_before").isNotNull() & same, F.col("_before.v"))
    return rows.select(*df.columns, found.alias(name))
