"""Set operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def values_frame(spark: SparkSession, values: Sequence[str], name: str) -> DataFrame:
    """A short fixed list of texts as rows; folded into the plan, no job is needed to make it."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


def union_distinct(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out.distinct()


def union_by_name(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def with_sentinel_row(df: DataFrame, col: str, value: str) -> DataFrame:
    """Distinct values plus one marker row, so that a list is never empty."""
    marker = df.sparkSession.range(1).select(F.lit(value).alias(col))
    return union_distinct(marker, df.select(col))


def active_plus_closed(
    df: DataFrame,
    totals: DataFrame,
    key: str | Mapping[str, str],
    active: Column,
    closed_in_period: Column,
    amounts: Sequence[str],
) -> DataFrame:
    """All active rows with their totals, and closed ones only when some amount is positive.

    One left join and one condition. A closed row without totals has no positive amount, so
    the inner join of the closed half is implied.
    """
    pairs = {key: key} if isinstance(key, str) else dict(key)
    (left, right), = pairs.items()
    side = totals.withColumnRenamed(right, "_key")
    joined = df.join(side, F.col(left) == F.col("_key"), "left").drop("_key")
    is_active = F.coalesce(active, F.lit(False))
    flagged = joined.withColumns({"_active": is_active, "_closed": ~is_active & F.coalesce(closed_in_period, F.lit(False))})
    positive = F.lit(False)
    for name in amounts:
        positive = positive | (F.coalesce(F.col(name), F.lit(0)) > 0)
    return flagged.where(F.col("_active") | (F.col("_closed") & positive)).drop("_active", "_closed")
