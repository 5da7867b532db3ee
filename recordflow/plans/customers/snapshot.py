"""The current customer snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.operators.filters import prior_dates
from recordflow.operators.latest import latest_per_key
from recordflow.sources.buckets import KEY


def current_snapshot(base: DataFrame, deltas: DataFrame, before: str | None = None, tie: tuple = ()) -> DataFrame:
    """Base plus all earlier deltas, newest ``logical_date`` per tenant and customer.

    One union and one shuffle however many deltas there are. A delta beats the base on the same
    date. ``tie`` names delta columns (a batch number, say) that order the deltas before their
    dates do: a later batch was folded onto the earlier ones, however old its events are.
    """
    older = deltas if before is None else prior_dates(deltas, "logical_date", before)
    cols = base.columns
    extra = list(tie)
    marked = base.withColumn("_delta", F.lit(0)).withColumns({t: F.lit(None).cast("bigint") for t in extra})
    both = marked.unionByName(older.select(*cols, *extra, F.lit(1).alias("_delta")))
    order = [*[F.col(t).desc_nulls_last() for t in extra], F.col("logical_date").desc(), F.col("_delta").desc()]
    return latest_per_key(both, ["tenant_id", "customer_id"], order).select(*cols)


def snapshot_in_buckets(base: DataFrame, deltas: DataFrame, before: str | None = None) -> DataFrame:
    """The same for base and deltas read from ``BucketTable``s with equal buckets: nothing is shuffled.

    The base has one row per customer. The newest delta of a customer is an aggregation inside its bucket, and
    the base joins it there; a delta beats the base on the same date.
    """
    older = deltas if before is None else prior_dates(deltas, "logical_date", before)
    cols = [c for c in base.columns if c != KEY]
    newest = older.groupBy(F.col(KEY).alias("_key")).agg(F.max_by(F.struct(*cols), "logical_date").alias("_delta"))
    joined = base.withColumn("_base", F.struct(*cols)).join(newest, F.col(KEY) == F.col("_key"), "full")
    wins = F.col("_base").isNull() | (F.col("_delta.logical_date") >= F.col("_base.logical_date"))
    row = F.when(wins, F.col("_delta")).otherwise(F.col("_base"))
    return joined.select(F.coalesce(KEY, "_key").alias(KEY), row.alias("_row")).select(KEY, "_row.*")
