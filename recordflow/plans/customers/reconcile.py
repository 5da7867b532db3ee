"""Counts of what was sent and what arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.operators.latest import latest_per_key


def reconcile(source: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected and loaded rows per slice and their difference; a slice may miss on either side."""
    expected = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected"))
    arrived = loaded.groupBy(*keys).agg(F.count(F.lit(1)).alias("loaded"))
    joined = expected.join(arrived, list(keys), "full")
    have = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("expected", "loaded")}
    return joined.withColumns(have).withColumn("delta", F.col("expected") - F.col("loaded"))


def account_for(sent: DataFrame, loaded: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row: how many records were sent, loaded and rejected, and how many are unaccounted for."""
    counts = {"sent": sent, "loaded": loaded, "rejected": rejects}
    tagged = [df.select(F.lit(name).alias("what")) for name, df in counts.items()]
    rows = tagged[0].unionAll(tagged[1]).unionAll(tagged[2])
    out = rows.agg(*[F.count_if(F.col("what") == name).alias(name) for name in counts])
    return out.withColumn("missing", F.col("sent") - F.col("loaded") - F.col("rejected"))


def topic_offsets(records: DataFrame) -> DataFrame:
    """Next offset and number of records per partition of a topic-shaped table."""
    return records.groupBy("partition").agg(
        (F.max("offset") + 1).alias("next_offset"), F.count(F.lit(1)).alias("records")
    )


def first_per_partition(records: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """The earliest record of every partition."""
    return latest_per_key(records, ["partition"], order or [F.col("offset").asc()])
