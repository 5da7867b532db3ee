"""Summary tables that are refreshed by source partition.

    <root>/states/<part>=<value>   partial aggregates of one source partition
    <root>/ledger                  what was folded in: the files of each partition, as a fingerprint
    <root>/summary                 the result

A refresh compares the files of each source partition with the ledger. Only new and changed partitions are read
and aggregated; states of removed ones go. The summary is merged from all states, which have a row per key
and partition, not per source row. The ledger is written last: after a failure the same partitions are
done again, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.sources.tables import path_exists, remove_path

_LEDGER = "part string, files string"


@dataclass(frozen=True)
class Measure:
    """An aggregate that can be merged from parts: ``kind`` is count, sum, min, max or avg."""

    kind: str
    of: Column | None = None
    result: str | None = None

    def states(self, name: str) -> dict[str, Column]:
        value = F.lit(1) if self.of is None else self.of
        if self.kind == "avg":
            return {f"{name}__sum": F.sum(value), f"{name}__count": F.count(value)}
        made = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
        return {f"{name}__{self.kind}": made[self.kind](value)}

    def merged(self, name: str) -> Column:
        made = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
        if self.kind == "avg":
            out = F.sum(f"{name}__sum") / F.sum(f"{name}__count")
        else:
            out = made[self.kind](f"{name}__{self.kind}")
        return (out if self.result is None else out.cast(self.result)).alias(name)


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the partitions that were read, and those that are gone."""

    read: tuple[str, ...]
    removed: tuple[str, ...]
    summary: DataFrame


def partition_files(spark: SparkSession, path: str, part: str) -> dict[str, str]:
    """A fingerprint of the files (name, size, time) of each folder ``<part>=<value>``: names only, nothing is read."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for folder in fs.listStatus(hadoop_path) if fs.exists(hadoop_path) else ():
        name, _, value = folder.getPath().getName().partition("=")
        if folder.isDirectory() and name == part:
            files = [f for f in fs.listStatus(folder.getPath()) if not f.getPath().getName().startswith(("_", "."))]
            told = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)
            if told:
                out[value] = hashlib.sha256(repr(told).encode()).hexdigest()
    return out


def refresh_by_partition(
    spark: SparkSession, source: str, root: str, part: str, keys: Sequence[str], measures: Mapping[str, Measure]
) -> Refresh:
    """Bring the summary below ``root`` up to date with the Parquet table ``source``, laid out by ``part``.

    The same ``keys`` and ``measures`` must be given every time. A new file in a partition, a replaced one and a
    removed partition all count; partitions with the same files as last time are not read.
    """
    ledger_path, states_path, summary_path = (f"{root}/{n}" for n in ("ledger", "states", "summary"))
    now = partition_files(spark, source, part)
    known = path_exists(spark, f"{ledger_path}/_SUCCESS")
    before = {r["part"]: r["files"] for r in spark.read.schema(_LEDGER).parquet(ledger_path).collect()} if known else {}
    changed = sorted(p for p in now if before.get(p) != now[p])
    removed = sorted(p for p in before if p not in now)
    parts = {n: e for name, m in measures.items() for n, e in m.states(name).items()}
    for value in [*changed, *removed]:
        remove_path(spark, f"{states_path}/_part={value}")
    fresh = None
    if changed:
        # The folders are read by their paths: nothing else is even listed.
        for value in changed:
            piece = spark.read.parquet(f"{source}/{part}={value}").withColumn("_part", F.lit(value))
            fresh = piece if fresh is None else fresh.unionByName(piece, allowMissingColumns=True)
        fresh = fresh.groupBy("_part", *keys).agg(*[e.alias(n) for n, e in parts.items()])
        fresh.write.partitionBy("_part").mode("append").parquet(states_path)
    # A partition whose files hold no rows has no state.
    kept = [p for p in (f"{states_path}/_part={value}" for value in sorted(now)) if path_exists(spark, p)]
    if kept or fresh is not None:
        stored = spark.read.parquet(*kept) if kept else fresh
        summary = stored.groupBy(*keys).agg(*[m.merged(name) for name, m in measures.items()])
        summary.write.mode("overwrite").parquet(summary_path)
    elif path_exists(spark, summary_path):
        schema = spark.read.parquet(summary_path).schema
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(summary_path)
    else:
        raise ValueError(f"{source} has no partition yet")
    spark.createDataFrame(sorted(now.items()), _LEDGER).write.mode("overwrite").parquet(ledger_path)
    return Refresh(tuple(changed), tuple(removed), spark.read.parquet(summary_path))

