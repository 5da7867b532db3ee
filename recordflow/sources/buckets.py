"""Tables bucketed by their key, so that daily joins need no shuffle of the large side.

Rows are stored by the hash of ``bucket_key``, the key columns as one text that is never NULL. A scan of such a
table is partitioned like the result of a shuffle by that column into as many parts, so a join or an aggregation
on it starts at once; the small side of a join is brought to the same parts. Days are folders of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.sources.tables import path_exists

KEY = "bucket_key"


def key_text(cols: Sequence[str | Column]) -> Column:
    """Key columns as one text; a NULL differs from every value."""
    named = [(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(cols)]
    return F.to_json(F.struct(*named))


def to_buckets(df: DataFrame, n: int, key: str = KEY) -> DataFrame:
    """Rows shuffled as the buckets of a table are: for the small side of a join."""
    return df.repartition(n, key)


@dataclass(frozen=True)
class BucketTable:
    """A table of Parquet files below ``path``; ``part`` names an optional folder column.

    The catalog of the session knows it under a name made from its path; a new session registers the
    files that are there. Rows are written by one task per bucket.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    n: int
    part: str | None = None

    @property
    def name(self) -> str:
        return f"buckets_{hashlib.md5(self.path.encode()).hexdigest()}"

    @property
    def columns(self) -> list[str]:
        own = [f.name for f in self.schema.fields if f.name != self.part]
        return [KEY, *own] + ([self.part] if self.part else [])

    def register(self) -> None:
        if self.spark.catalog.tableExists(self.name):
            return
        kinds = {f.name: f.dataType.simpleString() for f in self.schema.fields} | {KEY: "string"}
        columns = ", ".join(f"`{c}` {kinds[c]}" for c in self.columns)
        by = f"PARTITIONED BY (`{self.part}`)" if self.part else ""
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet {by} "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.n} BUCKETS LOCATION '{self.path}'"
        )
        if self.part and path_exists(self.spark, self.path):
            self.spark.catalog.recoverPartitions(self.name)

    def write(self, df: DataFrame, day: str | None = None, placed: bool = False) -> None:
        """Replace the table, or the folder of one day. ``placed``: the rows are in their buckets already."""
        self.register()
        keyed = df if KEY in df.columns else df.withColumn(KEY, key_text(self.keys))
        rows = keyed if placed else to_buckets(keyed, self.n)
        own = [c for c in self.columns if c != self.part]
        slot = f"PARTITION (`{self.part}` = DATE '{day}')" if self.part else ""
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} {slot} SELECT * FROM {{rows}}", rows=rows.select(*own))

    def write_days(self, df: DataFrame) -> None:
        """Add rows whose day is in the ``part`` column, as runs over several days do."""
        self.register()
        rows = to_buckets(df.withColumn(KEY, key_text(self.keys)), self.n)
        self.spark.sql(f"INSERT INTO TABLE {self.name} SELECT * FROM {{rows}}", rows=rows.select(*self.columns))

    def read(self) -> DataFrame:
        """All rows, with their ``bucket_key``."""
        self.register()
        return self.spark.table(self.name)
