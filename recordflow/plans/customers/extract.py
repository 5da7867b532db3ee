"""Delimited extract of the snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schemas
from recordflow.operators.filters import date_range_filter
from recordflow.plans.customers.snapshot import current_snapshot


def _line(kind: str, item: Column, fields: list[str]) -> Column:
    parts = [F.coalesce(item[f], F.lit("")) for f in fields]
    return F.concat_ws("|", F.lit(kind), F.coalesce(F.col("customer_id"), F.lit("")), *parts)


def extract_lines(snapshot: DataFrame) -> DataFrame:
    """``1|id|name``, ``2|id|address`` and ``3|id|identification`` lines, fields by name."""
    name = _line("1", F.col("name"), ["firstName", "middleName", "lastName"])
    addresses = F.transform(
        F.coalesce("addresses", F.array()), lambda a: _line("2", a, schemas.ADDRESS.fieldNames())
    )
    ids = F.transform(
        F.coalesce("identifications", F.array()), lambda i: _line("3", i, schemas.IDENTIFICATION.fieldNames())
    )
    return snapshot.select("tenant_id", F.explode(F.concat(F.array(name), addresses, ids)).alias("line"))


def extract_source(base: DataFrame, deltas: DataFrame, mode: str, low: str, high: str) -> DataFrame:
    """Rows to extract: ``full`` is base plus the deltas of the range, ``delta`` the deltas only."""
    ranged = date_range_filter(deltas, "logical_date", low, high)
    if mode == "full":
        return current_snapshot(base, ranged)
    if mode == "delta":
        return ranged.select(*base.columns)
    raise ValueError(f"unknown mode {mode!r}")
