"""Totals, shares and metric reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_distinct_rows(df: DataFrame, rows: Sequence[str], by: Sequence[str], name: str = "cnt") -> DataFrame:
    """Number of distinct rows per group: two partial aggregations, no group is collected."""
    return df.select(*rows).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def share_of(value: Column, total: Column, scale: int = 4) -> Column:
    """Percentage of a total; 0 where the total is zero or missing."""
    ratio = F.try_divide(value.cast("double") * 100, total.cast("double"))
    return F.round(F.coalesce(ratio, F.lit(0.0)), scale)


def with_totals_rows(
    df: DataFrame,
    sums: Sequence[str],
    label_col: str,
    labels: Mapping[str, Column | None],
    keys: Sequence[str] = (),
    order_col: str = "dataordering",
    blank: str | None = "",
    sum_type: str = "decimal(38,4)",
) -> DataFrame:
    """Detail rows (rank '0') followed by total rows (ranks '1', '2', …).

    ``labels`` maps the text of a total row to the condition of the rows it sums (None = all).
    All totals come from one aggregation with conditional sums, however many there are, so the
    input is read twice and not once per total. ``keys`` makes it one set of totals per key.
    Text columns of total rows hold ``blank``, other columns NULL.
    """
    aggs = []
    for i, (_, test) in enumerate(labels.items()):
        for s in sums:
            cell = F.col(s) if test is None else F.when(test, F.col(s))
            aggs.append(F.sum(cell).cast(sum_type).alias(f"_t{i}_{s}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(text).alias("_label"),
                F.lit(str(i + 1)).alias("_rank"),
                *[F.col(f"_t{i}_{s}").alias(f"_{s}") for s in sums],
            )
            for i, text in enumerate(labels)
        ]
    )
    grouped = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    flat = grouped.select(*keys, F.explode(rows).alias("_r"))

    def cell(name: str) -> Column:
        kind = df.schema[name].dataType
        if name == label_col:
            return F.col("_r._label")
        if name in sums:
            return F.col(f"_r._{name}")
        if name in keys:
            return F.col(name)
        return F.lit(blank if kind.typeName() == "string" else None).cast(kind)

    totals = flat.select(*[cell(c).alias(c) for c in df.columns], F.col("_r._rank").alias(order_col))
    detail = df.withColumns({s: F.col(s).cast(sum_type) for s in sums}).withColumn(order_col, F.lit("0"))
    return detail.unionByName(totals)


def rollup_totals(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Detail groups, sub-totals and grand total in one pass, with the grouping level."""
    level = F.grouping_id(*keys).cast("bigint").alias("level")
    return df.rollup(*keys).agg(level, *[e.alias(n) for n, e in sums.items()])


def metric_lines(
    df: DataFrame, metrics: Sequence[tuple[str, Column, int]], suffix: Column | None = None
) -> DataFrame:
    """A two-column report of (label, expression, order) over one frame, which is read once.

    The expressions are aggregates, for one row each; with ``suffix`` they are values, and every row of the
    frame gives a line each with its suffix in the label.
    """
    cells = [e.cast("string").alias(f"_m{i}") for i, (_, e, _) in enumerate(metrics)]
    one = df.agg(*cells) if suffix is None else df.select(*cells, suffix.alias("_suffix"))
    end = F.lit("") if suffix is None else F.col("_suffix")
    rows = F.array(
        *[
            F.struct(F.concat(F.lit(text), end).alias("description"), F.col(f"_m{i}").alias("cnt"), F.lit(order).alias("ord"))
            for i, (text, _, order) in enumerate(metrics)
        ]
    )
    return one.select(F.inline(rows))


def metric_rows(metrics: Sequence[tuple[str | Column, DataFrame, Column, int]]) -> DataFrame:
    """A two-column report of (label, frame, expression, order).

    A text label takes the aggregate of the frame and gives one row; a label column gives one
    row per row of the frame. Aggregates of the same frame share one scan.
    """
    scans: dict[int, tuple[DataFrame, list]] = {}
    parts = []
    for label, frame, expr, order in metrics:
        if isinstance(label, str):
            scans.setdefault(id(frame), (frame, []))[1].append((label, expr, order))
        else:
            parts.append(
                frame.select(label.alias("description"), expr.cast("string").alias("cnt"), F.lit(order).alias("ord"))
            )
    for frame, cells in scans.values():
        one = frame.agg(*[e.cast("string").alias(f"_m{i}") for i, (_, e, _) in enumerate(cells)])
        rows = F.array(
            *[
                F.struct(F.lit(text).alias("description"), F.col(f"_m{i}").alias("cnt"), F.lit(order).alias("ord"))
                for i, (text, _, order) in enumerate(cells)
            ]
        )
        parts.append(one.select(F.inline(rows)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
