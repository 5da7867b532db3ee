"""Long-to-wide and list operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.functions.text import token


def pick_first(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Column | None = None) -> DataFrame:
    """First non-null value per key and column.

    With an ``order`` that means first in that order; without, the smallest value, which is the
    value itself when there is only one.
    """

    def pick(name: str) -> Column:
        if order is None:
            return F.min(name)
        return F.min_by(F.col(name), F.when(F.col(name).isNotNull(), order))

    return df.groupBy(*keys).agg(*[pick(c).alias(c) for c in cols])


def pivot_codes(
    df: DataFrame,
    keys: Sequence[str],
    code: str,
    value: str,
    codes: Mapping[str, str] | Sequence[str],
    agg: str = "first",
    default: Column | None = None,
) -> DataFrame:
    """Code/value rows to one column per code, in one scan and one partial aggregation.

    ``codes`` maps code to column name. ``agg`` is first (smallest value; expects one row per
    key and code), sum or max. Codes outside the list are dropped before the shuffle.
    """
    names = dict(codes) if isinstance(codes, Mapping) else {c: c for c in codes}
    reduce = {"first": F.min, "sum": F.sum, "max": F.max}[agg]
    kind = df.schema[value].dataType

    def cell(wanted: str) -> Column:
        out = reduce(F.when(F.col(code) == wanted, F.col(value)))
        return out if default is None else F.coalesce(out, default.cast(kind))

    return (
        df.where(F.col(code).isin(list(names)))
        .groupBy(*keys)
        .agg(*[cell(c).alias(n) for c, n in names.items()])
    )


def pivot_latest(
    df: DataFrame,
    keys: Sequence[str],
    code: Column | str,
    value: str,
    codes: Mapping[str, str],
    order: Sequence[str],
) -> DataFrame:
    """One column per code with the value of its newest row, by ``order`` ascending.

    The same as taking the newest row per (key, code) and pivoting it, but in one aggregation
    and so with one shuffle: every cell keeps the value of its largest order seen so far. Meant
    for a handful of codes; each row is tested against all of them.
    """
    which = F.col(code) if isinstance(code, str) else code

    def cell(wanted: str) -> Column:
        hit = which == wanted
        return F.max_by(F.when(hit, F.col(value)), F.when(hit, F.struct(*order)))

    return df.where(which.isin(list(codes))).groupBy(*keys).agg(*[cell(c).alias(n) for c, n in codes.items()])


def map_codes_to_columns(
    df: DataFrame, keys: Sequence[str], code: str, value: str, codes: Mapping[str, str]
) -> DataFrame:
    """The map form of the pivot: one map per key, then one look-up per code.

    Useful when the code list is only known later. Duplicate codes keep the largest value and
    are reduced before the map is built, so a map holds one entry per code.
    """
    slim = df.where(F.col(code).isin(list(codes))).groupBy(*keys, code).agg(F.max(value).alias("_v"))
    packed = slim.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(code, "_v"))).alias("_m"))
    return packed.select(*keys, *[F.col("_m")[c].alias(n) for c, n in codes.items()])


def pivot_tags(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    tags: Mapping[str, str],
    item_sep: str = ",",
    kv_sep: str = "-",
) -> DataFrame:
    """``tag-value,tag-value`` text to one column per tag; missing tags become ''.

    The tags of one row are looked up inside that row; the group-by only merges rows of a key.
    """
    items = F.split(F.col(text), item_sep, -1)

    def value_of(tag: str) -> Column:
        hit = F.filter(items, lambda x: token(x, kv_sep, 0) == tag)
        return F.coalesce(F.array_max(F.transform(hit, lambda x: F.coalesce(token(x, kv_sep, 1), F.lit("")))), F.lit(""))

    per_row = df.select(*keys, *[value_of(t).alias(n) for t, n in tags.items()])
    return per_row.groupBy(*keys).agg(*[F.max(n).alias(n) for n in tags.values()])


def join_strings(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    sep: str = ",",
    distinct: bool = False,
    name: str | None = None,
) -> DataFrame:
    """Sorted string list per key. ``distinct`` drops repeats before anything is collected."""
    source = df.select(*keys, col)
    if distinct:
        source = source.distinct()
    listed = F.array_join(F.array_sort(F.collect_list(col)), sep)
    return source.groupBy(*keys).agg(listed.alias(name or col))


def explode_list(df: DataFrame, col: str, sep: str, name: str, pos: str | None = None) -> DataFrame:
    """One row per item of separated text."""
    items = F.split(F.col(col), sep, -1)
    if pos is None:
        return df.withColumn(name, F.explode(items))
    return df.select("*", F.posexplode(items).alias(pos, name)).withColumn(pos, F.col(pos).cast("bigint"))
