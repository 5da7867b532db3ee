"""Join shapes used by the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.operators.periods import blocks_of, day_number, with_runs


def _pairs(keys: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}


def lookup(
    df: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    cols: Sequence[str] | Mapping[str, str],
    where: Column | None = None,
    how: str = "left",
) -> DataFrame:
    """Left join that brings in ``cols`` ({source: new name} or names).

    ``keys`` maps left to right columns. ``where`` restricts the right side before the join,
    which is what a literal predicate in the ON clause of a left join means. Only the needed
    columns of the right side travel. Rows multiply when the right side is not unique.
    """
    names, new = _pairs(keys), _pairs(cols)
    source = right if where is None else right.where(where)
    slim = source.select(
        *[F.col(r).alias(f"_k{i}") for i, r in enumerate(names.values())],
        *[F.col(c).alias(n) for c, n in new.items()],
    )
    on = [F.col(left) == F.col(f"_k{i}") for i, left in enumerate(names)]
    return df.join(slim, on, how).drop(*[f"_k{i}" for i in range(len(names))])


def lookup_chain(df: DataFrame, steps: Sequence[tuple]) -> DataFrame:
    """Several lookups in a row; each step is (right, keys, cols) or (right, keys, cols, where)."""
    for step in steps:
        df = lookup(df, *step)
    return df


def join_on_expr(
    left: DataFrame,
    right: DataFrame,
    left_exprs: Sequence[Column],
    right_exprs: Sequence[Column],
    how: str = "left",
) -> DataFrame:
    """Equi join on computed keys: the expressions become columns first, so the join hashes them."""
    n = range(len(left_exprs))
    a = left.select("*", *[e.alias(f"_l{i}") for i, e in enumerate(left_exprs)])
    b = right.select("*", *[e.alias(f"_r{i}") for i, e in enumerate(right_exprs)])
    out = a.join(b, [F.col(f"_l{i}") == F.col(f"_r{i}") for i in n], how)
    return out.drop(*[f"_l{i}" for i in n], *[f"_r{i}" for i in n])


def join_between(
    facts: DataFrame,
    periods: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    date: str,
    low: str,
    high: str,
) -> DataFrame:
    """Facts joined to the periods of the same key that hold the fact's date.

    A period is listed under the few aligned blocks of days that make it up (``operators.periods``), a fact
    under the block of each level that its date lies in, so the hash key is (key, block). A pair meets in one
    block only. That keeps the comparison count at the result size and spreads one very large key over many
    tasks; a period of a millennium costs a few rows. Periods are cut to the days the facts cover, and
    facts are listed on the levels the periods use: both are scalar subqueries over one column. Blocks are
    listed by arithmetic that compiles, without lambdas, which would cost more than the join.
    """
    names = _pairs(keys)
    span = facts.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi")).alias("s"))
    first = F.greatest(day_number(F.col(low)), day_number(F.col("_span.lo")))
    last = F.least(day_number(F.col(high)), day_number(F.col("_span.hi")))
    runs = with_runs(periods.withColumn("_span", span.scalar()).where(F.col(low) <= F.col(high)), first, last)
    used = F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("_level")))
    right = runs.select(
        *[F.col(r).alias(f"_k{i}") for i, r in enumerate(names.values())],
        *[c for c in periods.columns if c not in names.values()],
        F.explode(F.sequence("_from", "_to")).alias("_block_r"),
    )
    left = facts.select("*", F.posexplode(blocks_of(day_number(F.col(date)))).alias("_level", "_block_l"))
    # The levels in use are the bits of one number.
    left = left.withColumn("_used", F.call_function("shiftright", runs.agg(used).scalar(), F.col("_level")))
    left = left.where(F.col("_used").bitwiseAND(1) == 1).drop("_used", "_level")
    on = [F.col(a) == F.col(f"_k{i}") for i, a in enumerate(names)]
    on += [F.col("_block_l") == F.col("_block_r"), F.col(date).between(F.col(low), F.col(high))]
    dropped = [f"_k{i}" for i in range(len(names))]
    return left.join(right, on, "inner").drop("_block_l", "_block_r", *dropped)


def semi(df: DataFrame, keys_df: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    return _existence(df, keys_df, on, "left_semi")


#: Key columns that a NOT IN may have: there is an anti join for each set of them.
MOST_NOT_IN = 4


def anti(
    df: DataFrame, keys_df: DataFrame, on: Sequence[str] | Mapping[str, str], null_safe: bool = True
) -> DataFrame:
    """Rows without a partner.

    ``null_safe=True`` is NOT EXISTS: a NULL key never has a partner and the row stays.
    ``null_safe=False`` is SQL's NOT IN: a NULL in the list leaves no rows, and a NULL key is
    dropped unless the list is empty. With several columns a row stays if it differs for certain
    from every entry, in a column where both have a value.
    """
    if null_safe:
        return _existence(df, keys_df, on, "left_anti")
    names = _pairs(on)
    if len(names) != 1:
        return _not_in(df, keys_df, names)
    (left, right), = names.items()
    # Facts about the list are one scalar subquery, and the rest is a plain hash anti join;
    # the built-in null-aware anti join would need the whole list broadcast.
    facts = keys_df.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.count(F.col(right)).alias("known")).alias("f")
    ).scalar()
    kept = _existence(df, keys_df, on, "left_anti").withColumn("_list", facts)
    rows, known = F.col("_list.rows"), F.col("_list.known")
    return kept.where((rows == 0) | ((rows == known) & F.col(left).isNotNull())).drop("_list")


def _null_pattern(cols: Sequence[Column]) -> Column:
    """Which columns are NULL, as bits."""
    return sum((F.when(c.isNull(), 1 << i).otherwise(0) for i, c in enumerate(cols)), F.lit(0))


def _not_in(df: DataFrame, keys_df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """NOT IN over several columns, as one hash anti join for each pattern of NULLs in the list.

    A row goes if some entry agrees with it wherever both have a value. Entries of one pattern are listed
    for every pattern a row may have, with the columns blanked that are NULL on either side; a row then
    looks up its own pattern and values. The lists are distinct, so they hold no more than a few rows an
    entry, and an entry that is NULL throughout is one row a pattern.
    """
    n = len(names)
    if n > MOST_NOT_IN:
        raise ValueError(f"NOT IN takes up to {MOST_NOT_IN} key columns")
    entries = keys_df.select(*[F.col(r).alias(f"_e{i}") for i, r in enumerate(names.values())])
    entries = entries.withColumn("_nulls", _null_pattern([F.col(f"_e{i}") for i in range(n)]))
    out = df.withColumn("_p", _null_pattern([F.col(left) for left in names]))
    patterns = F.array(*[F.lit(p) for p in range(1 << n)])
    for nulls in range(1 << n):
        own = entries.where(F.col("_nulls") == nulls).withColumn("_q", F.explode(patterns))
        blanked = {f"_e{i}": F.when(F.col("_q").bitwiseAND(1 << i) == 0, F.col(f"_e{i}")) for i in range(n)}
        listed = own.withColumns(blanked).drop("_nulls").distinct()
        on = [F.col("_p") == F.col("_q")]
        on += [F.col(left).eqNullSafe(F.col(f"_e{i}")) for i, left in enumerate(names) if not nulls >> i & 1]
        out = out.join(listed, on, "left_anti")
    return out.drop("_p")


def _existence(df: DataFrame, keys_df: DataFrame, on, how: str) -> DataFrame:
    names = _pairs(on)
    slim = keys_df.select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(names.values())])
    return df.join(slim, [F.col(a) == F.col(f"_k{i}") for i, a in enumerate(names)], how)


def with_totals(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """Attach the totals of the whole frame to every row, as one scalar subquery."""
    totals = df.agg(F.struct(*[e.alias(n) for n, e in aggs.items()]).alias("t")).scalar()
    return df.withColumn("_totals", totals).withColumns({n: F.col("_totals")[n] for n in aggs}).drop("_totals")


@dataclass(frozen=True)
class Lookup:
    """One source of a fallback chain. ``cols`` must follow the order of the wanted columns."""

    right: DataFrame
    keys: Sequence[str] | Mapping[str, str]
    cols: Sequence[str]


def fallback_lookup(
    df: DataFrame, sources: Sequence[Lookup], cols: Sequence[str], default: str | None = None
) -> DataFrame:
    """First non-null value per column over several lookups, in order of preference.

    Every source must be unique per key. Each step joins on the plain key, so nothing is
    multiplied and each join stays an equi join.
    """
    out = df
    for i, source in enumerate(sources):
        out = lookup(out, source.right, source.keys, {c: f"_f{i}_{n}" for c, n in zip(source.cols, cols)})
    tail = [] if default is None else [F.lit(default)]
    picked = {n: F.coalesce(*[F.col(f"_f{i}_{n}") for i in range(len(sources))], *tail) for n in cols}
    return out.withColumns(picked).drop(*[f"_f{i}_{n}" for i in range(len(sources)) for n in cols])


def self_related(df: DataFrame, key: str, related_key: str, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Take values from the related row of the same table where one exists, else keep one's own.

    ``extra`` are columns that must agree besides the key. The table must be unique per
    (key, extra).
    """
    keys = {related_key: key, **{e: e for e in extra}}
    out = lookup(df, df, keys, {c: f"_rel_{c}" for c in cols})
    return out.withColumns({c: F.coalesce(F.col(f"_rel_{c}"), F.col(c)) for c in cols}).drop(
        *[f"_rel_{c}" for c in cols]
    )


def scaffold(codes: DataFrame, facts: DataFrame, key: str, defaults: Mapping[str, Column]) -> DataFrame:
    """One row per code of a fixed list; codes without facts show the defaults."""
    out = codes.join(facts, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})
