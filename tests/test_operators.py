import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from recordflow.operators import filters, joins, latest, paging, periods, pivot, sets, totals


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- filters -------------------------------------------------------------------------------


@pytest.mark.parametrize("text,blank,want", [("99999998", False, 4), ("", True, 4), ("", False, 2), ("a", False, 1), ("a,b", False, 2), ("z", False, 0), (",a", False, 3)])
def test_param_filter(spark, text, blank, want):
    df = spark.createDataFrame([("a",), ("b",), ("",), (None,)], "x string")
    assert filters.param_filter(df, "x", text, blank_is_all=blank).count() == want


@pytest.mark.parametrize("n", [3, 1500])
@pytest.mark.parametrize("kind,values", [("string", ["2", "x", None]), ("int", [2, -1, None]), ("bigint", [2, -1, None])])
def test_param_filter_is_one_form_for_all_sizes_and_types(spark, n, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    text = ",".join(str(i) for i in range(n))
    assert [str(r.x) for r in filters.param_filter(df, "x", text).collect()] == ["2"]
    assert [str(r.x) for r in filters.param_filter(df, "x", text + ",").collect()] == ["2", "None"]


def test_keep_any_positive(spark, rows):
    df = spark.createDataFrame([(1, None, 1), (2, 0, 0), (3, None, None), (4, 5, -1)], "k int, a int, b int")
    assert rows(filters.keep_any_positive(df, ["a", "b"]), "k") == [(1,), (4,)]


# --- joins ---------------------------------------------------------------------------------


def test_lookup_filters_the_right_side_first(spark, rows):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "x", 0), (2, "y", 1)], "r int, v string, f int")
    out = joins.lookup(left, right, {"k": "r"}, {"v": "w"}, F.col("f") == 1)
    assert rows(out) == [(1, None), (2, "y")]


@pytest.mark.parametrize(
    "listed,want",
    [([("a",)], [("b",)]), ([("a",), (None,)], []), ([], [("a",), ("b",), (None,)])],
)
def test_not_in_null_rules(spark, rows, listed, want):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    keys = spark.createDataFrame(listed, "y string")
    df.createOrReplaceTempView("ni_l")
    keys.createOrReplaceTempView("ni_r")
    got = rows(joins.anti(df, keys, {"x": "y"}, null_safe=False))
    assert got == want == rows(spark.sql("SELECT x FROM ni_l WHERE x NOT IN (SELECT y FROM ni_r)"))
    safe = rows(joins.anti(df, keys, {"x": "y"}))
    assert (None,) in safe


def test_join_between_equals_plain_condition(spark, rows):
    facts = spark.range(400).select((F.col("id") % 3).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    periods = spark.range(60).select(
        (F.col("id") % 4).alias("k"),
        F.col("id").alias("p"),
        F.date_add(F.lit("2023-12-20").cast("date"), (F.col("id") * 7).cast("int")).alias("lo"),
        F.date_add(F.lit("2023-12-20").cast("date"), (F.col("id") * 9 - 20).cast("int")).alias("hi"),
    )
    want = facts.join(periods, "k").where(F.col("d").between(F.col("lo"), F.col("hi"))).select("k", "d", "p")
    assert rows(joins.join_between(facts, periods, ["k"], "d", "lo", "hi").select("k", "d", "p")) == rows(want)


@pytest.mark.parametrize("bits,levels", [(1, 22), (3, 8), (4, 6)])
def test_blocks_cover_each_day_once(spark, bits, levels):
    """Blocks of a period against its days, whatever the period's length."""
    rng = random.Random(5)
    ends = [(0, 0), (0, 3_652_058), (7, 8), (8, 7), (511, 512), (0, 63), (1, 64)]
    ends += [(a, a + rng.choice([0, 1, 6, 30, 365, 4000])) for a in (rng.randrange(0, 800_000) for _ in range(60))]
    df = spark.createDataFrame(ends, "a long, b long").withColumn("blocks", periods.cover(F.col("a"), F.col("b"), bits, levels))
    for r in df.collect():
        spans = sorted(((n & 0xFFFFFFFF) << bits * (n >> 32), ((n & 0xFFFFFFFF) + 1) << bits * (n >> 32)) for n in r.blocks)
        assert (not spans and r.a > r.b) or (spans[0][0] == r.a and spans[-1][1] == r.b + 1)
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert len(spans) <= 2 * ((1 << bits) - 1) * levels
    day = spark.createDataFrame([(d,) for d in (0, 8, 63, 738_000)], "d long")
    joined = day.crossJoin(df).withColumn("n", F.size(F.array_intersect("blocks", periods.blocks_of(F.col("d"), bits, levels))))
    assert not joined.where((F.col("n") == 1) != F.col("d").between(F.col("a"), F.col("b"))).count()
    assert not joined.where("n > 1").count()


def test_periods_of_millennia_stay_few_rows(spark):
    ends = spark.createDataFrame([("0001-01-01", "9999-12-31"), ("0001-01-02", "9999-12-30"), ("2024-02-29", "9999-12-31")], "lo string, hi string")
    days = [periods.day_number(F.col(c)) for c in ("lo", "hi")]
    sizes = [r[0] for r in ends.select(F.size(periods.cover(*days))).collect()]
    assert max(sizes) <= 14 * periods.LEVELS and days is not None
    assert ends.select(F.min(days[0]), F.max(days[1])).first() == (0, 3_652_058)


@pytest.mark.parametrize("width", [2, 3])
def test_not_in_over_several_columns(spark, rows, width):
    rng = random.Random(width)
    cols = [f"c{i}" for i in range(width)]
    kinds = ", ".join(f"{c} int" for c in cols)

    def some(n, top):
        return spark.createDataFrame([tuple(rng.choice([None, *range(top)]) for _ in cols) for _ in range(n)], kinds)

    left, lists = some(120, 4), [some(n, 4) for n in (0, 1, 3, 5)]
    lists += [lists[2].where(" or ".join(f"{c} is not null" for c in cols)), some(4, 9).na.fill(7)]
    left.createOrReplaceTempView("nl")
    for keys in lists:
        keys.createOrReplaceTempView("nr")
        agree = " AND ".join(f"(l.{c} = r.{c} OR l.{c} IS NULL OR r.{c} IS NULL)" for c in cols)
        want = spark.sql(f"SELECT * FROM nl l WHERE NOT EXISTS (SELECT 1 FROM nr r WHERE {agree})")
        got = joins.anti(left, keys.toDF(*[f"r{c}" for c in cols]), {c: f"r{c}" for c in cols}, null_safe=False)
        assert rows(got) == rows(want)
    with pytest.raises(ValueError):
        joins.anti(left, left, {f"a{i}": "c0" for i in range(5)}, null_safe=False)


def test_runs_of_blocks_make_up_the_cover(spark):
    """The runs that join_between lists, unfolded, are the cover; a period without days has none."""
    rng = random.Random(9)
    ends = [(0, 3_652_058), (8, 7), (5, None), (None, 5), (511, 512), (0, 63), (1, 64)]
    ends += [(a, a + rng.choice([0, 6, 60, 365, 40_000])) for a in (rng.randrange(0, 800_000) for _ in range(40))]
    df = spark.createDataFrame(ends, "a long, b long")
    unfolded = periods.with_runs(df, F.col("a"), F.col("b")).select("a", "b", F.explode(F.sequence("_from", "_to")).alias("n"))
    listed = df.select("a", "b", F.explode(periods.cover(F.col("a"), F.col("b"))).alias("n"))
    assert listed.count() == unfolded.count() > len(ends)
    assert not listed.exceptAll(unfolded).count()


def test_join_between_lists_blocks_in_compiled_code(spark):
    """Blocks are listed without lambdas, which are interpreted for every row of both sides."""
    days = spark.range(5).select(F.col("id").alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    spans = days.select("k", F.col("d").alias("lo"), F.date_add("d", 60).alias("hi"))
    plan = joins.join_between(days, spans, ["k"], "d", "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "lambda" not in plan


def test_join_between_open_ends(spark, rows):
    """An end in the far future and one in the far past list no more buckets than the facts have."""
    facts = spark.createDataFrame([(1, "2024-01-31"), (1, "2024-03-01"), (2, "2024-02-01")], "k int, d string").withColumn("d", F.col("d").cast("date"))
    periods = spark.createDataFrame(
        [(1, "p", "0001-01-01", "9999-12-31"), (1, "q", "2024-02-01", None), (2, "r", "2025-01-01", "9999-12-31")], "k int, n string, lo string, hi string"
    ).withColumns({c: F.col(c).cast("date") for c in ("lo", "hi")})
    out = joins.join_between(facts, periods, ["k"], "d", "lo", "hi")
    assert rows(out.select("k", F.col("d").cast("string"), "n")) == [(1, "2024-01-31", "p"), (1, "2024-03-01", "p")]
    assert joins.join_between(facts.limit(0), periods, ["k"], "d", "lo", "hi").count() == 0


def test_with_totals_and_share(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n int")
    out = joins.with_totals(df, {"t": F.sum("n")}).select("k", totals.share_of(F.col("n"), F.col("t")).alias("s"))
    assert {r.k: r.s for r in out.collect()} == {"a": 25.0, "b": 75.0}
    zero = spark.createDataFrame([(0,)], "n int")
    assert joins.with_totals(zero, {"t": F.sum("n")}).select(totals.share_of(F.col("n"), F.col("t"))).first()[0] == 0.0


def test_fallback_order_and_default(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    first = spark.createDataFrame([(1, "a", None)], "k int, x string, y string")
    second = spark.createDataFrame([(1, "b", "c"), (2, "d", "e")], "k int, x string, y string")
    out = joins.fallback_lookup(df, [joins.Lookup(first, ["k"], ["x", "y"]), joins.Lookup(second, ["k"], ["x", "y"])], ["x", "y"], default="")
    assert rows(out) == [(1, "a", "c"), (2, "d", "e"), (3, "", "")]


# --- latest --------------------------------------------------------------------------------


@pytest.fixture
def dated(spark):
    return spark.createDataFrame(
        [("a", 1, 10), ("a", 2, 20), ("a", 2, 21), ("b", 5, 1), ("c", None, 7), (None, 3, 8), (None, 4, 9)], "k string, d int, v int"
    )


def test_three_kinds_of_latest(dated, rows):
    one = latest.latest_per_key(dated, ["k"], [F.col("d").desc_nulls_last(), F.col("v").desc()])
    assert rows(one, "v") == [(1,), (21,), (7,), (9,)]
    assert rows(latest.latest_by_max(dated, ["k"], "d"), "v") == [(1,), (20,), (21,)]
    assert rows(latest.latest_days(dated, ["k"], "d", 2).where("k = 'a'"), "v") == [(10,), (20,), (21,)]


def test_group_limit_is_below_the_shuffle(dated):
    text = plan(latest.latest_per_key(dated, ["k"], [F.col("d").desc(), F.col("v")]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_latest_day_is_a_scalar_filter(spark, inputs, rows):
    out = latest.latest_day(inputs.orders, "o_orderdate")
    assert "subquery" in plan(out) and "Join" not in plan(out)
    top = inputs.orders.agg(F.max("o_orderdate")).first()[0]
    assert out.count() == inputs.orders.where(F.col("o_orderdate") == top).count()


def test_partition_max_and_sole(dated, rows):
    w = Window.partitionBy("k")
    assert rows(latest.with_partition_max(dated, ["k"], "d", "m").select("k", "v", "m")) == rows(dated.withColumn("m", F.max("d").over(w)).select("k", "v", "m"))
    want = dated.withColumn("n", F.count("*").over(w)).where("n = 1").drop("n")
    assert rows(latest.only_sole(dated, ["k"])) == rows(want)


def test_lag_in_buckets_equals_lag(spark, rows):
    """One key holds most rows, buckets are uneven and some are empty."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 5).alias("k"),
        (F.col("id") * 37 % 1009).alias("t"),
        F.col("id").alias("i"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id")).alias("v"),
    )
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "i")))
    for width in (1, 50, 400, 5000):
        got = latest.lag_in_buckets(df, ["k"], F.floor(F.col("t") / width), ["t", "i"], "v", "p")
        assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("hot", [["k"], ["t"], ["k", "t"]])
def test_lag_carried_with_one_key_or_one_moment(spark, rows, hot):
    """All rows share the key, the time stamp or both; ranges must still be many and no window a key's."""
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), (F.col("id") % 13).alias("t"), F.col("id").alias("i"), (F.col("id") * 3).alias("v"))
    df = df.withColumns({c: F.lit(1).cast("bigint") for c in hot})
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "i")))
    got = latest.lag_carried(df, ["k"], ["t", "i"], "v", "p")
    assert rows(got, *want.columns) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    specs = [line for line in plan.splitlines() if " Window [" in line]
    assert specs and all("windowspecdefinition(_part" in line or "windowspecdefinition(k" not in line for line in specs)
    assert "SortMergeJoin" not in plan


def test_lag_carried_over_many_empty_and_tiny_ranges(spark, rows):
    df = spark.createDataFrame([(i // 2, i, i) for i in range(11)], "k long, t long, v long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(latest.lag_carried(df, ["k"], ["t"], "v", "p"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == rows(df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t"))))


def test_lag_carried_with_one_hot_key_and_moment(spark, rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise((F.col("id") % 3).cast("string")).alias("k"),
        F.when(F.col("id") % 8 < 7, 5).otherwise(F.col("id") % 17).alias("t"),
        F.col("id").alias("i"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id")).alias("v"),
    ).unionByName(spark.createDataFrame([(None, 1, -1, 7), (None, 1, -2, 8)], "k string, t long, i long, v long"))
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "i")))
    assert rows(latest.lag_carried(df, ["k"], ["t", "i"], "v", "p"), *want.columns) == rows(want)


# --- pivots and totals ---------------------------------------------------------------------


def test_three_pivot_forms_agree(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "y", 3), ("c", "z", 4), ("b", "x", None)], "k string, c string, v int")
    codes = {"x": "cx", "y": "cy"}
    case = pivot.pivot_codes(df, ["k"], "c", "v", codes)
    by_map = pivot.map_codes_to_columns(df, ["k"], "c", "v", codes)
    keys = df.where(F.col("c").isin("x", "y")).select("k").distinct()
    joined = keys
    for code, name in codes.items():
        joined = joins.lookup(joined, df, ["k"], {"v": name}, F.col("c") == code)
    assert rows(case) == rows(by_map) == rows(joined)


def test_pivot_latest_equals_latest_then_pivot(spark, rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") % 7).cast("string").alias("c"),
        (F.col("id") * 31 % 101).alias("d"),
        F.col("id").alias("i"),
        F.when(F.col("id") % 13 == 0, None).otherwise(F.col("id")).alias("v"),
    )
    codes = {"1": "one", "4": "four"}
    newest = latest.latest_per_key(df, ["k", "c"], [F.col("d").desc(), F.col("i").desc()])
    out = pivot.pivot_latest(df, ["k"], "c", "v", codes, ["d", "i"])
    assert plan(out).count("Exchange hash") == 1
    assert rows(out) == rows(pivot.pivot_codes(newest, ["k"], "c", "v", codes))


def test_pick_first_skips_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, "w"), ("b", 1, None)], "k string, o int, v string")
    assert rows(pivot.pick_first(df, ["k"], ["v"], order=F.col("o"))) == [("a", "x"), ("b", None)]
    assert rows(pivot.pick_first(df, ["k"], ["v"])) == [("a", "w"), ("b", None)]


def test_pivot_tags(spark, rows):
    df = spark.createDataFrame([(1, "City-Rome,State-,Zip-9"), (2, "Other"), (3, None)], "k int, t string")
    out = pivot.pivot_tags(df, ["k"], "t", {"City": "city", "State": "state", "Zip": "zip"})
    assert rows(out) == [(1, "Rome", "", "9"), (2, "", "", ""), (3, "", "", "")]


def test_totals_rows_per_key(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "z", 4)], "g string, n string, v int")
    out = totals.with_totals_rows(df, ["v"], "n", {"All": None, "Big": F.col("v") > 1}, keys=["g"]).where("dataordering <> '0'")
    assert [(r.g, r.n, None if r.v is None else int(r.v)) for r in out.orderBy("g", "dataordering").collect()] == [("a", "All", 3), ("a", "Big", 2), ("b", "All", 4), ("b", "Big", 4)]


def test_metric_rows_share_scans(spark, inputs):
    orders = inputs.orders
    out = totals.metric_rows([("n", orders, F.count("*"), 1), ("m", orders, F.max("o_orderkey"), 2)])
    assert plan(out).count("FileScan") == 1


# --- paging and sets -----------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 10, 11, 5003])
def test_row_numbers_have_no_gaps(spark, n):
    """All sort keys are equal for most rows: ties must spread and still number 1..n."""
    df = spark.range(n).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id"))
    got = paging.with_row_number(df, [F.col("k")], "rn")
    numbers = [r.rn for r in got.select("rn").collect()]
    assert sorted(numbers) == list(range(1, n + 1))
    ordered = [r.k for r in got.orderBy("rn").collect()]
    assert ordered == sorted(ordered)


def test_pages(spark):
    df = spark.range(25).toDF("k")
    out = paging.paginate(df, [F.col("k")], 10).groupBy("pagenbr").count().orderBy("pagenbr")
    assert [tuple(r) for r in out.collect()] == [(1, 10), (2, 10), (3, 5)]


def test_sentinel_row_of_an_empty_list(spark, rows):
    empty = spark.createDataFrame([], "x string")
    assert rows(sets.with_sentinel_row(empty, "x", "Z")) == [("Z",)]


def test_active_plus_closed(spark, rows):
    accounts = spark.createDataFrame([(1, "A", None), (2, "A", None), (3, "C", 5), (4, "C", 5), (5, "C", 9), (6, None, 5), (7, "C", 5)], "k int, s string, d int")
    amounts = spark.createDataFrame([(1, 1), (3, 2), (4, 0), (5, 3), (7, None)], "k int, v int")
    out = sets.active_plus_closed(accounts, amounts, "k", F.col("s") == "A", F.col("d").between(1, 6), ["v"])
    assert rows(out, "k") == [(1,), (2,), (3,)]
