"""Joins, aggregations and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.catalog.registry import query
from recordflow.catalog.roles import with_roles
from recordflow.functions import text
from recordflow.operators import joins, latest, paging, pivot, sets, totals

DEC = "decimal(38,4)"


def _day(text_value: str):
    return F.lit(text_value).cast("date")


# --- joins ---------------------------------------------------------------------------------


@query(
    "left_join_chain",
    """SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(t):
    out = joins.lookup_chain(
        t.orders.select("o_orderkey", "o_custkey"),
        [
            (t.customer, {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey"]),
            (t.nation, {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"]),
            (t.region, {"n_regionkey": "r_regionkey"}, ["r_name"]),
        ],
    )
    return out.select("o_orderkey", "c_name", "n_name", "r_name")


@query(
    "left_join_composite",
    with_roles("loan_account", "customer_master")
    + """ SELECT a.account_id, m.name_line FROM loan_account a
    LEFT JOIN customer_master m ON a.customer_id = m.customer_id AND a.ledger_id = m.ledger_id""",
)
def _(t):
    out = joins.lookup(t.loan_account, t.customer_master, ["customer_id", "ledger_id"], ["name_line"])
    return out.select("account_id", "name_line")


@query(
    "inner_join",
    "SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.lookup(rows, t.part, {"l_partkey": "p_partkey"}, ["p_brand"], how="inner")


@query(
    "left_join_filtered_right",
    """SELECT c_custkey, o_orderkey FROM customer
    LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'""",
)
def _(t):
    where = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    return joins.lookup(t.customer.select("c_custkey"), t.orders, {"c_custkey": "o_custkey"}, ["o_orderkey"], where)


@query(
    "range_join",
    with_roles("loan_txn", "loan_statement")
    + """ SELECT t.account_id, t.txn_id, t.posted_on, t.amount, s.message_id FROM loan_txn t
    JOIN loan_statement s ON t.account_id = s.account_id AND t.posted_on >= s.starts_on AND t.posted_on <= s.ends_on""",
)
def _(t):
    periods = t.loan_statement.select("account_id", "message_id", "starts_on", "ends_on")
    facts = t.loan_txn.select("account_id", "txn_id", "posted_on", "amount")
    out = joins.join_between(facts, periods, ["account_id"], "posted_on", "starts_on", "ends_on")
    return out.drop("starts_on", "ends_on")


@query(
    "computed_key_join",
    """SELECT e.event_id, u.c_custkey FROM events e
    JOIN customer u ON lower('CUSTOMER#' || lpad(CAST(e.user_id AS VARCHAR), 9, '0')) = lower(u.c_name)""",
)
def _(t):
    key = F.lower(F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("user_id").cast("string"), 9, "0")))
    out = joins.join_on_expr(
        t.events.select("event_id", "user_id"), t.customer.select("c_custkey", "c_name"), [key], [F.lower("c_name")], "inner"
    )
    return out.select("event_id", "c_custkey")


@query(
    "latest_by_group_max",
    """SELECT o_orderkey, o_custkey FROM orders JOIN (SELECT o_custkey AS k, max(o_orderdate) AS d FROM orders GROUP BY 1)
    ON o_custkey = k AND o_orderdate = d""",
)
def _(t):
    return latest.latest_by_max(t.orders, ["o_custkey"], "o_orderdate").select("o_orderkey", "o_custkey")


@query("latest_global_max", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_shipdate IN (SELECT max(l_shipdate) FROM lineitem)")
def _(t):
    return latest.latest_day(t.lineitem, "l_shipdate").select("l_orderkey", "l_linenumber", "l_partkey")


@query("semi_join", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def _(t):
    buyers = t.events.where(F.col("event_type") == "purchase")
    return joins.semi(t.customer.select("c_custkey"), buyers, {"c_custkey": "user_id"})


@query(
    "correlated_max",
    with_roles("period_balance")
    + """ SELECT row_id FROM period_balance b WHERE b.batch_date IN (SELECT max(c.batch_date) FROM period_balance c
    WHERE b.account_id = c.account_id AND b.code = c.code AND b.period = c.period AND year(c.valid_to) = 1998)
    AND year(b.valid_to) = 1998""",
)
def _(t):
    in_year = F.year("valid_to") == 1998
    return latest.latest_by_max(t.period_balance, ["account_id", "code", "period"], "batch_date", where=in_year).select("row_id")


@query(
    "not_in_anti",
    """SELECT c_custkey FROM customer WHERE c_mktsegment NOT IN
    (SELECT c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9990 AND c_mktsegment IS NOT NULL)""",
)
def _(t):
    rich = t.customer.where((F.col("c_acctbal") > 9990) & ~text.is_blank("c_mktsegment")).select("c_mktsegment")
    return joins.anti(t.customer, rich, ["c_mktsegment"], null_safe=False).select("c_custkey")


@query(
    "not_in_anti_two",
    """SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS a, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS b FROM orders) AS o
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT CASE WHEN c_custkey % 400 <> 9 THEN c_custkey END AS x,
      CASE WHEN c_custkey % 400 <> 3 THEN CASE WHEN c_acctbal > 5000 THEN '1-URGENT' ELSE '5-LOW' END END AS y FROM customer WHERE c_custkey % 50 IN (3, 9)) AS l
      WHERE (o.a = l.x OR o.a IS NULL OR l.x IS NULL) AND (o.b = l.y OR o.b IS NULL OR l.y IS NULL))""",
)
def _(t):
    """(a, b) NOT IN (SELECT x, y ...) with NULLs in every column; the twin spells out what it means."""
    key, ours = F.col("c_custkey"), F.col("o_orderkey")
    rows = t.orders.select(
        "o_orderkey", F.when(ours % 7 != 0, F.col("o_custkey")).alias("a"), F.when(ours % 5 != 0, F.col("o_orderpriority")).alias("b")
    )
    word = F.when(F.col("c_acctbal") > 5000, "1-URGENT").otherwise("5-LOW")
    listed = t.customer.where((key % 50).isin(3, 9)).select(F.when(key % 400 != 9, key).alias("x"), F.when(key % 400 != 3, word).alias("y"))
    return joins.anti(rows, listed, {"a": "x", "b": "y"}, null_safe=False).select("o_orderkey")


@query(
    "left_is_null_anti",
    "SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM events) ON c_custkey = user_id WHERE user_id IS NULL",
)
def _(t):
    return joins.anti(t.customer, t.events, {"c_custkey": "user_id"}).select("c_custkey", "c_name")


@query(
    "share_of_total",
    """SELECT s.p, s.n, round(s.n * 100.0::DOUBLE / t.n, 4) AS pct, round(CAST(s.v AS DOUBLE) * 100 / CAST(t.v AS DOUBLE), 4) AS value_pct FROM
    (SELECT o_orderpriority AS p, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(26,4))) AS v FROM orders GROUP BY 1) s
    CROSS JOIN (SELECT count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(26,4))) AS v FROM orders) t""",
)
def _(t):
    parts = t.orders.groupBy(F.col("o_orderpriority").alias("p")).agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(26,4)")).alias("v")
    )
    whole = joins.with_totals(parts, {"tn": F.sum("n"), "tv": F.sum("v")})
    return whole.select(
        "p",
        "n",
        totals.share_of(F.col("n"), F.col("tn")).alias("pct"),
        totals.share_of(F.col("v"), F.col("tv")).alias("value_pct"),
    )


@query(
    "control_count",
    """WITH rec AS (SELECT c_nationkey, o_orderstatus AS form, count(*) AS cnt FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT n_nationkey, form, cnt FROM nation JOIN rec ON n_nationkey = c_nationkey WHERE form IS NOT NULL""",
)
def _(t):
    placed = joins.lookup(t.orders, t.customer, {"o_custkey": "c_custkey"}, {"c_nationkey": "n_nationkey"}, how="inner")
    counts = placed.groupBy("n_nationkey", F.col("o_orderstatus").alias("form")).agg(F.count("*").alias("cnt"))
    return t.nation.select("n_nationkey").join(counts.where(F.col("form").isNotNull()), "n_nationkey")


@query(
    "fallback_lookup",
    """WITH top AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
    fin AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    sole AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders GROUP BY 1 HAVING count(*) = 1)
    SELECT c_custkey, coalesce(top.k, fin.k, sole.k) AS k FROM customer LEFT JOIN top ON c_custkey = top.o_custkey
    LEFT JOIN fin ON c_custkey = fin.o_custkey LEFT JOIN sole ON c_custkey = sole.o_custkey""",
)
def _(t):
    keys = {"c_custkey": "o_custkey"}

    def newest(rows):
        return rows.groupBy("o_custkey").agg(F.max("o_orderkey").alias("k"))

    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")
    sole = latest.only_sole(orders.select("o_custkey", "o_orderkey"), ["o_custkey"])
    sources = [
        joins.Lookup(newest(orders.where(F.col("o_orderpriority") == "1-URGENT")), keys, ["k"]),
        joins.Lookup(newest(orders.where(F.col("o_orderstatus") == "F")), keys, ["k"]),
        joins.Lookup(sole, keys, ["o_orderkey"]),
    ]
    return joins.fallback_lookup(t.customer.select("c_custkey"), sources, ["k"])


@query(
    "self_join_related",
    """SELECT a.c_custkey, coalesce(b.c_name, a.c_name) AS c_name FROM
    (SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS rel FROM customer) a LEFT JOIN customer b ON a.rel = b.c_custkey""",
)
def _(t):
    rows = t.customer.select("c_custkey", "c_name", F.col("c_nationkey").cast("bigint").alias("rel"))
    return joins.self_related(rows, "c_custkey", "rel", ["c_name"]).drop("rel")


@query(
    "broadcast_lookup",
    "SELECT l_orderkey, l_linenumber, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity > 45",
)
def _(t):
    # no hint: the planner broadcasts by its own size estimate and shuffles beyond the threshold
    rows = t.lineitem.where(F.col("l_quantity") > 45).select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.lookup(rows, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_name"], how="inner").drop("l_suppkey")


@query(
    "scaffold_codes",
    """SELECT code, coalesce(n, 0) AS n FROM (VALUES ('1-URGENT'), ('5-LOW'), ('9-NONE')) v(code)
    LEFT JOIN (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1) ON code = p""",
)
def _(t):
    codes = sets.values_frame(t.spark, ["1-URGENT", "5-LOW", "9-NONE"], "code")
    facts = t.orders.groupBy(F.col("o_orderpriority").alias("code")).agg(F.count("*").alias("n"))
    return joins.scaffold(codes, facts, "code", {"n": F.lit(0).cast("bigint")})


# --- aggregations --------------------------------------------------------------------------


@query(
    "group_basic",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(26,4))) AS DECIMAL(38,4)) AS total,
    min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY 1, 2""",
)
def _(t):
    amount = F.col("o_totalprice").cast("decimal(26,4)")
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n"),
        F.sum(amount).cast(DEC).alias("total"),
        F.min("o_orderkey").alias("lo"),
        F.max("o_orderkey").alias("hi"),
    )


@query(
    "global_agg",
    """SELECT count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(26,4))) AS DECIMAL(38,4)) AS total,
    max(l_shipdate) AS last_day FROM lineitem""",
)
def _(t):
    amount = F.col("l_extendedprice").cast("decimal(26,4)")
    return t.lineitem.agg(
        F.count("*").alias("n"), F.sum(amount).cast(DEC).alias("total"), F.max("l_shipdate").alias("last_day")
    )


@query(
    "count_distinct_rows",
    """SELECT l_returnflag, l_linestatus, count(*) AS cnt FROM
    (SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey, l_quantity FROM lineitem) GROUP BY 1, 2""",
)
def _(t):
    rows = ["l_returnflag", "l_linestatus", "l_suppkey", "l_quantity"]
    return totals.count_distinct_rows(t.lineitem, rows, ["l_returnflag", "l_linestatus"])


@query("group_as_distinct", "SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem GROUP BY 1, 2, 3")
def _(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()




@query(
    "pivot_first",
    with_roles("period_balance")
    + """, one AS (SELECT account_id, code, amount FROM (SELECT *, row_number() OVER (PARTITION BY account_id, code
      ORDER BY batch_date DESC, row_id DESC) AS rn FROM period_balance) WHERE rn = 1),
    wide AS (SELECT account_id, CASE WHEN code = 'TotalFeeCollected' THEN amount END AS fee,
      CASE WHEN code = 'TotalInterestCollected' THEN amount END AS interest FROM one)
    SELECT account_id, first(fee) FILTER (WHERE fee IS NOT NULL) AS fee, first(interest) FILTER (WHERE interest IS NOT NULL) AS interest
    FROM wide GROUP BY account_id""",
)
def _(t):
    newest = [F.col("batch_date").desc(), F.col("row_id").desc()]
    rows = latest.latest_per_key(t.period_balance, ["account_id", "code"], newest).select(
        "account_id",
        F.when(F.col("code") == "TotalFeeCollected", F.col("amount")).alias("fee"),
        F.when(F.col("code") == "TotalInterestCollected", F.col("amount")).alias("interest"),
    )
    return pivot.pick_first(rows, ["account_id"], ["fee", "interest"])


@query(
    "pivot_case",
    """SELECT o_custkey, CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(26,4)) END) AS DECIMAL(38,4)) AS urgent,
    CAST(coalesce(sum(CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(26,4)) END), 0) AS DECIMAL(38,4)) AS low
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderpriority", F.col("o_totalprice").cast("decimal(26,4)").alias("v"))
    wide = pivot.pivot_codes(rows, ["o_custkey"], "o_orderpriority", "v", {"1-URGENT": "urgent", "5-LOW": "low"}, agg="sum")
    return wide.select(
        "o_custkey", F.col("urgent").cast(DEC).alias("urgent"), F.coalesce("low", F.lit(0)).cast(DEC).alias("low")
    )


@query(
    "pivot_latest",
    with_roles("period_balance")
    + """, one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id, code ORDER BY batch_date DESC, row_id DESC) AS rn FROM period_balance) WHERE rn = 1)
    SELECT account_id, max(amount) FILTER (WHERE code = 'TotalFeeCollected') AS fee, max(amount) FILTER (WHERE code = 'TotalInterestCollected') AS interest
    FROM one WHERE code IN ('TotalFeeCollected', 'TotalInterestCollected') GROUP BY account_id""",
)
def _(t):
    codes = {"TotalFeeCollected": "fee", "TotalInterestCollected": "interest"}
    return pivot.pivot_latest(t.period_balance, ["account_id"], "code", "amount", codes, ["batch_date", "row_id"])


@query(
    "pivot_map",
    with_roles("period_balance")
    + """ SELECT account_id, max(amount) FILTER (WHERE code = 'ForgivenDebt') AS debt,
    max(amount) FILTER (WHERE code = 'ForgivenInterest') AS interest
    FROM period_balance WHERE code IN ('ForgivenDebt', 'ForgivenInterest') GROUP BY account_id""",
)
def _(t):
    codes = {"ForgivenDebt": "debt", "ForgivenInterest": "interest"}
    return pivot.map_codes_to_columns(t.period_balance, ["account_id"], "code", "amount", codes)


@query(
    "pivot_tags",
    with_roles("org_unit")
    + """, x AS (SELECT unit_id, unnest(string_split(address_info, ',')) AS item FROM org_unit)
    SELECT unit_id, max(CASE WHEN split_part(item, '-', 1) = 'StreetName' THEN split_part(item, '-', 2) ELSE '' END) AS street,
    max(CASE WHEN split_part(item, '-', 1) = 'BuildingId' THEN split_part(item, '-', 2) ELSE '' END) AS building,
    max(CASE WHEN split_part(item, '-', 1) = 'BoxNumber' THEN split_part(item, '-', 2) ELSE '' END) AS box
    FROM x GROUP BY unit_id""",
)
def _(t):
    tags = {"StreetName": "street", "BuildingId": "building", "BoxNumber": "box"}
    return pivot.pivot_tags(t.org_unit, ["unit_id"], "address_info", tags)


@query(
    "two_level_agg",
    """SELECT o_custkey, max(s) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent, max(s) AS top FROM
    (SELECT o_custkey, o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(26,4))) AS DECIMAL(38,4)) AS s FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    per_code = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.sum(F.col("o_totalprice").cast("decimal(26,4)")).cast(DEC).alias("s")
    )
    urgent = F.max(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("s")))
    return per_code.groupBy("o_custkey").agg(urgent.alias("urgent"), F.max("s").alias("top"))


@query(
    "string_agg",
    """SELECT o_custkey, string_agg(p, ',' ORDER BY p) AS priorities FROM
    (SELECT DISTINCT o_custkey, o_orderpriority AS p FROM orders) GROUP BY 1""",
)
def _(t):
    rows = t.orders.select("o_custkey", F.col("o_orderpriority").alias("priorities"))
    return pivot.join_strings(rows, ["o_custkey"], "priorities", distinct=True)


@query(
    "totals_rollup",
    """SELECT o_orderstatus, o_orderpriority, CAST(grouping_id(o_orderstatus, o_orderpriority) AS BIGINT) AS level, count(*) AS n,
    CAST(sum(CAST(o_totalprice AS DECIMAL(26,4))) AS DECIMAL(38,4)) AS total FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
)
def _(t):
    sums = {"n": F.count("*"), "total": F.sum(F.col("o_totalprice").cast("decimal(26,4)")).cast(DEC)}
    return totals.rollup_totals(t.orders, ["o_orderstatus", "o_orderpriority"], sums)


@query(
    "filtered_totals",
    """WITH d AS (SELECT CAST(c_custkey AS VARCHAR) AS acct, c_mktsegment AS seg, CAST(c_acctbal AS DECIMAL(38,4)) AS bal FROM customer)
    SELECT acct, seg, bal, '0' AS dataordering FROM d UNION ALL SELECT 'Totals', '', CAST(sum(bal) AS DECIMAL(38,4)), '1' FROM d
    UNION ALL SELECT 'Building', '', CAST(sum(bal) AS DECIMAL(38,4)), '2' FROM d WHERE seg = 'BUILDING'
    UNION ALL SELECT 'All Others', '', CAST(sum(bal) AS DECIMAL(38,4)), '3' FROM d WHERE seg <> 'BUILDING'""",
)
def _(t):
    rows = t.customer.select(
        F.col("c_custkey").cast("string").alias("acct"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").cast(DEC).alias("bal")
    )
    labels = {"Totals": None, "Building": F.col("seg") == "BUILDING", "All Others": F.col("seg") != "BUILDING"}
    return totals.with_totals_rows(rows, ["bal"], "acct", labels)


@query(
    "sum_text",
    """SELECT l_returnflag, CAST(sum(TRY_CAST(x AS DECIMAL(26,4))) AS DECIMAL(26,4)) AS total FROM
    (SELECT l_returnflag, CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE '' END AS x FROM lineitem) GROUP BY 1""",
)
def _(t):
    words = F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("bigint").cast("string")).otherwise("")
    return t.lineitem.select("l_returnflag", words.alias("x")).groupBy("l_returnflag").agg(text.sum_text("x").alias("total"))


@query(
    "control_totals",
    """SELECT 'orders' AS description, CAST(count(*) AS VARCHAR) AS cnt, 1 AS ord FROM orders
    UNION ALL SELECT 'open value', CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(26,4))) FILTER (WHERE o_orderstatus = 'O') AS DECIMAL(17,2)) AS VARCHAR), 2 FROM orders
    UNION ALL SELECT 'status ' || o_orderstatus, CAST(count(*) AS VARCHAR), 3 FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT 'lines', CAST(count(*) AS VARCHAR), 4 FROM lineitem""",
)
def _(t):
    orders = t.orders
    status = orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    value = F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice").cast("decimal(26,4)"))).cast("decimal(17,2)")
    return totals.metric_rows(
        [
            ("orders", orders, F.count("*"), 1),
            ("open value", orders, value, 2),
            (F.concat(F.lit("status "), F.col("o_orderstatus")), status, F.col("n"), 3),
            ("lines", t.lineitem, F.count("*"), 4),
        ]
    )


# --- windows -------------------------------------------------------------------------------


@query(
    "latest_row",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1""",
)
def _(t):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return latest.latest_per_key(t.orders, ["o_custkey"], order).select("o_custkey", "o_orderkey")


@query(
    "latest_row_multi",
    with_roles("loan_rate")
    + """ SELECT account_id, booked_on, accrual_factor FROM (SELECT *, row_number() OVER (PARTITION BY account_id
    ORDER BY CASE charge_type WHEN 'DebitInterest' THEN 0 ELSE 1 END, booked_on DESC, accrual_factor DESC NULLS LAST) AS rn FROM loan_rate) WHERE rn = 1""",
)
def _(t):
    rank = F.when(F.col("charge_type") == "DebitInterest", 0).otherwise(1)
    order = [rank, F.col("booked_on").desc(), F.col("accrual_factor").desc_nulls_last()]
    return latest.latest_per_key(t.loan_rate, ["account_id"], order).select("account_id", "booked_on", "accrual_factor")


@query(
    "previous_row",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderdate < DATE '1998-07-28') WHERE rn = 1""",
)
def _(t):
    before = F.col("o_orderdate") < F.lit("1998-07-28").cast("timestamp_ntz")
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return latest.previous_row(t.orders, ["o_custkey"], order, before).select("o_custkey", "o_orderkey")


@query(
    "second_latest_row",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 2""",
)
def _(t):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return latest.latest_per_key(t.orders, ["o_custkey"], order, n=2).select("o_custkey", "o_orderkey")


@query(
    "dense_rank_ties",
    with_roles("loan_counter")
    + """ SELECT account_id, code, period, counter, day FROM (SELECT *, dense_rank() OVER (PARTITION BY account_id, code ORDER BY day DESC) AS r
    FROM loan_counter) WHERE r <= 2""",
)
def _(t):
    return latest.latest_days(t.loan_counter, ["account_id", "code"], "day", 2).select("account_id", "code", "period", "counter", "day")


@query(
    "max_over",
    "SELECT o_orderkey, o_custkey, max(o_orderdate) OVER (PARTITION BY o_custkey) AS newest FROM orders",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return latest.with_partition_max(rows, ["o_custkey"], "o_orderdate", "newest").drop("o_orderdate")


@query(
    "count_over",
    """SELECT l_orderkey, l_shipdate, l_partkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_shipdate) AS n FROM lineitem) WHERE n = 1""",
)
def _(t):
    return latest.only_sole(t.lineitem.select("l_orderkey", "l_shipdate", "l_partkey"), ["l_orderkey", "l_shipdate"])


@query(
    "paginate",
    """SELECT o_orderkey, o_custkey, CAST(ceil(row_number() OVER (ORDER BY o_custkey, o_orderkey) / 10.0) AS BIGINT) AS pagenbr FROM orders""",
)
def _(t):
    return paging.paginate(t.orders.select("o_orderkey", "o_custkey"), [F.col("o_custkey"), F.col("o_orderkey")], 10)


@query(
    "lag_previous",
    """SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS before FROM orders""",
)
def _(t):
    """Five keys for all rows: by ranges that hand on their last row."""
    rows = latest.lag_carried(t.orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "o_totalprice", "before")
    return rows.select("o_orderkey", "before")


@query(
    "lag_in_months",
    """SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders""",
)
def _(t):
    """Many keys: by month, the last value of each handed on to the next."""
    month = F.date_trunc("month", F.col("o_orderdate"))
    rows = latest.lag_in_buckets(t.orders, ["o_custkey"], month, ["o_orderdate", "o_orderkey"], "o_totalprice", "before")
    return rows.select("o_orderkey", "before")
