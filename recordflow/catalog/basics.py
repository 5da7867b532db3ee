"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.catalog.registry import query
from recordflow.catalog.roles import with_roles
from recordflow.functions import dates, text
from recordflow.operators import filters, sets
from recordflow.sources import events, tables


@query(
    "key_prefix",
    with_roles("party_rows")
    + " SELECT split_part(customer_id, '_', 1) AS domain, count(*) AS n FROM party_rows GROUP BY 1",
)
def _(t):
    return t.party_rows.groupBy(events.domain_partition("customer_id").alias("domain")).agg(F.count("*").alias("n"))


@query(
    "rename_replace",
    """SELECT o_orderkey, strftime(DATE '1970-01-01' + CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT), '%Y-%m-%d') AS logical_date
    FROM orders""",
)
def _(t):
    days = t.orders.select("o_orderkey", dates.to_epoch_day("o_orderdate").alias("logical_date"))
    return events.date_text(days)


@query("copy_columns", "SELECT n_nationkey, n_regionkey, n_name, n_regionkey AS x_n_regionkey FROM nation")
def _(t):
    return tables.copy_columns(t.nation, ["n_regionkey"])


@query(
    "filter_between",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND o_totalprice > 1000 AND o_orderstatus = 'F'""",
)
def _(t):
    low, high = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz")
    return t.orders.where(
        F.col("o_orderdate").between(low, high) & (F.col("o_totalprice") > 1000) & (F.col("o_orderstatus") == "F")
    ).select("o_orderkey", "o_totalprice")


@query(
    "filter_like",
    "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt%' OR p_type LIKE '%ECON%'",
)
def _(t):
    test = text.any_like("p_name", ["red%", "%bolt%"]) | text.any_like("p_type", ["%ECON%"])
    return t.part.where(test).select("p_partkey", "p_name")


@query("filter_in", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def _(t):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey")


@query(
    "null_blank",
    with_roles("customer_master")
    + """ SELECT customer_id, home_phone IS NULL AS no_home, line1 IS NULL OR line1 = '' AS no_line,
    nullif(line1, '') AS line1 FROM customer_master WHERE city IS NOT NULL""",
)
def _(t):
    return t.customer_master.where(F.col("city").isNotNull()).select(
        "customer_id",
        F.col("home_phone").isNull().alias("no_home"),
        text.is_blank("line1").alias("no_line"),
        F.nullif(F.col("line1"), F.lit("")).alias("line1"),
    )


@query("param_filter_all", with_roles("loan_account") + " SELECT account_id, branch_id FROM loan_account")
def _(t):
    rows = filters.param_filter(t.loan_account, "branch_id", filters.ALL)
    return filters.param_filter(rows, "currency", "", blank_is_all=True).select("account_id", "branch_id")


@query(
    "param_filter_some",
    with_roles("loan_account")
    + """ SELECT account_id, branch_id, collateral_code FROM loan_account
    WHERE coalesce(branch_id, '') IN ('3', '7', '11') AND coalesce(collateral_code, '') IN ('', 'Vehicle')""",
)
def _(t):
    rows = filters.param_filter(t.loan_account, "branch_id", "3,7,11")
    return filters.param_filter(rows, "collateral_code", ",Vehicle").select("account_id", "branch_id", "collateral_code")


@query(
    "param_filter_wide",
    """SELECT o_orderkey, k FROM (SELECT o_orderkey, nullif(o_custkey, 8) AS k FROM orders)
    WHERE k IS NULL OR (k % 2 = 1 AND k BETWEEN 1 AND 2999)""",
)
def _(t):
    rows = t.orders.select("o_orderkey", F.nullif(F.col("o_custkey"), F.lit(8)).alias("k"))
    return filters.param_filter(rows, "k", ",".join(["", *map(str, range(1, 3000, 2))]))


@query(
    "case_map",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN '00' WHEN 'FURNITURE' THEN '01' ELSE '' END AS code,
    CASE WHEN c_acctbal < 0 THEN 'Y' WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END AS flag FROM customer""",
)
def _(t):
    flag = F.when((F.col("c_acctbal") < 0) | (F.col("c_acctbal") > 5000), "Y").otherwise("N")
    code = text.map_codes("c_mktsegment", {"MACHINERY": "00", "FURNITURE": "01"}, "")
    return t.customer.select("c_custkey", code.alias("code"), flag.alias("flag"))


@query(
    "mask_flagged",
    with_roles("loan_account")
    + " SELECT account_id, CASE WHEN employee_flag = 'Y' THEN 'XXXXXXXX' ELSE customer_id END AS customer_id FROM loan_account",
)
def _(t):
    masked = text.mask_if(F.col("employee_flag") == "Y", "customer_id")
    return t.loan_account.select("account_id", masked.alias("customer_id"))


@query(
    "post_agg_filter",
    """SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(26,4)) END) AS DECIMAL(38,4)) AS paid
    FROM orders GROUP BY o_custkey HAVING sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(26,4)) END) > 0""",
)
def _(t):
    amount = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(26,4)"))
    sums = t.orders.groupBy("o_custkey").agg(F.sum(amount).cast("decimal(38,4)").alias("paid"))
    return filters.keep_any_positive(sums, ["paid"])


_SEASON = """, (CASE n_regionkey WHEN 0 THEN 'Seasonal' WHEN 1 THEN 'Temporary' WHEN 2 THEN NULL ELSE 'Permanent' END) AS category,
    CAST(o_orderdate AS DATE) AS strt, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 200 END AS stop,
    CASE WHEN o_orderstatus = 'O' THEN '0401' ELSE '0801' END AS s1, CASE WHEN o_orderstatus = 'O' THEN '0630' ELSE '1231' END AS s2
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"""


@query(
    "validity_window",
    "SELECT o_orderkey FROM (SELECT o_orderkey"
    + _SEASON.replace("{", "").replace("}", "")
    + """) WHERE (coalesce(category, '') <> 'Seasonal' AND strt <= DATE '1998-06-15' AND (stop >= DATE '1998-06-15' OR stop IS NULL))
    OR (coalesce(category, '') = 'Seasonal' AND 615 BETWEEN CAST(s1 AS INT) AND CAST(s2 AS INT))""",
)
def _(t):
    rows = t.spark.sql("SELECT o_orderkey" + _SEASON, orders=t.orders, customer=t.customer, nation=t.nation)
    day = F.lit("1998-06-15").cast("date")
    return rows.where(dates.address_valid_on(day, "category", "strt", "stop", "s1", "s2")).select("o_orderkey")


@query(
    "valid_as_of",
    with_roles("period_balance")
    + " SELECT row_id, account_id FROM period_balance WHERE DATE '1999-07-28' BETWEEN valid_from AND valid_to",
)
def _(t):
    return filters.valid_as_of(t.period_balance, "1999-07-28", "valid_from", "valid_to").select("row_id", "account_id")


@query("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def _(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "date_range",
    """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-04-15' GROUP BY 1""",
)
def _(t):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("day"))
    return filters.date_range_filter(days, "day", "1997-03-01", "1997-04-15").groupBy("day").agg(F.count("*").alias("n"))


@query("sorted_output", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def _(t):
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return rows.orderBy("c_mktsegment", F.col("c_acctbal").desc(), "c_custkey")


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return tables.inspect(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20)[2]


@query(
    "union_all",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def _(t):
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return a.union(t.supplier.select("s_name", "s_nationkey"))


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
)
def _(t):
    return sets.union_distinct(
        t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation"))
    )


@query(
    "sentinel_row",
    """SELECT 'ZZZZZZ-ZZZZZZZ' AS filter_val UNION
    SELECT CAST(o_orderkey AS VARCHAR) || '-DetailedStatement' FROM orders WHERE o_orderstatus = 'F'""",
)
def _(t):
    keys = t.orders.where(F.col("o_orderstatus") == "F").select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit("-DetailedStatement")).alias("filter_val")
    )
    return sets.with_sentinel_row(keys, "filter_val", "ZZZZZZ-ZZZZZZZ")


@query(
    "union_by_name",
    "SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer",
)
def _(t):
    return sets.union_by_name(
        t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id")),
    )




@query(
    "active_plus_closed",
    with_roles("deposit_account", "deposit_balance")
    + """, p AS (SELECT account_id, CAST(sum(CASE WHEN code = 'InterestPaidBalance' THEN amount END) AS DECIMAL(38,4)) AS a,
      CAST(sum(CASE WHEN code = 'FederalTaxPaid' THEN amount END) AS DECIMAL(38,4)) AS b FROM deposit_balance
      WHERE code IN ('InterestPaidBalance', 'FederalTaxPaid') AND valid_from = DATE '1998-01-01' GROUP BY account_id)
    SELECT x.account_id, x.status, p.a AS interest, p.b AS tax FROM deposit_account x LEFT JOIN p ON x.account_id = p.account_id
    WHERE upper(x.status) = 'ACTIVE'
    UNION ALL
    SELECT x.account_id, x.status, p.a, p.b FROM deposit_account x JOIN p ON x.account_id = p.account_id
    WHERE upper(x.status) <> 'ACTIVE' AND x.closed_on BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' AND (p.a > 0 OR p.b > 0)""",
)
def _(t):
    from recordflow.operators.pivot import pivot_codes

    year = t.deposit_balance.where(F.col("valid_from") == F.lit("1998-01-01").cast("date"))
    totals = pivot_codes(
        year, ["account_id"], "code", "amount", {"InterestPaidBalance": "interest", "FederalTaxPaid": "tax"}, agg="sum"
    )
    totals = totals.withColumns({c: F.col(c).cast("decimal(38,4)") for c in ("interest", "tax")})
    period = F.col("closed_on").between(F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date"))
    accounts = t.deposit_account.select("account_id", "status", "closed_on")
    rows = sets.active_plus_closed(
        accounts, totals, "account_id", F.upper("status") == "ACTIVE", period, ["interest", "tax"]
    )
    return rows.drop("closed_on")
