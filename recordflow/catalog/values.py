"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.catalog.registry import query
from recordflow.catalog.roles import with_roles
from recordflow.functions import dates, jsons, text
from recordflow.operators import pivot


@query(
    "implied_decimal",
    """SELECT l_orderkey, l_linenumber, replace(CAST(CAST(coalesce(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END, 0) AS DECIMAL(26,4)) AS VARCHAR), '.', '') AS amount,
    replace(CAST(CAST(l_discount AS DECIMAL(14,10)) AS VARCHAR), '.', '') AS rate FROM lineitem""",
)
def _(t):
    open_amount = F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        text.implied_decimal(open_amount).alias("amount"),
        text.implied_decimal("l_discount", 14, 10).alias("rate"),
    )


@query(
    "string_concat",
    with_roles("customer_master")
    + """ SELECT customer_id, name_line || '-' || customer_id AS label, concat_ws(',', nullif(line1, ''), city, state) AS address,
    concat_ws(' ', home_phone, mobile_phone) AS phones FROM customer_master""",
)
def _(t):
    return t.customer_master.select(
        "customer_id",
        F.concat("name_line", F.lit("-"), "customer_id").alias("label"),
        text.join_nonblank(["line1", "city", "state"]).alias("address"),
        F.concat_ws(" ", "home_phone", "mobile_phone").alias("phones"),
    )


@query(
    "substr_year",
    with_roles("period_balance")
    + " SELECT row_id, substr(full_date, 1, 4) AS y, substr(full_date, 5, 2) AS m, length(full_date) AS n FROM period_balance",
)
def _(t):
    return t.period_balance.select(
        "row_id",
        F.substring("full_date", 0, 4).alias("y"),
        F.substring("full_date", 5, 2).alias("m"),
        F.length("full_date").cast("bigint").alias("n"),
    )


@query(
    "first_last_token",
    with_roles("org_unit")
    + """ SELECT unit_id, split_part(address_info, ',', 1) AS head, split_part(address_info, ',', -1) AS tail,
    CASE WHEN strpos(unit_name, ',') > 0 THEN split_part(unit_name, ',', -1) ELSE '' END AS none_left,
    CAST(strpos(address_info, ',') AS BIGINT) AS at, reverse(unit_name) AS backwards FROM org_unit""",
)
def _(t):
    return t.org_unit.select(
        "unit_id",
        text.first_token("address_info").alias("head"),
        text.last_token("address_info").alias("tail"),
        text.last_token("unit_name").alias("none_left"),
        F.locate(",", "address_info").cast("bigint").alias("at"),
        F.reverse("unit_name").alias("backwards"),
    )


@query("case_fold", "SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low FROM part WHERE upper(p_type) = 'ECONOMY'")
def _(t):
    return t.part.where(F.upper("p_type") == "ECONOMY").select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low")
    )


@query(
    "clean_text",
    with_roles("org_unit")
    + """ SELECT unit_id, regexp_replace(unit_name, '[0-9]+', '#', 'g') AS masked, replace(replace(business_phone, '-', ''), ' ', '') AS phone,
    translate(unit_name, 'NA_', 'na ') AS swapped FROM org_unit""",
)
def _(t):
    return t.org_unit.select(
        "unit_id",
        F.regexp_replace("unit_name", "[0-9]+", "#").alias("masked"),
        text.strip_chars("business_phone", "- ").alias("phone"),
        F.translate("unit_name", "NA_", "na ").alias("swapped"),
    )


@query(
    "split_token",
    "SELECT p_partkey, string_split(p_name, ' ')[1] AS t0, string_split(p_name, ' ')[2] AS t1, string_split(p_name, ' ')[6] AS t5 FROM part",
)
def _(t):
    return t.part.select("p_partkey", *[text.token("p_name", " ", i).alias(f"t{i}") for i in (0, 1, 5)])


@query(
    "title_lines",
    with_roles("loan_account")
    + """, x AS (SELECT account_id, title FROM loan_account UNION ALL SELECT 'flat-' || account_id, replace(title, chr(10), ' ') FROM loan_account)
    SELECT account_id, """
    + ", ".join(
        f"CASE WHEN strpos(title, chr(10)) > 0 THEN substr(string_split(title, chr(10))[{i + 1}], 1, 60) ELSE substr(title, {i * 60 + 1}, 60) END AS line{i + 1}"
        for i in range(4)
    )
    + " FROM x",
)
def _(t):
    rows = t.loan_account.select("account_id", "title")
    flat = rows.select(F.concat(F.lit("flat-"), "account_id").alias("account_id"), F.replace("title", F.lit("\n"), F.lit(" ")).alias("title"))
    lines = text.title_lines("title")
    return rows.union(flat).select("account_id", *[line.alias(f"line{i + 1}") for i, line in enumerate(lines)])


@query(
    "explode_list",
    with_roles("loan_statement") + " SELECT account_id, trim(unnest(string_split(notify_mode, ','))) AS mode FROM loan_statement",
)
def _(t):
    rows = t.loan_statement.select("account_id", "notify_mode")
    return pivot.explode_list(rows, "notify_mode", ",", "mode").select("account_id", F.trim("mode").alias("mode"))


@query(
    "posexplode_list",
    with_roles("org_unit")
    + """ SELECT unit_id, CAST(p - 1 AS BIGINT) AS pos, string_split(address_info, ',')[p] AS item
    FROM (SELECT *, unnest(range(1, len(string_split(address_info, ',')) + 1)) AS p FROM org_unit)""",
)
def _(t):
    return pivot.explode_list(t.org_unit, "address_info", ",", "item", pos="pos").select("unit_id", "pos", "item")


@query(
    "json_field",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS gone FROM events",
)
def _(t):
    return t.events.select(
        "event_id", jsons.json_field("props", "$.k").alias("k"), jsons.json_field("props", "$.none").alias("gone")
    )


@query(
    "json_computed_path",
    with_roles("loan_account")
    + """ SELECT account_id, json_extract_string(payment_frequency, '$.pmtFreq[' || (length(account_id) + ascii(right(account_id, 1))) % 3 || '].typ') AS typ,
    json_extract_string(payment_frequency, '$.pmtFreq[' || ascii(right(account_id, 1)) % 2 || '].' || CASE WHEN ascii(right(account_id, 1)) % 5 = 0 THEN 'none' ELSE 'val' END) AS picked,
    json_extract_string(payment_frequency, '$.gone.deeper[0]') AS gone FROM loan_account""",
)
def _(t):
    """Paths made from columns: some positions and names lead nowhere."""
    last = F.ascii(F.right("account_id", F.lit(1)))
    rows = t.loan_account.select("account_id", jsons.variant("payment_frequency").alias("v"))
    place = jsons.variant_path("pmtFreq", (F.length("account_id") + last) % 3, "typ")
    picked = jsons.variant_path("pmtFreq", last % 2, F.when(last % 5 == 0, "none").otherwise("val"))
    return rows.select(
        "account_id",
        jsons.variant_field("v", place).alias("typ"),
        jsons.variant_field("v", picked).alias("picked"),
        jsons.variant_field("v", "$.gone.deeper[0]").alias("gone"),
    )


@query(
    "json_variant_rows",
    with_roles("loan_account")
    + """ SELECT account_id, CAST(i AS BIGINT) AS pos, json_extract_string(payment_frequency, '$.pmtFreq[' || i || '].balTyp') AS "balTyp",
    json_extract_string(payment_frequency, '$.pmtFreq[' || i || '].val') AS val, json_extract_string(payment_frequency, '$.pmtFreq[' || i || '].none') AS "none"
    FROM loan_account, (VALUES (0), (1)) v(i)
    WHERE ascii(right(account_id, 1)) % 4 <> 0 AND json_type(payment_frequency, '$.pmtFreq[' || i || ']') IS NOT NULL""",
)
def _(t):
    """Elements of an array whose name comes from a column, without a declared schema."""
    name = F.when(F.ascii(F.right("account_id", F.lit(1))) % 4 == 0, "missing").otherwise("pmtFreq")
    rows = t.loan_account.select("account_id", jsons.variant("payment_frequency").alias("v"))
    kinds = {"balTyp": "string", "val": "string", "none": "string"}
    return jsons.variant_rows(rows, "v", jsons.variant_path(name), kinds).drop("key")


@query(
    "json_array_rows",
    with_roles("loan_account")
    + """ SELECT account_id, CAST(i AS BIGINT) AS pos, json_extract_string(payment_frequency, '$.pmtFreq[' || i || '].balTyp') AS "balTyp",
    json_extract_string(payment_frequency, '$.pmtFreq[' || i || '].typ') AS typ, json_extract_string(payment_frequency, '$.pmtFreq[' || i || '].val') AS val
    FROM loan_account, (VALUES (0), (1)) v(i)""",
)
def _(t):
    item = T.StructType([T.StructField(n, T.StringType()) for n in ("balTyp", "typ", "val")])
    return jsons.json_rows(t.loan_account.select("account_id", "payment_frequency"), "payment_frequency", "pmtFreq", item, pos="pos")


@query(
    "date_reformat",
    with_roles("loan_balance")
    + """ SELECT account_id, full_date, strftime(strptime(full_date, '%Y%m%d'), '%Y-%m-%d') AS iso, strftime(day, '%m-%d-%Y') AS us,
    strftime(day, '%m%d%Y') AS packed, '' AS bad FROM loan_balance""",
)
def _(t):
    return t.loan_balance.select(
        "account_id",
        "full_date",
        dates.reformat_date("full_date", "yyyyMMdd", "yyyy-MM-dd").alias("iso"),
        dates.report_date("day").alias("us"),
        F.date_format("day", "MMddyyyy").alias("packed"),
        dates.reformat_date("full_date", "yyyy-MM-dd", "MM-dd-yyyy", on_error="blank").alias("bad"),
    )


@query(
    "date_math",
    """SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER) AS apart, CAST(o_orderdate AS DATE) + 45 AS later,
    CAST(o_orderdate AS DATE) - 1 AS before, CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS last_year,
    CAST(date_trunc('year', o_orderdate) AS DATE) AS first_day, last_day(CAST(o_orderdate AS DATE)) AS month_end, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders""",
)
def _(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.date_diff(F.lit("2001-12-31").cast("date"), day).alias("apart"),
        F.date_add(day, 45).alias("later"),
        F.date_sub(day, 1).alias("before"),
        F.add_months(day, -12).alias("last_year"),
        dates.year_start(day).alias("first_day"),
        F.last_day(day).alias("month_end"),
        F.year(day).alias("y"),
    )


@query(
    "epoch_day",
    """SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS n, CAST(o_orderdate AS DATE) AS back FROM orders""",
)
def _(t):
    return t.orders.select("o_orderkey", dates.to_epoch_day("o_orderdate").alias("n")).withColumn("back", dates.from_epoch_day("n"))


@query(
    "year_bounds",
    """SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) AS first, make_date(year(o_orderdate), 12, 31) AS last,
    make_date(year(o_orderdate) - 1, 12, 31) AS prior_end, make_date(year(o_orderdate) - 1, 1, 1) AS prior_start FROM orders""",
)
def _(t):
    first, last = dates.year_bounds("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        first.alias("first"),
        last.alias("last"),
        dates.prior_year_end("o_orderdate").alias("prior_end"),
        dates.prior_year_start("o_orderdate").alias("prior_start"),
    )


@query(
    "age_years",
    with_roles("customer_master")
    + """ SELECT customer_id, CAST(year(DATE '2001-03-10') - year(birth_date)
    - CASE WHEN strftime(birth_date, '%m%d') > '0310' THEN 1 ELSE 0 END AS INTEGER) AS age FROM customer_master""",
)
def _(t):
    return t.customer_master.select("customer_id", dates.age_on(F.lit("2001-03-10"), "birth_date").alias("age"))


@query(
    "math_ops",
    """SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(26,4)), 1) AS DECIMAL(26,1)) AS r, CAST(ceil(o_totalprice / 10) AS BIGINT) AS c,
    CAST(abs(CAST(5000 - o_totalprice AS DECIMAL(26,4))) AS DECIMAL(26,4)) AS a FROM orders""",
)
def _(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.round(price.cast("decimal(26,4)"), 1).cast("decimal(26,1)").alias("r"),
        F.ceil(price / 10).cast("bigint").alias("c"),
        F.abs((5000 - price).cast("decimal(26,4)")).alias("a"),
    )


@query(
    "format_amount",
    """SELECT o_orderkey, format('{:,.2f}', CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DOUBLE)) AS shown,
    coalesce(CASE WHEN o_orderstatus = 'F' THEN format('{:,.4f}', CAST(CAST(o_totalprice AS DECIMAL(17,4)) AS DOUBLE)) END, '0.00') AS shown4 FROM orders""",
)
def _(t):
    finished = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    return t.orders.select(
        "o_orderkey", text.format_amount("o_totalprice").alias("shown"), text.format_amount(finished, 4).alias("shown4")
    )


@query(
    "days_ahead",
    with_roles("loan_bill")
    + " SELECT account_id, CAST(abs(date_diff('day', paid_on, due_on)) AS VARCHAR) AS days FROM loan_bill WHERE bill_status = 'Paid'",
)
def _(t):
    paid = t.loan_bill.where(F.col("bill_status") == "Paid")
    return paid.select("account_id", dates.days_apart("due_on", "paid_on").cast("string").alias("days"))


@query(
    "open_hours",
    with_roles("open_hours")
    + """, g AS (SELECT unit_id, starts_at, ends_at, min(day_nbr) AS lo, max(day_nbr) AS hi, count(*) AS n, min_by(day_name, day_nbr) AS a,
    max_by(day_name, day_nbr) AS b FROM open_hours GROUP BY ALL)
    SELECT unit_id, string_agg(CASE WHEN lo < hi THEN a || ' to ' || b ELSE a END || ' - ' || starts_at || ' to ' || ends_at, ','
      ORDER BY CASE WHEN lo < hi THEN a || ' to ' || b ELSE a END || ' - ' || starts_at || ' to ' || ends_at) AS hours FROM g GROUP BY unit_id""",
)
def _(t):
    from recordflow.plans.reports.statements import opening_hours

    return opening_hours(t.open_hours)
