"""Statement masters of deposits over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.catalog.registry import query
from recordflow.catalog.roles import ROLES, duck_dialect, with_roles
from recordflow.plans.reports import masters
from recordflow.session import scratch_path
from recordflow.sources import tables

RUN_DATE = "1998-12-31"
_D = "DATE '1998-12-31'"
CELLS = {
    ("ytd", "InterestPaidBalance"): "interest_paid_ytd",
    ("prior_year", "InterestPaidBalance"): "interest_paid_prior_year",
    ("ytd", "FederalTaxPaid"): "withheld_ytd",
    ("period", "InterestPaidBalance"): "interest_paid_period",
    ("prior_period", "FATCATaxPaid"): "fatca_prior_period",
    ("period", "FATCATaxPaid"): "average_fatca_period",
}
AVERAGES = ["FATCATaxPaid"]

# --- back-fill -----------------------------------------------------------------------------


@query(
    "report_master_backfill",
    with_roles("deposit_account")
    + """, m AS (SELECT *, DATE '1998-06-03' AS day FROM deposit_account), staged AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS account_id FROM events)
    SELECT * FROM m UNION ALL SELECT m.* REPLACE (DATE '1998-06-04' AS day) FROM m LEFT JOIN staged s ON m.account_id = s.account_id WHERE s.account_id IS NULL""",
)
def _(t):
    """Stage a copy, append the rows that are not staged, read the master again."""
    path, staging = scratch_path(t.spark, "master"), scratch_path(t.spark, "staged")
    master = t.deposit_account.withColumn("day", F.lit("1998-06-03").cast("date"))
    master.write.parquet(path)
    staged = tables.copy_table(t.events.select(F.col("user_id").cast("string").alias("account_id")), staging)
    stored = t.spark.read.schema(master.schema).parquet(path)
    rows = masters.backfill(stored, staged, {"day": F.lit("1998-06-04").cast("date")})
    tables.insert_into(rows, path)
    return t.spark.read.schema(master.schema).parquet(path)


# --- orphans and classes -------------------------------------------------------------------

_ORPHANS = f""", orphans AS (SELECT group_id, group_role, day, account_id, ledger_id FROM statement_detail WHERE day = {_D} AND group_id <> '' AND group_id NOT IN
    (SELECT group_id FROM statement_detail WHERE day = {_D} AND group_id <> '' AND group_id IS NOT NULL AND lower(group_role) = 'primary'))"""


@query("report_orphan_groups", with_roles("statement_detail") + _ORPHANS + " SELECT * FROM orphans")
def _(t):
    return masters.orphan_groups(t.statement_detail, RUN_DATE)


@query(
    "report_statement_class",
    with_roles("statement_detail")
    + _ORPHANS
    + """ SELECT account_id, group_id, CAST(CASE WHEN group_id IS NULL OR group_id = '' THEN 1 WHEN group_id IN (SELECT group_id FROM orphans) THEN 1 ELSE 2 END AS INTEGER) AS stmnt FROM statement_detail""",
)
def _(t):
    rows = masters.classify(t.statement_detail, masters.orphan_groups(t.statement_detail, RUN_DATE))
    return rows.select("account_id", "group_id", "stmnt")


# --- master record -------------------------------------------------------------------------


def _accounts(t):
    plan = F.when(F.col("family") == "TimeDeposit", F.concat(F.lit("P"), "branch_id")).otherwise("")
    return t.deposit_account.withColumn("plan_id", plan)


def _balances(t):
    period = F.when(F.col("period") == "LifeToDate", "Statement").otherwise(F.col("period"))
    return t.deposit_balance.withColumns({"period": period, "average_amount": (F.col("amount") * 2).cast("decimal(26,4)")})


def _attributes(t):
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "CalType")
        .when(F.col("o_orderpriority") == "2-HIGH", "APY")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "BlendedAPY")
        .otherwise("Unused")
    )
    value = F.when(F.col("o_orderstatus") == "F", "Flat").when(F.col("o_orderstatus") == "O", "True").otherwise("x")
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("account_id"),
        kind.alias("attr_type"),
        value.alias("attr_value"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderkey").alias("row_id"),
    )


def _driver(t):
    orphans = masters.orphan_groups(t.statement_detail, RUN_DATE)
    return masters.statement_driver(t.statement_detail, orphans, _accounts(t), RUN_DATE)


def _base_sql(role: str, cells: dict[tuple[str, str], str], averages: list[str]) -> str:
    averaged = ", ".join(f"'{c}'" for c in averages)
    return _BASE_PARTS[0].replace("deposit_balance", role).replace("b.code = 'FATCATaxPaid'", f"b.code IN ({averaged})") + (
        ", ".join(f"max(v) FILTER (WHERE win = '{w}' AND code = '{c}') AS {n}" for (w, c), n in cells.items())
        + " FROM one WHERE "
        + " OR ".join(f"(win = '{w}' AND code = '{c}')" for w, c in cells)
        + _BASE_PARTS[1]
    ).replace("deposit_balance", role)


_BASE_PARTS = (
    with_roles("statement_detail", "deposit_account", "deposit_balance", "deposit_daily", "relation", "preference", "customer_master")
    + _ORPHANS
    + """, acc AS (SELECT *, CASE WHEN family = 'TimeDeposit' THEN 'P' || branch_id ELSE '' END AS plan_id FROM deposit_account),
  main AS (SELECT plan_id, min(account_id) AS main_id FROM acc WHERE plan_id <> '' GROUP BY 1),
  s0 AS (SELECT DISTINCT d.*, CAST(CASE WHEN d.group_id IS NULL OR d.group_id = '' THEN 1 WHEN d.group_id IN (SELECT group_id FROM orphans) THEN 1 ELSE 2 END AS INTEGER) AS stmnt FROM statement_detail d WHERE d.day = DATE '1998-12-31'),
  s1 AS (SELECT s0.*, period_start - 1 AS before_start, period_end - 1 AS before_end, make_date(year(period_end), 12, 31) AS year_end, make_date(year(period_end) - 1, 12, 31) AS prior_year_end,
    a.plan_id, a.family, a.title, a.branch_id, a.status, a.closed_on, coalesce(m.main_id, s0.account_id) AS related_id
    FROM s0 LEFT JOIN acc a ON s0.account_id = a.account_id LEFT JOIN main m ON s0.stmnt = 1 AND a.plan_id <> '' AND a.plan_id = m.plan_id),
  drv AS (SELECT s1.* REPLACE (coalesce(r.opening_balance, s1.opening_balance) AS opening_balance, coalesce(r.closing_balance, s1.closing_balance) AS closing_balance,
      coalesce(r.interest_earned, s1.interest_earned) AS interest_earned, coalesce(r.period_start, s1.period_start) AS period_start, coalesce(r.period_end, s1.period_end) AS period_end,
      coalesce(r.before_start, s1.before_start) AS before_start, coalesce(r.before_end, s1.before_end) AS before_end)
    FROM s1 LEFT JOIN s1 r ON s1.related_id = r.account_id AND s1.receiver_id = r.receiver_id),
  bal AS (SELECT * REPLACE (CASE period WHEN 'LifeToDate' THEN 'Statement' ELSE period END AS period), CAST(amount * 2 AS DECIMAL(26,4)) AS average_amount FROM deposit_balance),
  win AS (SELECT DISTINCT account_id, receiver_id, related_id, period_start, period_end, before_start, year_end, prior_year_end FROM drv),
  lab AS (SELECT w.account_id, w.receiver_id, w.related_id, b.code, b.batch_date, b.row_id, CASE WHEN b.code = 'FATCATaxPaid' THEN b.average_amount ELSE b.amount END AS v,
    CASE WHEN b.period = 'Statement' AND b.valid_to = w.period_end AND b.batch_date BETWEEN w.period_start AND w.period_end THEN 'period'
      WHEN b.period = 'Statement' AND b.valid_to = w.before_start AND b.batch_date <= w.period_start THEN 'prior_period'
      WHEN b.period = 'Yearly' AND b.valid_to = w.year_end AND b.batch_date <= w.period_end THEN 'ytd'
      WHEN b.period = 'Yearly' AND b.valid_to = w.prior_year_end AND b.batch_date <= w.period_end THEN 'prior_year' END AS win
    FROM bal b JOIN win w ON b.account_id = w.related_id),
  one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id, receiver_id, related_id, code, win ORDER BY batch_date DESC, row_id DESC) AS rn FROM lab WHERE win IS NOT NULL) WHERE rn = 1),
  wide AS (SELECT account_id, receiver_id, related_id, """,
    """ GROUP BY 1, 2, 3),
  rel AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id, relation_code, relation_type, related_id ORDER BY day DESC, action) AS rn FROM relation
    WHERE day <= DATE '1998-12-31' AND account_id IN (SELECT account_id FROM drv)) WHERE rn = 1 AND action <> 'Delete'),
  cust AS (SELECT r.account_id, r.related_id, r.relation_type, r.relation_code,
    CAST(max(CASE WHEN EXISTS (SELECT 1 FROM preference p WHERE p.customer_id = r.related_id AND p.action <> 'Delete' AND p.pref_status = 'Opt In' AND p.pref_type = 'Privacy Notice' AND p.day <= r.day) THEN 1 ELSE 0 END) AS INTEGER) AS privacy,
    CAST(max(CASE WHEN EXISTS (SELECT 1 FROM preference p WHERE p.customer_id = r.related_id AND p.action <> 'Delete' AND p.pref_status = 'Opt In' AND p.pref_type = 'ADA Large Print' AND p.day <= r.day) THEN 1 ELSE 0 END) AS INTEGER) AS large_print,
    any_value(m.name_line) AS name_line, any_value(m.birth_date) AS birth_date, any_value(m.delivery_pref) AS delivery_pref
    FROM rel r LEFT JOIN customer_master m ON r.related_id = m.customer_id GROUP BY 1, 2, 3, 4),
  att0 AS (SELECT CAST(o_custkey AS VARCHAR) AS account_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'CalType' WHEN '2-HIGH' THEN 'APY' WHEN '3-MEDIUM' THEN 'BlendedAPY' ELSE 'Unused' END AS attr_type,
    CASE o_orderstatus WHEN 'F' THEN 'Flat' WHEN 'O' THEN 'True' ELSE 'x' END AS attr_value, CAST(o_orderdate AS DATE) AS day, o_orderkey AS row_id FROM orders),
  att1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id, attr_type ORDER BY day DESC, row_id DESC) AS rn FROM att0
    WHERE (attr_type = 'CalType' AND attr_value IN ('Flat', 'Tier')) OR (attr_type = 'BlendedAPY' AND attr_value = 'True') OR attr_type IN ('Curr', 'APY', 'CheckImageDisposition')) WHERE rn = 1),
  att AS (SELECT account_id, max(attr_value) FILTER (WHERE attr_type = 'CalType') AS cal_type, max(attr_value) FILTER (WHERE attr_type = 'BlendedAPY') AS blended_apy,
    max(attr_value) FILTER (WHERE attr_type = 'Curr') AS curr, max(attr_value) FILTER (WHERE attr_type = 'APY') AS apy, max(attr_value) FILTER (WHERE attr_type = 'CheckImageDisposition') AS check_images FROM att1 GROUP BY 1),
  dly AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id, day ORDER BY row_id DESC) AS rn FROM deposit_daily) WHERE rn = 1)""",
)
_BASE = _base_sql("deposit_balance", CELLS, AVERAGES)


@query("report_statement_driver", _BASE + " SELECT * FROM drv")
def _(t):
    return _driver(t)


@query("report_balances_by_window", _BASE + " SELECT * FROM wide")
def _(t):
    return masters.balances_by_window(_driver(t), _balances(t), CELLS, AVERAGES)


def _with_codes_sql() -> str:
    """The same over a role that has all balance codes, in the place of ``deposit_balance``."""
    sql = _base_sql("deposit_balance", masters.STATEMENT_CELLS, masters.AVERAGE_CODES)
    return sql.replace(duck_dialect(ROLES["deposit_balance"]), duck_dialect(ROLES["master_balance"]))


@query("report_balances_default_cells", _with_codes_sql() + " SELECT * FROM wide")
def _(t):
    """All default cells of the master record."""
    period = F.when(F.col("period") == "LifeToDate", "Statement").otherwise(F.col("period"))
    doubled = (F.col("amount") * 2).cast("decimal(26,4)")
    balances = t.master_balance.withColumns({"period": period, "average_amount": doubled})
    return masters.balances_by_window(_driver(t), balances)


@query(
    "report_statement_master",
    _BASE
    + """ SELECT DISTINCT d.*, c.related_id AS customer_related_id, c.relation_type AS customer_relation_type, c.relation_code AS customer_relation_code, c.privacy AS customer_privacy,
    c.large_print AS customer_large_print, c.name_line AS customer_name_line, c.birth_date AS customer_birth_date, c.delivery_pref AS customer_delivery_pref,
    a.* EXCLUDE (account_id), w.* EXCLUDE (account_id, receiver_id, related_id), p.ledger_balance AS prev_ledger_balance, p.running_balance AS prev_running_balance,
    n.ledger_balance AS curr_ledger_balance, n.running_balance AS curr_running_balance
    FROM drv d LEFT JOIN cust c ON d.account_id = c.account_id LEFT JOIN att a ON d.related_id = a.account_id
    LEFT JOIN wide w ON d.account_id = w.account_id AND d.receiver_id = w.receiver_id AND d.related_id = w.related_id
    LEFT JOIN dly p ON d.related_id = p.account_id AND d.before_end = p.day LEFT JOIN dly n ON d.related_id = n.account_id AND d.period_end = n.day""",
)
def _(t):
    """Built, then written by class and read back, as the insert by partition does."""
    driver = tables.stage(_driver(t), "driver")  # read by four branches
    people = masters.related_customers(driver, t.relation, t.preference, t.customer_master, RUN_DATE)
    attrs = masters.attributes(driver, _attributes(t))
    rows = masters.statement_master(driver, people, attrs, t.deposit_daily, _balances(t), CELLS, AVERAGES)
    path = scratch_path(t.spark, "statement-master")
    tables.insert_dynamic_partition(rows, path, "stmnt")
    return tables.read_table(t.spark, path, rows.schema)


# --- address preferences and organisation --------------------------------------------------

_MASTER_ROWS = """m AS (SELECT DISTINCT account_id, customer_id AS receiver_id, notify_mode, CAST(CASE comm_mode WHEN 'Mail' THEN 1 ELSE 0 END AS INTEGER) AS paper_count,
    CAST(CASE comm_mode WHEN 'SecureEMessage' THEN 2 ELSE 0 END AS INTEGER) AS secure_count, product AS title FROM account_statement)"""
_CONTACT_ROWS = """k AS (SELECT DISTINCT customer_id AS account_id, customer_id AS receiver_id, line1, city, state, addr_type, CAST(row_id AS BIGINT) AS seq FROM postal_address
    WHERE action <> 'Delete')"""


@query(
    "report_address_preferences",
    with_roles("account_statement", "postal_address")
    + f""", {_MASTER_ROWS}, {_CONTACT_ROWS},
  e AS (SELECT m.*, replace(coalesce(notify_mode, ''), ' ', '') AS nm FROM m),
  x AS (SELECT DISTINCT * EXCLUDE (nm), unnest(string_split(CASE WHEN paper_count > 0 AND nm <> '' THEN nm || ',Paper' WHEN paper_count > 0 THEN 'Paper' ELSE nm END, ',')) AS mode FROM e),
  f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id, receiver_id ORDER BY seq, addr_type, line1) AS rn FROM k) WHERE rn = 1)
  SELECT DISTINCT x.account_id, x.receiver_id, x.mode, CASE WHEN paper_count > 0 THEN '1' ELSE '0' END AS paper_indicator, CASE WHEN secure_count > 0 THEN '1' ELSE '0' END AS secure_indicator,
    coalesce(k.line1, f.line1) AS address_line_1, coalesce(k.city, f.city) AS city, coalesce(k.state, f.state) AS state,
    CASE WHEN secure_count > 0 AND x.mode = 'SMS' THEN 'Text' WHEN secure_count > 0 AND x.mode = 'Email' THEN 'Email' ELSE '' END AS secure_message,
    substr(title, 1, 60) AS primary_title, substr(title, 61, 60) AS secondary_title
  FROM x LEFT JOIN k ON x.account_id = k.account_id AND x.receiver_id = k.receiver_id AND x.mode = 'Paper' LEFT JOIN f ON x.account_id = f.account_id AND x.receiver_id = f.receiver_id""",
)
def _(t):
    rows = t.account_statement.select(
        "account_id",
        F.col("customer_id").alias("receiver_id"),
        "notify_mode",
        F.when(F.col("comm_mode") == "Mail", 1).otherwise(0).alias("paper_count"),
        F.when(F.col("comm_mode") == "SecureEMessage", 2).otherwise(0).alias("secure_count"),
        F.col("product").alias("title"),
    ).distinct()
    contacts = (
        t.postal_address.where(F.col("action") != "Delete")
        .select(
            F.col("customer_id").alias("account_id"),
            F.col("customer_id").alias("receiver_id"),
            "line1",
            "city",
            "state",
            "addr_type",
            F.col("row_id").cast("long").alias("seq"),
        )
        .distinct()
    )
    return masters.address_preferences(rows, contacts)


@query(
    "report_organisation",
    with_roles("org_unit")
    + """, i AS (SELECT *, unnest(string_split(address_info, ',')) AS item FROM org_unit WHERE unit_type = 'Financial Entity'),
  kv AS (SELECT *, split_part(item, '-', 1) AS k, nullif(split_part(item, '-', 2), '') AS v FROM i),
  p AS (SELECT ledger_id, unit_id, unit_name, business_phone, address_info, max(CASE WHEN k = 'StreetName' THEN coalesce(v, '') ELSE '' END) AS street, max(CASE WHEN k = 'BuildingId' THEN coalesce(v, '') ELSE '' END) AS building,
    max(CASE WHEN k = 'BoxNumber' THEN coalesce(v, '') ELSE '' END) AS box, max(CASE WHEN k = 'Postcode' THEN coalesce(v, '') ELSE '' END) AS postcode,
    max(CASE WHEN v IS NULL THEN ',' ELSE '' END) AS sep, max(CASE WHEN v IS NULL THEN k ELSE '' END) AS bare FROM kv GROUP BY 1, 2, 3, 4, 5),
  w AS (SELECT CAST(s_nationkey AS VARCHAR) AS unit_id, max_by(s_name, s_suppkey) AS site FROM supplier GROUP BY 1)
  SELECT DISTINCT p.unit_id, unit_name, ledger_id, street || sep || bare || CASE WHEN street <> '' OR building <> '' THEN ',' ELSE '' END || building AS address_line, box AS address_line_2,
    postcode AS postal_code, w.site AS website, replace(replace(business_phone, '-', ''), ' ', '') AS business_phone, address_info FROM p LEFT JOIN w ON p.unit_id = w.unit_id""",
)
def _(t):
    sites = t.supplier.select(
        F.col("s_nationkey").cast("string").alias("unit_id"), F.col("s_name").alias("site"), F.col("s_suppkey").alias("day")
    )
    return masters.organisation_record(t.org_unit, sites)
