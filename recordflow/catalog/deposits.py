"""Deposit reports over the driver's tables."""

from __future__ import annotations


from recordflow.catalog.registry import query
from recordflow.catalog.roles import with_roles
from recordflow.plans.reports import deposits
from recordflow.plans.reports.run import Run

RUN = Run("1998-01-01", "1998-12-31")
_IN = "BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"


def _page(order: str, size: int) -> str:
    return f"CAST(ceil(row_number() OVER (ORDER BY {order}) / {size}.0) AS BIGINT)"


def _shown(expr: str, scale: int = 4) -> str:
    return f"coalesce(format('{{:,.{scale}f}}', CAST(CAST({expr} AS DECIMAL(26,{scale})) AS DOUBLE)), '0.00')"


def _codes(names: dict[str, str]) -> str:
    return ", ".join(f"max(amount) FILTER (WHERE code = '{c}') AS {n}" for c, n in names.items())


def _listed(names: dict[str, str]) -> str:
    return ", ".join(f"'{c}'" for c in names)


# --- savings interest ----------------------------------------------------------------------

_LOOSE = f""", yr AS (SELECT * FROM deposit_balance WHERE batch_date {_IN}),
  top AS (SELECT max(batch_date) AS batch_date, account_id, code FROM yr WHERE valid_to {_IN} AND period = 'Yearly' AND code IN ({_listed(deposits.SAVINGS_CODES)}) GROUP BY account_id, code),
  hit AS (SELECT * FROM yr WHERE period = 'Yearly' AND code IN ({_listed(deposits.SAVINGS_CODES)}) AND EXISTS (SELECT 1 FROM top WHERE top.account_id = yr.account_id AND top.batch_date = yr.batch_date)),
  one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id, code ORDER BY batch_date DESC, row_id DESC) AS rn FROM hit) WHERE rn = 1),
  w AS (SELECT account_id, {_codes(deposits.SAVINGS_CODES)} FROM one GROUP BY 1)"""


@query(
    "report_savings_interest",
    with_roles("deposit_account", "deposit_daily", "deposit_txn", "deposit_balance")
    + _LOOSE
    + f""", b AS (SELECT * FROM deposit_daily WHERE day IN (SELECT max(day) FROM deposit_daily)),
  l AS (SELECT account_id, max(day) AS last_day FROM deposit_txn GROUP BY 1),
  a AS (SELECT * FROM deposit_account WHERE family IN ('Savings', 'MMDA') AND coalesce(ledger_id, '') IN ('0', '1', '2')),
  u AS (SELECT a.*, w.* EXCLUDE (account_id) FROM a LEFT JOIN w ON a.account_id = w.account_id WHERE upper(a.status) = 'ACTIVE'
    UNION SELECT a.*, w.* EXCLUDE (account_id) FROM a JOIN w ON a.account_id = w.account_id WHERE upper(a.status) <> 'ACTIVE' AND a.closed_on {_IN}
      AND (w.federal_ytd > 0 OR w.fatca_ytd > 0 OR w.interest_ytd > 0)),
  x AS (SELECT DISTINCT u.account_id, u.product_code, u.title AS account_title, {_shown('b.accrued_interest')} AS accrued_interest, u.currency, {_shown('b.ledger_balance')} AS ledger_balance,
    {_shown('b.running_balance')} AS running_balance, coalesce(u.rate, CAST(0 AS DECIMAL(14,10))) AS rate, {_shown('u.interest_ytd')} AS interest_ytd,
    coalesce(strftime(l.last_day, '%m-%d-%Y'), ' ') AS last_transaction, strftime(u.opened_on, '%m-%d-%Y') AS opened,
    {_shown('coalesce(u.fatca_ytd, 0) + coalesce(u.federal_ytd, 0)')} AS withheld_ytd, u.index_name AS interest_index
    FROM u LEFT JOIN b ON u.account_id = b.account_id AND u.ledger_id = b.ledger_id LEFT JOIN l ON u.account_id = l.account_id)
  SELECT *, {_page('product_code, account_id, account_title, accrued_interest', 10)} AS pagenbr FROM x""",
)
def _(t):
    rows = deposits.savings_interest(
        t.deposit_account, t.deposit_daily, t.deposit_txn, t.deposit_balance, RUN, ledgers="0,1,2"
    )
    return deposits.savings_pages(rows)


# --- deposit listing and balances by rate --------------------------------------------------

_ROWS = (
    with_roles("deposit_account", "deposit_daily", "deposit_txn", "deposit_balance", "customer_master")
    + f""", one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id, code ORDER BY batch_date DESC, row_id DESC) AS rn FROM deposit_balance
      WHERE batch_date {_IN} AND valid_to {_IN} AND period = 'Yearly' AND code IN ({_listed(deposits.DEPOSIT_CODES)})) WHERE rn = 1),
  w AS (SELECT account_id, {_codes(deposits.DEPOSIT_CODES)} FROM one GROUP BY 1),
  b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY day DESC, row_id DESC) AS rn FROM deposit_daily) WHERE rn = 1),
  l AS (SELECT account_id, max(day) AS last_day FROM deposit_txn GROUP BY 1),
  r AS (SELECT 'Retail Deposits' AS product_line, a.product_code, a.account_id, m.name_line AS customer_name, CAST(coalesce(b.ledger_balance, 0) AS DECIMAL(26,4)) AS ledger_balance, a.currency,
    CASE WHEN a.substate = 'Unredeemed' AND a.unredeemed_option = 'NoAccrual' THEN CAST(0 AS DECIMAL(14,10)) ELSE coalesce(a.rate, CAST(0 AS DECIMAL(14,10))) END AS rate,
    CAST(coalesce(b.accrued_interest, 0) AS DECIMAL(26,4)) AS accrued_interest, coalesce(strftime(l.last_day, '%m-%d-%Y'), ' ') AS last_activity, strftime(a.opened_on, '%m-%d-%Y') AS opened, a.closed_on, a.status
    FROM deposit_account a LEFT JOIN b ON a.account_id = b.account_id AND a.ledger_id = b.ledger_id LEFT JOIN customer_master m ON a.customer_id = m.customer_id LEFT JOIN l ON a.account_id = l.account_id),
  x AS (SELECT r.* EXCLUDE (status), w.* EXCLUDE (account_id) FROM r LEFT JOIN w ON r.account_id = w.account_id WHERE upper(r.status) = 'ACTIVE'
    UNION ALL SELECT r.* EXCLUDE (status), w.* EXCLUDE (account_id) FROM r JOIN w ON r.account_id = w.account_id WHERE upper(r.status) <> 'ACTIVE' AND (r.closed_on {_IN} OR r.closed_on IS NULL)
      AND (w.federal_ytd > 0 OR w.fatca_ytd > 0 OR w.distribution_ytd > 0 OR w.interest_ytd > 0))"""
)


def _deposit_rows(t):
    return deposits.deposit_rows(
        t.deposit_account, t.deposit_daily, t.customer_master, t.deposit_txn, t.deposit_balance, RUN
    )


@query("report_deposit_rows", _ROWS + " SELECT * FROM x")
def _(t):
    return _deposit_rows(t)


@query(
    "report_deposit_listing",
    _ROWS
    + """, d AS (SELECT product_line, product_code, account_id, customer_name, currency, CAST(ledger_balance AS DECIMAL(38,4)) AS ledger_balance,
      CAST(accrued_interest AS DECIMAL(38,4)) AS accrued_interest, CAST(interest_ytd AS DECIMAL(38,4)) AS interest_ytd, product_code AS group_code FROM x)
  SELECT *, '0' AS dataordering FROM d UNION ALL SELECT 'SubTotal', '', '', '', '', CAST(sum(ledger_balance) AS DECIMAL(38,4)), CAST(sum(accrued_interest) AS DECIMAL(38,4)),
    CAST(sum(interest_ytd) AS DECIMAL(38,4)), group_code, '1' FROM d GROUP BY group_code""",
)
def _(t):
    return deposits.deposit_listing(_deposit_rows(t))


@query(
    "report_balances_by_rate",
    _ROWS
    + """, g AS (SELECT rate, currency, count(account_id) AS n, sum(ledger_balance) AS v FROM x GROUP BY ALL), s AS (SELECT sum(n) AS tn, sum(v) AS tv FROM g)
  SELECT CAST(rate AS VARCHAR) AS rate, CAST(n AS VARCHAR) AS accounts, format('{:,.2f}', CAST(n AS DOUBLE) * 100 / CAST(tn AS DOUBLE)) AS account_share, currency,
    format('{:,.2f}', CAST(CAST(v AS DECIMAL(26,2)) AS DOUBLE)) AS balance, format('{:,.2f}', CASE WHEN tv <> 0 THEN CAST(v AS DOUBLE) * 100 / CAST(tv AS DOUBLE) ELSE 0 END) AS balance_share, '0' AS dataordering
  FROM g CROSS JOIN s""",
)
def _(t):
    return deposits.balances_by_rate(_deposit_rows(t))


# --- incentives ----------------------------------------------------------------------------


@query(
    "report_incentives",
    with_roles("incentive_balance", "deposit_account", "customer_master")
    + f""", b AS (SELECT * FROM incentive_balance i WHERE year(valid_to) = 1998 AND period = 'Yearly' AND code IN ({_listed(deposits.INCENTIVE_CODES)})
      AND batch_date IN (SELECT max(batch_date) FROM incentive_balance j WHERE i.account_id = j.account_id AND i.code = j.code AND i.period = j.period AND year(j.valid_to) = 1998)),
  s AS (SELECT account_id, code, CAST(sum(coalesce(amount, 0)) AS DECIMAL(38,4)) AS amount FROM b GROUP BY 1, 2),
  w AS (SELECT account_id, {_codes(deposits.INCENTIVE_CODES)} FROM s GROUP BY 1),
  x AS (SELECT a.ledger_id AS financial_entity, a.branch_id, a.account_id, m.name_line AS customer_name,
    CAST(coalesce(incentive_1, 0) + coalesce(incentive_2, 0) + coalesce(incentive_3, 0) AS DECIMAL(38,4)) AS incentives, federal_tax, fatca_tax,
    CASE WHEN m.tax_status LIKE '%W-8%' OR m.tax_status LIKE 'W8%' OR m.tax_status LIKE '%NRA%' OR m.tax_status LIKE '%NRE%' OR m.tax_status LIKE 'Foreign%' THEN 'Yes' ELSE '' END AS nra
    FROM deposit_account a LEFT JOIN customer_master m ON a.customer_id = m.customer_id AND a.ledger_id = m.ledger_id LEFT JOIN w ON a.account_id = w.account_id),
  y AS (SELECT * FROM x WHERE incentives > 0 OR federal_tax > 0 OR fatca_tax > 0),
  z AS (SELECT *, '0' AS dataordering FROM y
    UNION ALL SELECT 'Totals', '', '', '', CAST(sum(incentives) AS DECIMAL(38,4)), CAST(sum(federal_tax) AS DECIMAL(38,4)), CAST(sum(fatca_tax) AS DECIMAL(38,4)), '', '1' FROM y
    UNION ALL SELECT 'NRA Totals', '', '', '', CAST(sum(incentives) AS DECIMAL(38,4)), CAST(sum(federal_tax) AS DECIMAL(38,4)), CAST(sum(fatca_tax) AS DECIMAL(38,4)), '', '2' FROM y WHERE nra = 'Yes'
    UNION ALL SELECT 'All Others', '', '', '', CAST(sum(incentives) AS DECIMAL(38,4)), CAST(sum(federal_tax) AS DECIMAL(38,4)), CAST(sum(fatca_tax) AS DECIMAL(38,4)), '', '3' FROM y WHERE nra <> 'Yes')
  SELECT *, '1' AS pagenbr, {_page('financial_entity, branch_id, account_id, dataordering', 10)} AS rowid FROM z""",
)
def _(t):
    rows = deposits.incentive_rows(t.deposit_account, t.customer_master, t.incentive_balance, 1998)
    return deposits.incentive_report(rows)


# --- batch windows -------------------------------------------------------------------------

_BATCH = "SELECT CAST(r_regionkey AS STRING) AS ledger_id, make_date(1997 + r_regionkey, 7, 28) AS batch_date FROM {region}"
_WINDOWS = (
    f", bw AS ({_BATCH.format(region='region')}), "
    + """win AS (SELECT ledger_id, strftime(batch_date, '%Y%m%d') AS batch_day, make_date(year(batch_date) - 1, 1, 1) AS prior_first,
      make_date(year(batch_date) - 1, 12, 31) AS prior_last, make_date(year(batch_date), 1, 1) AS year_first FROM bw)"""
)


def _windows(t):
    return deposits.batch_windows(t.spark.sql(_BATCH, region=t.region))


@query("report_batch_window", "WITH " + _WINDOWS[2:] + " SELECT * FROM win")
def _(t):
    return _windows(t)


@query(
    "report_yearly_in_window",
    with_roles("deposit_balance")
    + _WINDOWS
    + """ SELECT * EXCLUDE (rn) FROM (SELECT b.*, row_number() OVER (PARTITION BY account_id ORDER BY batch_date DESC, row_id DESC) AS rn
    FROM deposit_balance b JOIN win w ON b.ledger_id = w.ledger_id WHERE upper(code) = 'INTERESTPAIDBALANCE' AND upper(period) = 'YEARLY'
    AND full_date <= batch_day AND valid_from >= prior_first AND valid_to <= prior_last) WHERE rn = 1""",
)
def _(t):
    return deposits.yearly_in_window(t.deposit_balance, _windows(t), "InterestPaidBalance")


# --- control totals ------------------------------------------------------------------------

_D = "DATE '1998-06-30'"
_TXN_CASE = "CASE lower(posting_code) WHEN 'clearingcheckwithdrawal' THEN '0127' WHEN 'remotedepositcheckexternal' THEN '0122' WHEN 'creditinterest' THEN '0190' END"
_CONTROL = (
    with_roles("deposit_account", "deposit_daily", "deposit_txn", "ledger_entry")
    + f""", acc AS (SELECT a.account_id FROM deposit_daily d JOIN deposit_account a ON d.account_id = a.account_id WHERE d.day = {_D}
      AND (lower(a.status) = 'active' OR (a.status = 'Settled' AND a.closed_on > {_D}))),
  closed AS (SELECT account_id FROM deposit_account WHERE closed_on = {_D}),
  cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY row_id DESC) AS rn FROM deposit_daily WHERE day = {_D}) WHERE rn = 1),
  prev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY row_id DESC) AS rn FROM deposit_daily WHERE day = DATE '1997-12-31') WHERE rn = 1),
  ytd AS (SELECT cur.account_id, coalesce(cur.interest_paid, 0) - coalesce(prev.interest_paid, 0) AS ytd FROM cur LEFT JOIN prev ON cur.account_id = prev.account_id),
  e AS (SELECT * FROM ledger_entry WHERE booked_on = {_D} AND booked_on = effective_on),
  rev AS (SELECT DISTINCT account_id FROM e WHERE operation = 'reversal'),
  daily AS (SELECT e.account_id, rev.account_id AS chk, sum(credit) AS credit, sum(debit) AS debit FROM e LEFT JOIN rev ON e.account_id = rev.account_id
    WHERE operation = 'accrual' AND gl_class = 'Liability' GROUP BY 1, 2),
  mon AS (SELECT e.account_id, rev.account_id AS chk FROM e LEFT JOIN rev ON e.account_id = rev.account_id WHERE operation = 'accrual' GROUP BY 1, 2),
  main AS (SELECT coalesce(cur.running_balance, 0) AS running, CASE WHEN daily.chk IS NOT NULL THEN 0 WHEN daily.credit < 0 AND daily.debit > 0 THEN -daily.debit ELSE coalesce(daily.credit - daily.debit, 0) END AS dly,
    CASE WHEN mon.chk IS NOT NULL THEN 0 ELSE coalesce(cur.accrued_interest, 0) END AS mth, coalesce(ytd.ytd, 0) AS ytd
    FROM acc LEFT JOIN cur ON acc.account_id = cur.account_id LEFT JOIN daily ON acc.account_id = daily.account_id LEFT JOIN mon ON acc.account_id = mon.account_id LEFT JOIN ytd ON acc.account_id = ytd.account_id),
  paid AS (SELECT ytd FROM main UNION ALL SELECT ytd FROM closed JOIN ytd ON closed.account_id = ytd.account_id),
  txn AS (SELECT account_id, txn_id, {_TXN_CASE} AS code, round(sum(CASE direction WHEN 'Debit' THEN -abs(amount) ELSE abs(amount) END), 2) AS amount FROM deposit_txn
    WHERE day = {_D} AND arrangement <> 'InternalArrangement' AND {_TXN_CASE} IS NOT NULL GROUP BY 1, 2, 3 HAVING amount <> 0),
  by_code AS (SELECT code, count(*) AS n, CAST(sum(amount) AS DECIMAL(17,2)) AS v FROM txn GROUP BY 1),
  lines AS (SELECT c.code, coalesce(n, 0) AS n, coalesce(v, CAST(0 AS DECIMAL(17,2))) AS v FROM (VALUES ('0122'), ('0127'), ('0190')) c(code) LEFT JOIN by_code b ON c.code = b.code)"""
)


def _metric(label: str, expr: str, table: str, order: int) -> str:
    return f"SELECT '{label}' AS description, CAST({expr} AS VARCHAR) AS cnt, {order} AS ord, '1' AS pagenbr FROM {table}"


def _sum(col: str) -> str:
    return f"CAST(coalesce(sum({col}), 0) AS DECIMAL(17,2))"


_L = deposits.CONTROL_LABELS


@query(
    "report_daily_controls",
    _CONTROL
    + " "
    + " UNION ALL ".join(
        [
            _metric(_L["open"], "count(account_id)", "acc", 1),
            _metric(_L["closed"], "count(account_id)", "closed", 2),
            _metric(_L["paid"], _sum("ytd"), "paid", 3),
            f"SELECT '{_L['count']}' || code, CAST(n AS VARCHAR), 4, '1' FROM lines",
            f"SELECT '{_L['value']}' || code, CAST(v AS VARCHAR), 5, '1' FROM lines",
            _metric(_L["daily"], _sum("dly"), "main", 6),
            _metric(_L["month"], _sum("mth"), "main", 7),
            _metric(_L["balance"], _sum("running"), "main", 8),
        ]
    ),
)
def _(t):
    return deposits.control_totals(t.deposit_account, t.deposit_daily, t.deposit_txn, t.ledger_entry, "1998-06-30")
