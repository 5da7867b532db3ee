"""Statement record set over the driver's tables; the run covers the year 1998."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.catalog.registry import query
from recordflow.catalog.roles import with_roles
from recordflow.plans.reports import statements
from recordflow.plans.reports.run import Run

RUN = Run("1998-01-01", "1998-12-31")
_IN = "BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"


def _driver_sql(post_maturity: bool = False) -> str:
    rule = "post_maturity = 'Yes'" if post_maturity else "statement_type = 'DetailedStatement' AND product LIKE '%LineOfCredit%'"
    label = "statement_type" if post_maturity else "'DetailedLOCStatement'"
    return f", d AS (SELECT *, {label} AS label FROM account_statement WHERE starts_on {_IN} AND {rule})"


def _prefix(record: str, sort: str | None = None, d: str = "d") -> str:
    return (
        f"SELECT DISTINCT '{record}' AS rec_typ, {d}.account_id || '-' || {d}.label AS filter_val, 1 AS sort_order, '{sort or record}' AS sort_order_1, "
        f"{d}.account_id || '-' || {d}.customer_id AS accnt_nmbr, {d}.message_id AS uuid"
    )


def _implied(expr: str, p: int = 26, s: int = 4) -> str:
    return f"replace(CAST(CAST(coalesce({expr}, 0) AS DECIMAL({p},{s})) AS VARCHAR), '.', '')"


def _newest(table: str, keys: str, where: str, order: str, name: str) -> str:
    return f"""{name} AS (SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn_
    FROM {table} WHERE {where}) WHERE rn_ = 1)"""


_TODAY = _newest("account_day", "account_id", f"day {_IN}", "day DESC, row_id DESC", "today")
_PREV = _newest(
    "account_statement",
    "account_id",
    "starts_on < DATE '1998-01-01' AND statement_type = 'DetailedStatement' AND product LIKE '%LineOfCredit%'",
    "starts_on DESC, message_id DESC",
    "prev",
)


def _driver(t, post_maturity: bool = False):
    return statements.driving_rows(t.account_statement, RUN, post_maturity)


@query(
    "report_filter_list",
    with_roles("account_statement")
    + _driver_sql()
    + " SELECT 'ZZZZZZ-ZZZZZZZ' AS filter_val UNION SELECT account_id || '-' || label FROM d",
)
def _(t):
    return statements.filter_list(_driver(t))


# --- 791 -----------------------------------------------------------------------------------

_YTD_ROLES = with_roles("account_statement", "period_balance")
_YTD_ONE = ", " + _newest(
    "period_balance",
    "account_id, code, year(valid_to)",
    "code IN ('TotalFeeCollected', 'TotalInterestCollected') AND period = 'Yearly' AND year(valid_to) IN (1998, 1997)",
    "batch_date DESC, row_id DESC",
    "one",
)


def _ytd_sql(post_maturity: bool) -> str:
    def cell(code: str, year: int, name: str) -> str:
        return f"LEFT JOIN one {name} ON d.account_id = {name}.account_id AND {name}.code = '{code}' AND year({name}.valid_to) = {year}"

    return (
        _YTD_ROLES
        + _driver_sql(post_maturity)
        + _YTD_ONE
        + " "
        + _prefix("791")
        + ", '' AS over_limit_amount, '' AS resolved_amount, '' AS vat_total, '' AS capitalized_interest, "
        + f"{_implied('f.amount')} AS fees_ytd, {_implied('i.amount')} AS interest_ytd, {_implied('fp.amount')} AS fees_prev_ytd, {_implied('ip.amount')} AS interest_prev_ytd FROM d "
        + cell("TotalFeeCollected", 1998, "f")
        + " "
        + cell("TotalInterestCollected", 1998, "i")
        + " "
        + cell("TotalFeeCollected", 1997, "fp")
        + " "
        + cell("TotalInterestCollected", 1997, "ip")
    )


@query("report_ytd_fees", _ytd_sql(False))
def _(t):
    """The four self joins of the SQL twin are one scan and one aggregation here."""
    return statements.ytd_record(_driver(t), t.period_balance, 1998)


@query("report_ytd_fees_post_maturity", _ytd_sql(True))
def _(t):
    return statements.ytd_record(_driver(t, True), t.period_balance, 1998)


# --- 790 -----------------------------------------------------------------------------------


@query(
    "report_statement_totals",
    with_roles("account_statement", "account_day", "account_master")
    + _driver_sql()
    + f", {_TODAY}, {_PREV}, "
    + _newest("account_day", "account_id, day", "true", "row_id DESC", "of_day")
    + " "
    + _prefix("790")
    + f""", d.account_id AS account_number, {_implied('y.ledger_balance')} AS beginning_principal_balance, {_implied('p.closing_balance')} AS beginning_total_balance,
    '' AS principal_credit, '' AS total_credit, '' AS principal_debit, '' AS total_debit, '' AS total_debit_and_accrued, {_implied('d.interest_due')} AS current_payment_interest,
    {_implied('d.principal_balance')} AS ending_principal_balance, {_implied('d.closing_balance')} AS ending_total_balance, '' AS average_daily_principal,
    {_implied('a.accrual_factor', 14, 10)} AS daily_rate_factor, d.issued_on AS statement_generated_on, {_implied('d.days_in_cycle', 3, 0)} AS days_in_cycle,
    {_implied('d.past_due')} AS amount_past_due, {_implied('a.apr', 14, 10)} AS annual_rate, d.starts_on AS billing_period_start, {_implied('d.past_due + d.current_due')} AS total_payment_due,
    {_implied('a.military_apr')} AS military_annual_rate, a.next_due_on AS payment_due_date, {_implied('d.principal_due')} AS current_payment_principal, '' AS current_payment_both,
    {_implied('d.late_charge_due')} AS total_late_charges_due, {_implied('n.misc_fee')} AS total_miscellaneous_due, '' AS late_charges_assessed_after,
    {_implied('n.accrued_interest')} AS interest_accrued, {_implied('y.past_due_interest')} AS total_interest_due, {_implied('y.past_due_principal')} AS total_principal_due,
    '' AS average_daily_for_accruals, d.statement_type, d.starts_on AS statement_start, d.ends_on AS statement_end, {_implied('y.disbursed')} AS total_disbursements,
    {_implied('d.payments_made')} AS total_payments, {_implied('d.payoff_penalty')} AS current_payoff_penalty, {_implied('d.insurance_collected')} AS insurance_collected,
    {_implied('d.insurance_due')} AS insurance_due, CASE WHEN upper(d.post_maturity) = 'YES' THEN '1' ELSE '0' END AS post_maturity_indicator,
    {_implied('n.fee_collected')} AS fees_collected, {_implied('d.late_charge_collected')} AS late_charge_collected, {_implied('d.principal_balance')} AS new_principal_balance,
    d.principal_as_of AS new_principal_balance_date, {_implied('d.current_due')} AS total_current_due
    FROM d LEFT JOIN of_day y ON d.account_id = y.account_id AND y.day = d.starts_on - 1 LEFT JOIN today n ON d.account_id = n.account_id
    LEFT JOIN prev p ON d.account_id = p.account_id LEFT JOIN account_master a ON d.account_id = a.account_id""",
)
def _(t):
    return statements.totals_record(_driver(t), t.account_statement, t.account_day, t.account_master, RUN)


# --- 711 -----------------------------------------------------------------------------------


def _routed(codes: list[str], name: str) -> str:
    listed = ", ".join(f"'{c}'" for c in codes)
    return f"CASE WHEN t.posting_code IN ({listed}) THEN {_implied('t.amount')} END AS {name}"


@query(
    "report_transactions",
    with_roles("account_statement", "account_txn")
    + _driver_sql()
    + " "
    + _prefix("711")
    + f""", d.account_id AS account_number, t.txn_id AS transaction_number, {_implied('t.amount')} AS transaction_amount,
    {_routed(['ACHPrincipalPayment', 'PrincipalPayment'], 'principal_amount')}, {_routed(['InterestPayment'], 'interest_amount')},
    {_routed(['LateChargeFeePayment'], 'late_charge_amount')}, {_routed(['MiscellaneousFeePayment'], 'miscellaneous_charge')},
    {_routed(['ChargeOff'], 'charged_off_recovered')}, t.posted_on AS effective_date, t.direction AS debit_credit_indicator
    FROM account_txn t JOIN d ON d.account_id = t.account_id AND t.posted_on >= d.starts_on AND t.posted_on <= d.ends_on""",
)
def _(t):
    return statements.transaction_record(_driver(t), t.account_txn)


# --- 402, 401, 400 -------------------------------------------------------------------------

_CODES = {"TotalFeeReceivable": "minimum_payment", "ForgivenDebt": "available_balance", "ForgivenInterest": "projected_interest"}
_ADVERSE = "SELECT account_id, 'Open' AS bankruptcy_status FROM {0} WHERE status = 'Settled' AND substate = 'Open'"


@query(
    "report_balance_detail",
    with_roles("account_statement", "account_day", "deposit_account", "account_master", "period_balance")
    + _driver_sql()
    + f", {_TODAY}, "
    + _newest("period_balance", "account_id, code", f"batch_date {_IN}", "batch_date DESC, row_id DESC", "bal")
    + f", adverse AS ({_ADVERSE.format('deposit_account')}), detail AS (SELECT 'U' || CAST(o_orderkey AS VARCHAR) AS message_id, CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) + 20 END AS grace_time FROM orders) "
    + _prefix("402")
    + f""", {_implied('a.accrual_factor', 14, 10)} AS interest_daily_factor, {_implied('m.amount')} AS minimum_payment, '' AS minimum_payment_percentage,
    {_implied('a.contract_amount')} AS total_note, '' AS fixed_late_charge, {_implied('v.amount')} AS available_balance, '' AS cash_advance_limit, '' AS cash_advance_available,
    '' AS total_disputed, {_implied('n.past_due')} AS delinquent_amount, b.bankruptcy_status, {_implied('a.credit_limit')} AS current_credit_limit, g.grace_time,
    {_implied('n.accrued_interest')} AS interest_charged, {_implied('j.amount')} AS projected_interest,
    CASE WHEN n.ledger_balance < 0 THEN 'Y' WHEN n.adjustment > 0 THEN 'Y' ELSE 'N' END AS credit_balance_ind,
    '' AS term_out_indicator, '' AS term_out_reason, '' AS interest_charge_paid, '' AS tax_year, '' AS rate_as_of
    FROM d LEFT JOIN today n ON d.account_id = n.account_id LEFT JOIN account_master a ON d.account_id = a.account_id LEFT JOIN adverse b ON d.account_id = b.account_id
    LEFT JOIN bal m ON d.account_id = m.account_id AND m.code = 'TotalFeeReceivable' LEFT JOIN bal v ON d.account_id = v.account_id AND v.code = 'ForgivenDebt'
    LEFT JOIN bal j ON d.account_id = j.account_id AND j.code = 'ForgivenInterest' LEFT JOIN detail g ON d.message_id = g.message_id""",
)
def _(t):
    adverse = t.deposit_account.where((F.col("status") == "Settled") & (F.col("substate") == "Open")).select(
        "account_id", F.lit("Open").alias("bankruptcy_status")
    )
    details = t.orders.select(
        F.concat(F.lit("U"), F.col("o_orderkey").cast("string")).alias("message_id"),
        F.when(F.col("o_orderstatus") == "O", F.date_add(F.col("o_orderdate").cast("date"), 20)).alias("grace_time"),
    )
    return statements.balance_record(
        _driver(t), t.account_master, t.account_day, t.period_balance, adverse, details, RUN, _CODES
    )


@query(
    "report_payment_detail",
    with_roles("account_statement", "account_day", "deposit_account", "account_master", "period_balance", "account_bill")
    + _driver_sql()
    + f", {_TODAY}, {_PREV}, "
    + _newest("period_balance", "account_id", f"batch_date {_IN} AND code = 'TotalInterestCollected' AND period = 'Yearly'", "batch_date DESC, row_id DESC", "y0")
    + ", "
    + _newest("period_balance", "account_id", "batch_date = DATE '1997-12-31' AND code = 'TotalInterestCollected' AND period = 'Yearly'", "row_id DESC", "y1")
    + ", rates AS (SELECT account_id, CASE WHEN family = 'Savings' THEN index_name END AS index_code, CASE WHEN family = 'Savings' THEN rate END AS spread FROM deposit_account) "
    + _prefix("401")
    + f""", {_implied('n.past_due_interest')} AS prior_interest_due, {_implied('d.interest_due')} AS current_interest_due,
    {_implied('n.past_due_interest + b.interest_owed')} AS total_interest_due, {_implied('n.past_due_principal')} AS prior_principal_due, {_implied('d.principal_due')} AS current_principal_due,
    {_implied('n.ledger_balance')} AS total_principal_due, {_implied('d.late_charge_due')} AS late_charges_due, {_implied('d.fee_assessed')} AS miscellaneous_due,
    {_implied('b.not_yet_due')} AS total_billed_not_due, {_implied('n.accrued_interest')} AS accrued_interest, '' AS last_scheduled_payment, d.next_auto_debit AS next_scheduled_payment,
    a.payment_grace, {_implied('a.contract_amount')} AS amount_financed, {_implied('a.apr', 14, 10)} AS annual_rate, {_implied('d.fee_assessed')} AS total_finance_charge,
    '' AS original_payments, {_implied('a.schedule_amount')} AS principal_and_interest, {_implied('b.principal_owed')} AS fixed_principal, {_implied('b.bill_amount')} AS current_payment_amount,
    '' AS estimated_balloon_balance, {_implied('a.accrual_factor')} AS payoff_daily_interest, {_implied('d.payoff_balance')} AS payoff_net_amount,
    r.index_code AS interest_index, {_implied('r.spread', 14, 10)} AS interest_spread, a.rate_frequency AS interest_change_frequency, '' AS next_interest_change,
    {_implied('y0.amount')} AS interest_paid_ytd, {_implied('y1.amount')} AS interest_paid_prior_year, '' AS first_payment, d.account_id AS account_number,
    '' AS signature_card, '' AS online_signature_completed, '' AS paper_signature_returned, d.next_auto_debit, p.next_auto_debit AS last_auto_debit, d.issued_on AS payoff_good_through,
    '' AS early_payoff_penalty, '' AS last_payment_date, '' AS last_payment_amount, '' AS balloon_amount, '' AS next_repayment_change, '' AS repayment_change_reason, a.manager AS relationship_manager
    FROM d LEFT JOIN account_master a ON d.account_id = a.account_id LEFT JOIN today n ON d.account_id = n.account_id LEFT JOIN account_bill b ON d.account_id = b.account_id
    LEFT JOIN y0 ON d.account_id = y0.account_id LEFT JOIN y1 ON d.account_id = y1.account_id LEFT JOIN rates r ON d.account_id = r.account_id LEFT JOIN prev p ON d.account_id = p.account_id""",
)
def _(t):
    savings = F.col("family") == "Savings"
    rates = t.deposit_account.select(
        "account_id", F.when(savings, F.col("index_name")).alias("index_code"), F.when(savings, F.col("rate")).alias("spread")
    )
    return statements.payment_record(
        _driver(t), t.account_statement, t.account_master, t.account_day, t.account_bill, t.period_balance, rates, RUN
    )


@query(
    "report_titles",
    with_roles("account_statement", "account_day", "deposit_account", "account_bill", "relation", "customer_master", "account_schedule")
    + _driver_sql()
    + f", {_TODAY}, "
    + _newest("account_schedule", "account_id", "day <= DATE '1998-12-31'", "day DESC, row_id DESC", "sched")
    + " "
    + _prefix("400")
    + f""", m.name_line AS coborrower_name, d.account_id AS account_number, substr(a.title, 1, 60) AS title_line_1, substr(a.title, 61, 60) AS title_line_2,
    substr(a.title, 121, 60) AS title_line_3, substr(a.title, 181, 60) AS title_line_4, a.family AS product_group, a.product_code, a.opened_on,
    {_implied('n.ledger_balance')} AS outstanding_principal, {_implied('a.rate', 14, 10)} AS interest_rate, {_implied('n.past_due')} AS grand_total_due,
    b.next_bill_on, a.currency AS currency_code, s.term AS previous_term
    FROM d LEFT JOIN deposit_account a ON d.account_id = a.account_id LEFT JOIN account_bill b ON d.account_id = b.account_id LEFT JOIN today n ON d.account_id = n.account_id
    LEFT JOIN relation r ON d.account_id = r.account_id AND r.relation_code = 'Borrower' AND upper(r.relation_type) = 'SECONDARY'
    LEFT JOIN customer_master m ON r.related_id = m.customer_id LEFT JOIN sched s ON d.account_id = s.account_id""",
)
def _(t):
    return statements.title_record(
        _driver(t), t.deposit_account, t.account_bill, t.account_day, t.relation, t.customer_master, t.account_schedule, RUN
    )


# --- 200, 201 ------------------------------------------------------------------------------


def _customer_sql(record: str, kind: str) -> str:
    return (
        with_roles("account_statement", "relation", "customer_master", "preference")
        + _driver_sql()
        + ", "
        + _newest("preference", "customer_id", "action <> 'Delete' AND day <= DATE '1998-12-31'", "day DESC, row_id DESC", "pref")
        + " "
        + _prefix(record)
        + f""", m.customer_id AS customer_number, m.name_line AS customer_name, strftime(m.birth_date, '%Y-%m-%d') AS date_of_birth, m.home_phone,
    CASE WHEN m.id_type = 'Driver''s License' THEN m.id_number ELSE '' END AS licence_number, CASE WHEN m.id_type = 'Driver''s License' THEN m.id_issuer ELSE '' END AS licence_state,
    CAST(1998 - year(m.birth_date) - CASE WHEN strftime(m.birth_date, '%m%d') > '1231' THEN 1 ELSE 0 END AS VARCHAR) AS age,
    CASE WHEN p.pref_type = 'Privacy Notice' AND p.pref_status = 'Opt In' THEN '1' ELSE '0' END AS annual_privacy_notice,
    CASE m.delivery_pref WHEN 'Electronic' THEN '00' WHEN 'Paper and Electronic' THEN '01' WHEN 'Paper' THEN '02' ELSE '' END AS electronic_indicator,
    CASE WHEN p.pref_type = 'ADA Large Print' AND p.pref_status = 'Opt In' THEN '1' ELSE '0' END AS ada_indicator, r.relation_code AS relationship_code
    FROM d JOIN relation r ON d.account_id = r.account_id AND r.day <= DATE '1998-12-31' AND r.relation_type = '{kind}' AND r.action <> 'Delete'
    LEFT JOIN customer_master m ON r.related_id = m.customer_id LEFT JOIN pref p ON p.customer_id = m.customer_id"""
    )


@query("report_secondary_customers", _customer_sql("201", "Secondary"))
def _(t):
    return statements.customer_record(_driver(t), t.relation, t.customer_master, t.preference, RUN)


@query("report_primary_customers", _customer_sql("200", "Primary"))
def _(t):
    return statements.customer_record(_driver(t), t.relation, t.customer_master, t.preference, RUN, primary=True)


# --- 100 -----------------------------------------------------------------------------------

_HOURS = """g AS (SELECT unit_id, starts_at, ends_at, min(day_nbr) AS lo, max(day_nbr) AS hi, min_by(day_name, day_nbr) AS a,
    max_by(day_name, day_nbr) AS b FROM open_hours GROUP BY ALL),
  h AS (SELECT unit_id, CASE WHEN lo < hi THEN a || ' to ' || b ELSE a END || ' - ' || starts_at || ' to ' || ends_at AS x FROM g),
  hours AS (SELECT unit_id, string_agg(x, ',' ORDER BY x) AS hours FROM h GROUP BY unit_id)"""
_TAGS = """items AS (SELECT ledger_id, unit_id, unit_name, unnest(string_split(address_info, ',')) AS item FROM org_unit WHERE unit_type = 'Financial Entity'),
  kv AS (SELECT ledger_id, unit_id, unit_name, split_part(item, '-', 1) AS k, split_part(item, '-', 2) AS v FROM items),
  tags AS (SELECT ledger_id, unit_id, unit_name, max(CASE WHEN k = 'StreetName' THEN v ELSE '' END) AS street, max(CASE WHEN k = 'BuildingId' THEN v ELSE '' END) AS building,
    max(CASE WHEN k = 'BoxNumber' THEN v ELSE '' END) AS box, max(CASE WHEN k = 'Postcode' THEN v ELSE '' END) AS postcode, max(CASE WHEN k = 'City' THEN v ELSE '' END) AS city,
    max(CASE WHEN k = 'State' THEN v ELSE '' END) AS state FROM kv GROUP BY ALL)"""
_PHONES = """phones AS (SELECT CAST(s_nationkey AS VARCHAR) AS unit_id, s_name AS phone, DATE '2000-01-01' + CAST(s_suppkey AS INT) AS day FROM supplier)"""


@query(
    "report_company",
    with_roles("account_statement", "org_unit", "open_hours")
    + _driver_sql()
    + f", {_HOURS}, {_TAGS}, {_PHONES}, "
    + _newest("phones", "unit_id", "true", "day DESC, phone", "phone")
    + " "
    + _prefix("100")
    + """, d.account_id AS account_number, o.unit_id AS company_code, o.unit_name AS company_name,
    o.street || CASE WHEN o.street <> '' OR o.building <> '' THEN ',' ELSE '' END || o.building AS address_line_1, o.box AS address_line_2, o.city, o.state,
    o.postcode AS postal_code, p.phone AS phone_number_2, h.hours AS hours_of_operation
    FROM d LEFT JOIN tags o ON d.ledger_id = o.ledger_id LEFT JOIN hours h ON o.unit_id = h.unit_id LEFT JOIN phone p ON o.unit_id = p.unit_id""",
)
def _(t):
    phones = t.supplier.select(
        F.col("s_nationkey").cast("string").alias("unit_id"),
        F.col("s_name").alias("phone"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("s_suppkey").cast("int")).alias("day"),
    )
    return statements.company_record(_driver(t), t.org_unit, t.open_hours, phones)


# --- TRN -----------------------------------------------------------------------------------


def _pref_sql(level: str, keys: str, name: str, extra: str = "") -> str:
    return _newest("address_pref", keys, f"action <> 'Delete' AND day <= DATE '1998-12-31' AND level = '{level}'{extra}", "day DESC, row_id DESC", name)


_CONTACT = (
    with_roles("account_statement", "postal_address", "address_pref", "email_address", "customer_master", "deposit_account")
    + _driver_sql()
    + ", "
    + _newest(
        "postal_address",
        "customer_id, addr_type, seq",
        """action <> 'Delete' AND customer_id IN (SELECT customer_id FROM d) AND ((coalesce(category, '') <> 'Seasonal' AND start_on <= DATE '1998-12-31' AND (end_on >= DATE '1998-12-31' OR end_on IS NULL))
         OR (coalesce(category, '') = 'Seasonal' AND 1231 BETWEEN CAST(season_start AS INT) AND CAST(season_end AS INT)))""",
        "day DESC, CASE category WHEN 'Temporary' THEN 1 WHEN 'Seasonal' THEN 2 ELSE 3 END, row_id DESC",
        "postal",
    )
    + ", sole AS (SELECT customer_id, any_value(line1) AS line1, any_value(city) AS city, any_value(state) AS state FROM postal GROUP BY 1 HAVING count(*) = 1), "
    + ", ".join(
        [
            _pref_sql("statement", "customer_id, account_id", "ps"),
            _pref_sql("account", "customer_id, account_id", "pa"),
            _pref_sql("customer", "customer_id", "pc"),
            _pref_sql("statement", "customer_id, account_id", "direct", " AND method = 'Direct Mail'"),
            _newest(
                "email_address",
                "customer_id, email_type, seq",
                "action <> 'Delete' AND start_on <= DATE '1998-12-31' AND (end_on IS NULL OR end_on >= DATE '1998-12-31')",
                "day DESC, start_on DESC, row_id DESC",
                "mail",
            ),
        ]
    )
    + ", sole_mail AS (SELECT customer_id, any_value(email) AS email FROM mail GROUP BY 1 HAVING count(*) = 1) "
)


@query(
    "report_contacts",
    _CONTACT
    + _prefix("TRN", "0")
    + """, d.statement_type AS form_type, m.customer_id AS customer_number, m.name_line AS full_legal_name, substr(a.title, 1, 60) AS primary_title, substr(a.title, 61, 60) AS secondary_title,
    coalesce(p.line1, s.line1, m.line1, '') AS address_line_1, coalesce(p.city, s.city, m.city, '') AS city, substr(coalesce(p.state, s.state, m.state, ''), 1, 2) AS state,
    a.branch_id AS branch_of_ownership, coalesce(e.email, se.email, m.email_domain, '') AS electronic_mail,
    CASE WHEN dm.method IS NOT NULL THEN '1' WHEN m.customer_id IS NOT NULL THEN CASE WHEN m.delivery_pref IN ('Paper and Electronic', 'Paper') THEN '1' ELSE '0' END
     WHEN d.comm_mode = 'Mail' THEN '1' ELSE '0' END AS paper_indicator,
    CASE WHEN m.customer_id IS NOT NULL THEN CASE WHEN m.delivery_pref IN ('Paper and Electronic', 'Electronic') THEN '1' ELSE '0' END WHEN d.comm_mode = 'Email' THEN '1' ELSE '0' END AS secure_indicator,
    CASE d.notify_mode WHEN 'SMS' THEN 'Text' WHEN 'Email' THEN 'Email' WHEN 'Email, SMS' THEN 'Email, Text' END AS notification_method
    FROM d LEFT JOIN ps ON d.customer_id = ps.customer_id AND d.account_id = ps.account_id LEFT JOIN pa ON d.customer_id = pa.customer_id AND d.account_id = pa.account_id
    LEFT JOIN pc ON d.customer_id = pc.customer_id LEFT JOIN direct dm ON d.customer_id = dm.customer_id AND d.account_id = dm.account_id
    LEFT JOIN postal p ON d.customer_id = p.customer_id AND lower(p.addr_type) = lower(coalesce(ps.addr_type, pa.addr_type, pc.addr_type)) AND p.seq = coalesce(ps.seq, pa.seq, pc.seq)
    LEFT JOIN sole s ON d.customer_id = s.customer_id LEFT JOIN customer_master m ON d.customer_id = m.customer_id LEFT JOIN deposit_account a ON d.account_id = a.account_id
    LEFT JOIN mail e ON d.customer_id = e.customer_id AND e.email_type = 'Primary' AND e.seq = 1 LEFT JOIN sole_mail se ON d.customer_id = se.customer_id""",
)
def _(t):
    return statements.contact_record(
        _driver(t), t.postal_address, t.address_pref, t.email_address, t.customer_master, t.deposit_account, RUN
    )


# --- 792, 995 ------------------------------------------------------------------------------


def _json(path: str) -> str:
    return f"json_extract_string(summary, '$.arStmtCrLineSumm[' || i || '].{path}')"


@query(
    "report_credit_lines",
    with_roles("account_statement", "credit_summary")
    + _driver_sql()
    + f""", s AS (SELECT account_id, {_json('apr')} AS apr, {_json('fnceChrg')} AS fc, {_json('frmDte')} AS f, {_json('toDte')} AS u, {_json('perdcRte')} AS pr, {_json('prinOutstdBal')} AS pb
      FROM credit_summary, (VALUES (0), (1)) v(i) WHERE day {_IN}) """
    + _prefix("792")
    + f""", d.account_id AS account_number, {_implied('CAST(s.apr AS DECIMAL(26,10))', 14, 10)} AS apr, {_implied('CAST(s.fc AS DECIMAL(26,10))')} AS finance_charge, s.f AS from_date, s.u AS to_date,
    {_implied('CAST(s.pr AS DECIMAL(26,10))', 14, 10)} AS periodic_rate, {_implied('CAST(s.pb AS DECIMAL(26,10))')} AS principal_outstanding
    FROM d JOIN (SELECT * FROM s WHERE apr <> '') s ON d.account_id = s.account_id""",
)
def _(t):
    return statements.credit_line_record(_driver(t), t.credit_summary, RUN)


@query(
    "report_control_counts",
    with_roles("account_statement", "org_unit")
    + f""", rec AS (SELECT statement_type AS form_id, ledger_id, count(*) AS cnt FROM
      (SELECT DISTINCT statement_type, ledger_id, customer_id, account_id FROM account_statement WHERE starts_on {_IN}) GROUP BY ALL)
    SELECT DISTINCT '995' AS rec_typ, 'ZZZZZZZ' AS accnt_nmbr, 'ZZZZZZZ' AS uuid, form_id || '100' AS sort_order, '995' AS sort_order_1, 'ZZZZZZ-ZZZZZZZ' AS filter_val,
    unit_id AS company_code, form_id AS form_type, '100' AS form_variation, cnt AS total_records FROM org_unit JOIN rec USING (ledger_id) WHERE unit_type = 'Financial Entity'""",
)
def _(t):
    return statements.control_record(t.account_statement, t.org_unit, RUN)
