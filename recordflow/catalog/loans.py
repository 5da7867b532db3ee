"""Loan reports over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.catalog.registry import query
from recordflow.catalog.roles import with_roles
from recordflow.plans.reports import loans
from recordflow.plans.reports.run import Run

RUN = Run("1998-01-01", "1998-12-31")
_IN = "BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"
_US = "'%m-%d-%Y'"


def _shown(col: str) -> str:
    return f"coalesce(format('{{:,.2f}}', CAST(CAST({col} AS DECIMAL(17,2)) AS DOUBLE)), '0.00')"


def _page(order: str, size: int) -> str:
    return f"CAST(ceil(row_number() OVER (ORDER BY {order}) / {size}.0) AS BIGINT)"


# --- early-paid loans ----------------------------------------------------------------------

_COUNTS = " || ',' || ".join(
    f"'{days}-' || CAST(CASE WHEN c.period = 'LifeToDate' AND c.code = '{code}' THEN c.counter ELSE 0 END AS VARCHAR)"
    for code, days in loans.PAST_DUE_DAYS.items()
)
_EARLY = (
    with_roles("loan_bill", "loan_account", "loan_balance", "loan_counter", "customer_master")
    + f""", b AS (SELECT * FROM loan_balance WHERE day = (SELECT max(day) FROM loan_balance)),
  c AS (SELECT * FROM loan_counter WHERE day = (SELECT max(day) FROM loan_counter)),
  x AS (SELECT p.account_id AS loan_number, p.ledger_id, a.customer_id,
    CASE WHEN m.customer_id IS NOT NULL THEN concat_ws(',', nullif(m.name_line, ''), nullif(m.line1, ''), nullif(m.city, ''), nullif(m.state, '')) END AS name_address,
    coalesce(m.home_phone, m.mobile_phone) AS phone, a.branch_id, a.substate AS processing_state, a.product_code, a.product_name, a.contract_amount, p.bill_amount,
    b.principal, b.late_charge, b.fee_due, CAST(abs(date_diff('day', p.paid_on, p.due_on)) AS VARCHAR) AS days_ahead, strftime(p.paid_on, {_US}) AS paid_date,
    coalesce(strftime(b.past_due_since, {_US}), '') AS old_due_date,
    CASE WHEN c.period = 'LifeToDate' AND c.code LIKE 'NoOfExtsns%' THEN c.counter END AS ext, {_COUNTS} AS hist
    FROM loan_bill p LEFT JOIN loan_account a ON p.account_id = a.account_id AND p.ledger_id = a.ledger_id
    LEFT JOIN b ON p.account_id = b.account_id AND p.ledger_id = b.ledger_id LEFT JOIN c ON p.account_id = c.account_id AND p.ledger_id = c.ledger_id
    LEFT JOIN customer_master m ON a.customer_id = m.customer_id AND a.ledger_id = m.ledger_id
    WHERE p.bill_status = 'Paid' AND p.due_on > p.paid_on AND p.paid_on {_IN} AND coalesce(p.ledger_id, '') IN ('1', '2', '3')),
  y AS (SELECT * EXCLUDE (ext, hist), CAST(sum(ext) AS INTEGER) AS extensions, array_to_string(list_sort(list_distinct(list(hist))), ',') AS credit_history FROM x GROUP BY ALL)"""
)
_MONEY = ["contract_amount", "bill_amount", "principal", "late_charge", "fee_due"]


@query(
    "report_early_paid",
    _EARLY
    + f""" SELECT * REPLACE ({', '.join(f'{_shown(m)} AS {m}' for m in _MONEY)}),
    {_page('loan_number, ledger_id, days_ahead, paid_date, old_due_date, extensions NULLS FIRST, credit_history, contract_amount, bill_amount, principal NULLS FIRST, late_charge NULLS FIRST', 10)} AS pagenbr FROM y""",
)
def _(t):
    lines = loans.early_paid(
        t.loan_bill, t.loan_account, t.loan_balance, t.loan_counter, t.customer_master, RUN, ledgers="1,2,3"
    )
    return loans.early_paid_pages(lines)


# --- delinquent loans ----------------------------------------------------------------------


def _newest(table: str, keys: str, where: str, order: str, name: str) -> str:
    return f"""{name} AS (SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn_
    FROM {table} WHERE {where}) WHERE rn_ = 1)"""


_LATE = (
    with_roles("loan_account", "loan_balance", "loan_counter", "loan_rate", "loan_bill", "customer_master")
    + f""", late AS (SELECT b.* FROM loan_balance b JOIN (SELECT account_id AS k, max(day) AS d FROM loan_balance WHERE day {_IN} GROUP BY 1)
      ON account_id = k AND day = d WHERE coalesce(days_late, 0) > 0), """
    + ", ".join(
        [
            _newest("loan_bill", "account_id", "true", "paid_on DESC, bill_number DESC", "act"),
            _newest("loan_counter", "account_id", "code = 'NoOfPaymentsReceived' AND period = 'LifeToDate'", "day DESC, counter DESC", "cnt"),
            _newest("loan_rate", "account_id", "true", "booked_on DESC, line_nbr, part_id, dealer_id", "rate"),
            _newest("loan_bill", "account_id", "true", "updated_on DESC, dealer_id", "dlr"),
        ]
    )
    + """, x AS (SELECT a.account_id AS loan_number, a.substate AS processing_state, r.interest_type AS interest_kind, l.principal, l.late_charge, l.past_due AS amount_past_due,
    coalesce(strftime(t.paid_on, '%m-%d-%Y'), '') AS last_payment_date, strftime(a.next_due_on, '%m-%d-%Y') AS next_due_date,
    CASE WHEN a.employee_flag = 'Y' THEN 'XXXXXXXX' ELSE a.customer_id END AS customer_number, CASE WHEN a.employee_flag = 'Y' THEN 'XXXXXXXX' ELSE m.name_line END AS short_name,
    l.interest, l.fee_due, strftime(l.past_due_since, '%m-%d-%Y') AS old_due_date, CAST(d.dealer_id AS VARCHAR) AS dealer_number, coalesce(a.collateral_code, 'Unsecured Loan') AS collateral,
    a.contract_amount, l.days_late, c.counter AS payments, a.branch_id, a.ledger_id, a.product_name, a.currency
    FROM loan_account a JOIN late l ON a.account_id = l.account_id AND a.ledger_id = l.ledger_id LEFT JOIN act t ON a.account_id = t.account_id
    LEFT JOIN cnt c ON a.account_id = c.account_id AND a.ledger_id = c.ledger_id
    LEFT JOIN (SELECT * FROM rate WHERE charge_type = 'DebitInterest') r ON a.account_id = r.account_id AND a.ledger_id = r.ledger_id
    LEFT JOIN customer_master m ON a.customer_id = m.customer_id LEFT JOIN dlr d ON a.account_id = d.account_id
    WHERE upper(a.status) = 'ACTIVE' AND a.substate IN ('Normal', 'PartialChargeOff', 'ChargeOff') AND coalesce(a.ledger_id, '') IN ('0', '2', '4'))"""
)


@query(
    "report_delinquent",
    _LATE
    + f" SELECT *, {_page('customer_number, loan_number, processing_state, interest_kind NULLS FIRST, principal, late_charge', 10)} AS pagenbr FROM x",
)
def _(t):
    activity = t.loan_bill.select("account_id", F.col("paid_on").alias("day"), F.col("bill_number").alias("tie"))
    dealers = t.loan_bill.select("account_id", F.col("updated_on").alias("day"), "dealer_id")
    params = {"ledger_id": "0,2,4", "customer_number": "", "branch_id": "99999998"}
    rows = loans.delinquent(
        t.loan_account, t.loan_balance, activity, t.loan_counter, t.loan_rate, t.customer_master, dealers, RUN, params
    )
    return loans.delinquent_pages(rows)


# --- trial balance -------------------------------------------------------------------------

_DONE = "((upper(a.status) = 'ACTIVE' AND a.substate = 'PaidOff') OR (upper(a.status) = 'SETTLED' AND a.substate = 'Closed'))"
_TRIAL = (
    with_roles("loan_account", "customer_master", "org_unit", "loan_bill", "loan_counter", "loan_balance", "loan_rate")
    + ", "
    + ", ".join(
        [
            _newest(
                "loan_bill",
                "account_id",
                "true",
                "updated_on DESC, bill_number DESC, CASE lower(bill_status) WHEN 'paid' THEN 2 WHEN 'due' THEN 1 ELSE 0 END DESC, part_id, dealer_id",
                "bill",
            ),
            _newest("loan_rate", "account_id", "charge_type = 'DebitInterest'", "booked_on DESC, accrual_factor DESC NULLS LAST, interest_type, accrues_from", "rate"),
        ]
    )
    + """, e0 AS (SELECT * FROM loan_counter WHERE code IN ('NoOfExtsnsForPymntDueDateChange', 'NoOfExtsnsForDelinquency', 'NoOfExtsnsForPromotional') AND period = 'LifeToDate'),
  ext AS (SELECT account_id, ledger_id, code, CAST(sum(coalesce(counter, 0)) AS BIGINT) AS extensions FROM e0 JOIN (SELECT account_id AS k, max(day) AS d FROM e0 GROUP BY 1) ON account_id = k AND day = d GROUP BY 1, 2, 3),
  bal AS (SELECT * FROM loan_balance WHERE day = (SELECT max(day) FROM loan_balance)),
  freq AS (SELECT account_id, ledger_id, json_extract_string(payment_frequency, '$.pmtFreq[0].typ') AS typ, json_extract_string(payment_frequency, '$.pmtFreq[0].val') AS val FROM loan_account),
  detail AS (SELECT DISTINCT a.account_id AS loan_number, a.customer_id, m.name_line AS customer_name, o.unit_name AS cost_centre, a.currency, b.principal, b.interest,
    CASE WHEN r.accrues_from <= DATE '1999-07-28' THEN CAST(abs(coalesce(b.principal, 0) * coalesce(r.accrual_factor, 0)) AS DECIMAL(38,4)) ELSE CAST(0 AS DECIMAL(38,4)) END AS per_diem,
    a.branch_id, a.product_code, r.interest_type, a.rate, strftime(a.opened_on, '%m-%d-%Y') AS issued, strftime(a.matures_on, '%m-%d-%Y') AS matures,
    CASE WHEN """
    + _DONE
    + """ THEN 'Not Applicable' ELSE strftime(a.next_due_on, '%m-%d-%Y') END AS next_due_date,
    CASE WHEN """
    + _DONE
    + """ THEN '00099999999' ELSE CAST(CAST(coalesce(g.bill_amount, 0) AS DECIMAL(26,2)) AS VARCHAR) END AS next_payment,
    a.status || '-' || a.substate AS loan_status, e.extensions, b.days_late, concat_ws('-', f.typ, f.val) AS payment_frequency,
    CASE WHEN """
    + _DONE
    + """ THEN '00099999999' ELSE CAST(CAST(coalesce(a.scheduled_amount, 0) AS DECIMAL(26,2)) AS VARCHAR) END AS payment_amount, b.late_charge, a.ledger_id
    FROM loan_account a LEFT JOIN customer_master m ON a.customer_id = m.customer_id LEFT JOIN org_unit o ON a.branch_id = o.unit_id
    LEFT JOIN bill g ON a.account_id = g.account_id AND a.ledger_id = g.ledger_id LEFT JOIN ext e ON a.account_id = e.account_id AND a.ledger_id = e.ledger_id
    LEFT JOIN bal b ON a.account_id = b.account_id AND a.ledger_id = b.ledger_id LEFT JOIN freq f ON a.account_id = f.account_id AND a.ledger_id = f.ledger_id
    LEFT JOIN rate r ON a.account_id = r.account_id AND a.ledger_id = r.ledger_id
    WHERE NOT (upper(a.status) = 'SETTLED' AND upper(a.substate) = 'CLOSED' AND year(a.closed_on) <> 1999))"""
)


def _detail(t):
    return loans.trial_detail(
        t.loan_account, t.customer_master, t.org_unit, t.loan_bill, t.loan_counter, t.loan_balance, t.loan_rate, "1999-07-28"
    )


@query("report_trial_detail", _TRIAL + " SELECT * FROM detail")
def _(t):
    return _detail(t)


def _loan_periods(t):
    """Balances by code of loan accounts: the orders themselves."""
    return t.period_balance.withColumn("account_id", F.col("row_id").cast("string"))


_CELLS = "((code = 'TotalInterestCollected' AND period = 'Yearly') OR (code = 'TotalFeeReceivable' AND period IN ('LifeToDate', 'BillingCycle')) OR (code = 'TotalFeeCollected' AND period = 'Yearly'))"


@query(
    "report_trial_balances",
    with_roles("period_balance")
    + f""" SELECT * EXCLUDE (r) FROM (SELECT *, dense_rank() OVER (PARTITION BY account_id, code, period ORDER BY batch_date DESC) AS r FROM period_balance WHERE {_CELLS})
    WHERE r = 1 AND DATE '2001-07-28' BETWEEN valid_from AND valid_to""",
)
def _(t):
    return loans.trial_balances(t.period_balance, "2001-07-28")


def _cell(code: str, period: str, name: str) -> str:
    return f"max(amount) FILTER (WHERE code = '{code}' AND period = '{period}') AS {name}"


@query(
    "report_trial_balance",
    _TRIAL.replace("WITH ", with_roles("period_balance") + ", ", 1)
    + f""", p AS (SELECT * REPLACE (CAST(row_id AS VARCHAR) AS account_id) FROM period_balance),
  q AS (SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY account_id, code, period ORDER BY batch_date DESC) AS r FROM p WHERE {_CELLS}) WHERE r = 1 AND DATE '1999-07-28' BETWEEN valid_from AND valid_to),
  w AS (SELECT account_id, ledger_id, {', '.join(_cell(c, p, n) for (c, p), n in loans.TRIAL_CELLS.items())} FROM q GROUP BY ALL),
  x AS (SELECT d.*, w.interest_paid_ytd, w.fee, w.fee_current, w.fee_paid_ytd FROM detail d LEFT JOIN w ON d.loan_number = w.account_id AND d.ledger_id = w.ledger_id
    WHERE coalesce(d.ledger_id, '') IN ('1', '3'))
  SELECT *, {_page('loan_number, extensions NULLS FIRST, principal, per_diem, interest, days_late, late_charge', 100)} AS pagenbr FROM x""",
)
def _(t):
    params = {"ledger_id": "1,3", "branch_id": "99999998", "loan_number": ""}
    return loans.trial_pages(loans.trial_balance(_detail(t), _loan_periods(t), "1999-07-28", params))


# --- forgiven debt -------------------------------------------------------------------------


def _last(code: str, name: str) -> str:
    return f"""{name} AS (SELECT b.* FROM period_balance b JOIN (SELECT account_id AS k, max(batch_date) AS d FROM period_balance
      WHERE code = '{code}' AND period = 'Yearly' AND batch_date {_IN} GROUP BY 1) ON account_id = k AND batch_date = d
      WHERE code = '{code}' AND period = 'Yearly' AND batch_date BETWEEN valid_from AND valid_to)"""


_CHARGED = "SELECT account_id, ledger_id, branch_id, customer_id, CASE WHEN status = 'Active' THEN 'ChargeOff' ELSE 'Normal' END AS substate FROM deposit_account"


@query(
    "report_forgiven_debt",
    with_roles("period_balance", "deposit_account", "customer_master")
    + f""", a AS ({_CHARGED}), {_last('ForgivenDebt', 'd')}, {_last('ForgivenInterest', 'i')},
  x AS (SELECT a.ledger_id AS financial_entity, a.branch_id, a.account_id, m.name_line AS customer_name, CAST(d.amount AS DECIMAL(38,4)) AS forgiven_debt,
    CAST(i.amount AS DECIMAL(38,4)) AS forgiven_interest, a.ledger_id FROM a JOIN d ON a.account_id = d.account_id AND a.ledger_id = d.ledger_id
    JOIN i ON a.account_id = i.account_id AND a.ledger_id = i.ledger_id LEFT JOIN customer_master m ON a.customer_id = m.customer_id AND a.ledger_id = m.ledger_id
    WHERE a.substate IN ('PartialChargeOff', 'ChargeOff')),
  y AS (SELECT *, '0' AS dataordering FROM x UNION ALL SELECT 'Total', '', '', '', CAST(sum(forgiven_debt) AS DECIMAL(38,4)), CAST(sum(forgiven_interest) AS DECIMAL(38,4)), ledger_id, '1' FROM x GROUP BY ledger_id)
  SELECT *, {_page('financial_entity, branch_id, account_id, ledger_id, forgiven_debt, forgiven_interest', 10)} AS pagenbr FROM y""",
)
def _(t):
    state = F.when(F.col("status") == "Active", "ChargeOff").otherwise("Normal")
    rows = loans.forgiven_debt(t.deposit_account.withColumn("substate", state), t.period_balance, t.customer_master, 1998)
    return loans.forgiven_debt_pages(rows)
