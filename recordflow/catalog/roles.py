"""Roles: the reporting inputs, derived from the driver's tables.

Each role is one SELECT in the part of SQL that Spark and DuckDB share, over whole tables.
``{name}`` stands for a driver table, ``<<`` and ``>>`` for literal braces. Both the Spark queries and their SQL twins start from
these definitions; the operators under test come after.
"""

from __future__ import annotations

from recordflow.plans.reports.masters import STATEMENT_CELLS

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_EPOCH_MS_SPARK = (
    "(unix_date(CAST(ts AS DATE)) * 86400000L + hour(ts) * 3600000 + minute(ts) * 60000"
    " + CAST(floor(extract(SECOND FROM ts) * 1000) AS BIGINT))"
)


def spark_dialect(text: str) -> str:
    return text.replace("EPOCH_MS_TS", _EPOCH_MS_SPARK).replace("<<", "{{").replace(">>", "}}")


def duck_dialect(text: str) -> str:
    for table in TABLES:
        text = text.replace("{" + table + "}", table)
    return text.replace("EPOCH_MS_TS", "(epoch_us(ts) // 1000)").replace("<<", "{").replace(">>", "}")


def case(col: str, mapping: dict[str, str | None], other: str = "NULL") -> str:
    """CASE text for a code translation."""

    def lit(value: str | None) -> str:
        return "NULL" if value is None else "'" + value.replace("'", "''") + "'"

    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {col} {arms} ELSE {other} END"


def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(26,4))"


_DATE8 = "replace(CAST({0} AS STRING), '-', '')"


def date8(expr: str) -> str:
    return _DATE8.format(expr)


ORDER_DAY = "CAST(o_orderdate AS DATE)"
SHIP_DAY = "CAST(l_shipdate AS DATE)"
# Line items with the ledger of their order's customer.
LINES = (
    "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey "
    "JOIN {nation} ON c_nationkey = n_nationkey"
)
ORDERS = "{orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"
PARTIES = "{customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"

PERIODS = {"F": "Yearly", "O": "LifeToDate", "P": "BillingCycle"}


def period_balances(codes: dict[str, str]) -> str:
    """Long balances of customer accounts: one row per order, its priority as the code."""
    return f"""
SELECT CAST(o_custkey AS STRING) AS account_id, CAST(n_regionkey AS STRING) AS ledger_id,
       {case('o_orderpriority', codes)} AS code, {case('o_orderstatus', PERIODS)} AS period,
       {money('o_totalprice')} AS amount, {ORDER_DAY} AS batch_date,
       make_date(CAST(year(o_orderdate) AS INT), 1, 1) AS valid_from,
       make_date(CAST(year(o_orderdate) AS INT), 12, 31) AS valid_to,
       {date8(ORDER_DAY)} AS full_date, o_orderkey AS row_id
FROM {ORDERS}"""


P1, P2, P3, P4, P5 = "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"

MASTER_CODES = sorted({code for _, code in STATEMENT_CELLS})

ROLES: dict[str, str] = {
    # --- customer records -----------------------------------------------------------------
    "event_rows": f"""
SELECT event_id, '42' AS tenant_id,
       (CASE WHEN value >= 50 THEN 'C_' ELSE 'S_' END) || CAST(user_id AS STRING) AS customer_id,
       {case('event_type', {'signup': 'NAME', 'view': 'ADDRESS', 'click': 'ADDRESS', 'purchase': 'IDENTIFICATION'}, "'OTHER'")} AS event_type,
       {case('event_type', {'view': 'HOME', 'click': 'WORK', 'purchase': 'passport'}, "''")} AS item_type,
       EPOCH_MS_TS AS event_timestamp, CAST(ts AS DATE) AS logical_date,
       CAST(event_id AS STRING) AS id_text, props
FROM {{events}}""",
    "party_rows": f"""
SELECT 'C_' || CAST(c_custkey AS STRING) AS customer_id, 'C' AS partition_id,
       substr(c_name, 10) AS first_name, substr(c_name, 1, 8) AS last_name,
       c_mktsegment AS street, n_name AS city, CAST(n_nationkey AS STRING) AS postal_code, r_name AS country,
       c_name AS id_number
FROM {PARTIES}
UNION ALL
SELECT 'S_' || CAST(s_suppkey AS STRING), 'S', substr(s_name, 10), substr(s_name, 1, 8),
       CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), s_name
FROM {{supplier}}""",
    # --- loans: an order is an account, its lines are the account's activity ---------------
    "loan_account": f"""
SELECT CAST(o_orderkey AS STRING) AS account_id, CAST(n_regionkey AS STRING) AS ledger_id,
       CAST(c_nationkey AS STRING) AS branch_id, CAST(o_custkey AS STRING) AS customer_id,
       {case('o_orderstatus', {'F': 'SETTLED'}, "'ACTIVE'")} AS status,
       {case('o_orderpriority', {P1: 'ChargeOff', P2: 'PartialChargeOff', P3: 'Normal', P4: 'Closed', P5: 'PaidOff'})} AS substate,
       o_orderpriority AS product_code, c_mktsegment AS product_name, c_mktsegment AS currency,
       {case('c_mktsegment', {'FURNITURE': 'Y'}, "'N'")} AS employee_flag,
       {case('o_orderpriority', {P1: 'Vehicle', P3: 'Property'})} AS collateral_code,
       {money('o_totalprice')} AS contract_amount, {ORDER_DAY} AS opened_on,
       {ORDER_DAY} + 1800 AS matures_on, {ORDER_DAY} + 30 AS next_due_on,
       CASE WHEN o_orderstatus = 'F' THEN {ORDER_DAY} + 400 END AS closed_on,
       {money('o_totalprice / 12')} AS scheduled_amount,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'TRUE' ELSE 'FALSE' END AS shadow_flag,
       CAST(c_nationkey AS DECIMAL(14,10)) AS rate,
       c_name || chr(10) || o_orderpriority || chr(10) || c_mktsegment || ' account ' || CAST(o_orderkey AS STRING) || ' opened for the customer named above' AS title,
       '<<"pmtFreq":[<<"balTyp":"Interest","typ":"' || o_orderpriority || '","val":"' || CAST(n_regionkey AS STRING) || '">>,<<"balTyp":"Principal","typ":"M","val":"1">>]>>' AS payment_frequency
FROM {ORDERS}""",
    "loan_balance": f"""
SELECT CAST(l_orderkey AS STRING) AS account_id, CAST(n_regionkey AS STRING) AS ledger_id,
       {SHIP_DAY} AS day, {date8(SHIP_DAY)} AS full_date,
       {money('l_extendedprice')} AS principal, {money('l_quantity')} AS late_charge,
       {money('l_quantity * 2')} AS fee_due, {money('l_quantity * 3')} AS past_due,
       {money('l_quantity * 5')} AS interest, CAST(l_quantity - 10 AS INT) AS days_late,
       {SHIP_DAY} - 15 AS past_due_since
FROM {LINES}""",
    "loan_counter": f"""
SELECT CAST(l_orderkey AS STRING) AS account_id, CAST(n_regionkey AS STRING) AS ledger_id,
       CASE l_linenumber WHEN 1 THEN 'NoOfExtsnsForDelinquency' WHEN 2 THEN 'NoOfExtsnsForPromotional'
            WHEN 3 THEN 'NoOfExtsnsForPymntDueDateChange' WHEN 4 THEN 'NoOfPaymentsReceived'
            WHEN 5 THEN 'TimesPastDue1' WHEN 6 THEN 'TimesPastDue2' ELSE 'TimesPastDue3' END AS code,
       CASE l_linestatus WHEN 'F' THEN 'LifeToDate' ELSE 'BillingCycle' END AS period,
       CAST(l_quantity AS BIGINT) AS counter, {SHIP_DAY} AS day
FROM {LINES}""",
    "loan_bill": f"""
SELECT CAST(l_orderkey AS STRING) AS account_id, CAST(n_regionkey AS STRING) AS ledger_id,
       CASE l_linestatus WHEN 'F' THEN 'Paid' ELSE 'Due' END AS bill_status,
       {ORDER_DAY} + 60 AS due_on, {SHIP_DAY} AS paid_on, {money('l_extendedprice')} AS bill_amount,
       CAST(l_linenumber AS BIGINT) AS bill_number, {SHIP_DAY} AS updated_on, l_returnflag AS process,
       l_partkey AS part_id, l_suppkey AS dealer_id
FROM {LINES}""",
    "loan_rate": f"""
SELECT CAST(l_orderkey AS STRING) AS account_id, CAST(n_regionkey AS STRING) AS ledger_id,
       CASE l_returnflag WHEN 'R' THEN 'DebitInterest' ELSE 'Fee' END AS charge_type,
       CASE WHEN l_discount > 0 THEN CAST(l_discount AS DECIMAL(14,10)) END AS accrual_factor,
       l_linestatus AS interest_type, {SHIP_DAY} AS booked_on, {SHIP_DAY} + 10 AS accrues_from,
       l_linenumber AS line_nbr, l_partkey AS part_id, l_suppkey AS dealer_id
FROM {LINES}""",
    "loan_txn": f"""
SELECT CAST(l_orderkey AS STRING) AS account_id,
       CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS txn_id,
       CASE l_linenumber WHEN 1 THEN 'ACHPrincipalPayment' WHEN 2 THEN 'InterestPayment'
            WHEN 3 THEN 'LateChargeFeePayment' WHEN 4 THEN 'MiscellaneousFeePayment' WHEN 5 THEN 'ChargeOff'
            WHEN 6 THEN 'PrincipalPayment' ELSE 'Transfer' END AS posting_code,
       CASE l_returnflag WHEN 'R' THEN 'Debit' ELSE 'Credit' END AS direction,
       {money('l_extendedprice')} AS amount, {money('l_quantity')} AS interest_due, {SHIP_DAY} AS posted_on
FROM {{lineitem}}""",
    "loan_statement": f"""
SELECT CAST(o_orderkey AS STRING) AS account_id, CAST(o_custkey AS STRING) AS customer_id,
       CAST(n_regionkey AS STRING) AS ledger_id, 'U' || CAST(o_orderkey AS STRING) AS message_id,
       {case('o_orderstatus', {'P': 'SummaryStatement'}, "'DetailedStatement'")} AS statement_type,
       {case('o_orderpriority', {P1: 'HomeLineOfCredit', P2: 'LineOfCredit', P3: 'LineOfCreditPlus'}, "'TermLoan'")} AS product,
       {ORDER_DAY} AS starts_on, {ORDER_DAY} + 60 AS ends_on, {date8(ORDER_DAY)} AS full_date,
       {money('o_totalprice')} AS closing_balance, {money('o_totalprice * 2')} AS principal_balance,
       CASE WHEN o_orderstatus = 'O' THEN {money('o_totalprice / 4')} END AS past_due,
       {money('o_totalprice / 5')} AS current_due,
       {case('o_orderstatus', {'O': 'Yes'}, "'No'")} AS post_maturity,
       {case('o_orderpriority', {P1: 'SecureEMessage', P2: 'Mail'}, "'Email'")} AS comm_mode,
       {case('o_orderpriority', {P1: 'Email, SMS', P2: 'SMS', P3: 'Email'}, "''")} AS notify_mode
FROM {ORDERS}""",
    # --- deposits: a customer is an account, its orders are balances ------------------------
    "deposit_account": f"""
SELECT CAST(c_custkey AS STRING) AS account_id, CAST(n_regionkey AS STRING) AS ledger_id,
       CAST(c_nationkey AS STRING) AS branch_id, CAST(c_custkey AS STRING) AS customer_id,
       {case('c_mktsegment', {'MACHINERY': 'Savings', 'FURNITURE': 'MMDA', 'HOUSEHOLD': 'TimeDeposit'}, "'Checking'")} AS family,
       c_mktsegment AS product_code, c_name AS title, r_name AS currency, n_name AS index_name,
       CASE WHEN c_acctbal >= 0 THEN 'Active' ELSE 'Settled' END AS status,
       CASE WHEN c_acctbal < 0 THEN make_date(1996 + n_regionkey, 6, 30) END AS closed_on,
       CASE WHEN n_regionkey > 0 THEN CAST(n_nationkey AS DECIMAL(14,10)) END AS rate,
       CASE WHEN c_acctbal > 5000 THEN 'Unredeemed' ELSE 'Open' END AS substate,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'NoAccrual' ELSE 'Accrual' END AS unredeemed_option,
       make_date(1990 + n_regionkey, 1, 15) AS opened_on, {money('c_acctbal')} AS first_deposit
FROM {PARTIES}""",
    "deposit_daily": f"""
SELECT CAST(o_custkey AS STRING) AS account_id, CAST(n_regionkey AS STRING) AS ledger_id,
       {ORDER_DAY} AS day, {money('o_totalprice')} AS ledger_balance, {money('o_totalprice * 0.01')} AS accrued_interest,
       {money('o_totalprice * 2')} AS running_balance, {money('o_totalprice * 0.5')} AS interest_paid,
       o_orderkey AS row_id
FROM {ORDERS}""",
    "deposit_txn": f"""
SELECT CAST(o_custkey AS STRING) AS account_id, {SHIP_DAY} AS day,
       CASE l_linenumber WHEN 1 THEN 'ClearingCheckWithdrawal' WHEN 2 THEN 'RemoteDepositCheckExternal'
            WHEN 3 THEN 'CreditInterest' ELSE 'Transfer' END AS posting_code,
       CASE l_returnflag WHEN 'R' THEN 'Debit' ELSE 'Credit' END AS direction,
       {money('l_extendedprice')} AS amount,
       CASE l_linestatus WHEN 'F' THEN 'InternalArrangement' ELSE 'Deposit' END AS arrangement,
       CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS txn_id
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "ledger_entry": f"""
SELECT CAST(o_custkey AS STRING) AS account_id, {SHIP_DAY} AS booked_on,
       CASE l_linestatus WHEN 'F' THEN {SHIP_DAY} ELSE {SHIP_DAY} + 1 END AS effective_on,
       CASE l_returnflag WHEN 'A' THEN 'reversal' ELSE 'accrual' END AS operation,
       CASE l_returnflag WHEN 'R' THEN 'Liability' ELSE 'Expense' END AS gl_class,
       {money('l_extendedprice - 50000')} AS credit, {money('l_quantity')} AS debit
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "period_balance": period_balances(
        {P1: "TotalFeeCollected", P2: "TotalInterestCollected", P3: "TotalFeeReceivable", P4: "ForgivenDebt", P5: "ForgivenInterest"}
    ),
    "deposit_balance": period_balances(
        {P1: "InterestPaidBalance", P2: "EarlyWithdrawalPenaltyCharged", P3: "FATCATaxPaid", P4: "FederalTaxPaid", P5: "DistributionFederalTax"}
    ),
    # Every code of the master record in turn, by the number of the order.
    "master_balance": period_balances({}).replace(
        "CASE o_orderpriority  ELSE NULL END AS code",
        case(f"CAST(CAST(o_orderkey AS BIGINT) % {len(MASTER_CODES)} AS STRING)", {str(i): c for i, c in enumerate(MASTER_CODES)}) + " AS code",
    ),
    "incentive_balance": period_balances(
        {
            P1: "CustIncentiveMiscPaymentBal",
            P2: "CustGoodwillMiscPaymentBal",
            P3: "CustIncentiveGiftCashMiscBal",
            P4: "IncentiveFederaltaxBalance",
            P5: "IncentiveFATCATaxBalance",
        }
    ),
    "customer_master": f"""
SELECT CAST(c_custkey AS STRING) AS customer_id, CAST(n_regionkey AS STRING) AS ledger_id, c_name AS name_line,
       {case('c_mktsegment', {'MACHINERY': 'W-8BEN', 'FURNITURE': 'W8 form', 'HOUSEHOLD': 'Status NRA', 'BUILDING': 'Foreign person'}, "'W-9'")} AS tax_status,
       CASE WHEN c_acctbal > 0 THEN '555-' || CAST(c_custkey AS STRING) END AS home_phone,
       '777-' || CAST(c_custkey AS STRING) AS mobile_phone,
       CASE WHEN n_regionkey = 1 THEN '' ELSE c_mktsegment END AS line1, CASE WHEN n_regionkey = 2 THEN NULL ELSE n_name END AS city,
       r_name AS state, make_date(1960 + n_nationkey, 1 + n_regionkey, 1 + n_nationkey) AS birth_date,
       {case('c_mktsegment', {'MACHINERY': 'Electronic', 'FURNITURE': 'Paper and Electronic', 'HOUSEHOLD': 'Paper'})} AS delivery_pref,
       CASE WHEN n_regionkey < 2 THEN 'Driver''s License' ELSE 'Passport' END AS id_type, 'ID' || CAST(c_custkey AS STRING) AS id_number,
       r_name AS id_issuer, n_name AS email_domain
FROM {PARTIES}""",
    # --- statement records: a customer is an account, each of its orders a statement --------
    "account_statement": f"""
SELECT CAST(o_custkey AS STRING) AS account_id, CAST(o_custkey AS STRING) AS customer_id,
       CAST(n_regionkey AS STRING) AS ledger_id, 'U' || CAST(o_orderkey AS STRING) AS message_id,
       {case('o_orderstatus', {'P': 'SummaryStatement'}, "'DetailedStatement'")} AS statement_type,
       {case('o_orderpriority', {P1: 'HomeLineOfCredit', P2: 'LineOfCredit', P3: 'LineOfCreditPlus'}, "'TermLoan'")} AS product,
       {ORDER_DAY} AS starts_on, {ORDER_DAY} + 60 AS ends_on,
       {money('o_totalprice')} AS closing_balance, {money('o_totalprice * 2')} AS principal_balance,
       CASE WHEN o_orderstatus = 'O' THEN {money('o_totalprice / 4')} END AS past_due,
       {money('o_totalprice / 5')} AS current_due, {case('o_orderstatus', {'O': 'Yes'}, "'No'")} AS post_maturity,
       {case('o_orderpriority', {P1: 'SecureEMessage', P2: 'Mail'}, "'Email'")} AS comm_mode,
       {case('o_orderpriority', {P1: 'Email, SMS', P2: 'SMS', P3: 'Email'}, "''")} AS notify_mode,
       {money('o_totalprice * 0.02')} AS interest_due, {money('o_totalprice * 0.03')} AS principal_due,
       CASE WHEN o_orderstatus <> 'F' THEN {money('o_totalprice * 0.04')} END AS late_charge_due, {money('o_totalprice * 0.06')} AS late_charge_collected,
       {money('o_totalprice * 0.07')} AS fee_assessed, {money('o_totalprice * 0.08')} AS payments_made, {money('o_totalprice * 0.09')} AS payoff_penalty,
       {money('o_totalprice * 3')} AS payoff_balance, {money('o_totalprice * 0.11')} AS insurance_collected,
       CASE WHEN o_orderpriority = '{P2}' THEN {money('o_totalprice * 0.12')} END AS insurance_due,
       CAST(CAST(o_orderkey AS BIGINT) % 31 AS INT) AS days_in_cycle, {ORDER_DAY} + 3 AS issued_on, {ORDER_DAY} - 1 AS principal_as_of,
       CASE WHEN o_orderstatus = 'O' THEN {ORDER_DAY} + 45 END AS next_auto_debit
FROM {ORDERS}""",
    "account_master": f"""
SELECT CAST(c_custkey AS STRING) AS account_id, CASE WHEN n_regionkey > 0 THEN CAST(n_nationkey AS DECIMAL(14,10)) END AS accrual_factor,
       CAST(n_regionkey AS DECIMAL(14,10)) AS apr, CASE WHEN n_nationkey > 9 THEN CAST(n_nationkey AS DECIMAL(14,10)) END AS military_apr,
       make_date(1998, 1 + n_regionkey, 15) AS next_due_on, CASE WHEN n_regionkey < 3 THEN CAST(5 + n_regionkey AS STRING) || ' days' END AS payment_grace,
       {money('c_acctbal * 4')} AS contract_amount, {money('c_acctbal * 0.13')} AS schedule_amount, {money('c_acctbal')} AS credit_limit,
       CASE WHEN c_acctbal > 0 THEN 'Monthly' END AS rate_frequency, CAST(c_nationkey AS STRING) AS manager
FROM {PARTIES}""",
    "account_day": f"""
SELECT CAST(o_custkey AS STRING) AS account_id, {ORDER_DAY} AS day, {money('o_totalprice - 50000')} AS ledger_balance,
       {money('o_totalprice * 0.01')} AS accrued_interest, {money('o_totalprice * 0.5')} AS interest_paid,
       {money('o_totalprice / 4')} AS past_due, CASE WHEN o_orderstatus = 'F' THEN {money('o_totalprice')} ELSE {money('0')} END AS adjustment,
       {money('o_totalprice * 0.14')} AS misc_fee, {money('o_totalprice * 0.15')} AS fee_collected, {money('o_totalprice * 0.16')} AS past_due_interest,
       CASE WHEN o_orderstatus = 'O' THEN {money('o_totalprice * 0.17')} END AS past_due_principal, {money('o_totalprice * 0.18')} AS disbursed,
       o_orderkey AS row_id
FROM {{orders}}""",
    "account_txn": f"""
SELECT CAST(o_custkey AS STRING) AS account_id,
       CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS txn_id,
       CASE l_linenumber WHEN 1 THEN 'ACHPrincipalPayment' WHEN 2 THEN 'InterestPayment'
            WHEN 3 THEN 'LateChargeFeePayment' WHEN 4 THEN 'MiscellaneousFeePayment' WHEN 5 THEN 'ChargeOff'
            WHEN 6 THEN 'PrincipalPayment' ELSE 'Transfer' END AS posting_code,
       CASE l_returnflag WHEN 'R' THEN 'Debit' ELSE 'Credit' END AS direction,
       {money('l_extendedprice')} AS amount, {SHIP_DAY} AS posted_on
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "relation": f"""
SELECT CAST(o_custkey AS STRING) AS account_id, CASE o_orderstatus WHEN 'P' THEN 'Delete' ELSE 'Keep' END AS action,
       {case('o_orderpriority', {P1: 'Primary', P2: 'Primary'}, "'Secondary'")} AS relation_type,
       {case('o_orderpriority', {P3: 'Borrower', P4: 'Guarantor'}, "'Owner'")} AS relation_code,
       CAST(c_nationkey AS STRING) AS related_id, {ORDER_DAY} AS day
FROM {ORDERS}""",
    "preference": f"""
SELECT CAST(o_custkey AS STRING) AS customer_id, CASE o_orderstatus WHEN 'P' THEN 'Delete' ELSE 'Keep' END AS action,
       {case('o_orderpriority', {P1: 'Privacy Notice', P2: 'ADA Large Print'}, "'Other'")} AS pref_type,
       CASE WHEN o_totalprice > 100000 THEN 'Opt In' ELSE 'Opt Out' END AS pref_status, {ORDER_DAY} AS day, o_orderkey AS row_id
FROM {{orders}}""",
    "address_pref": f"""
SELECT CAST(o_custkey AS STRING) AS customer_id, CAST(o_custkey AS STRING) AS account_id,
       {case('o_orderstatus', {'F': 'statement', 'O': 'account'}, "'customer'")} AS level,
       {case('o_orderpriority', {P1: 'HOME', P2: 'work'}, "'Other'")} AS addr_type, CAST(1 AS INT) AS seq,
       CASE WHEN o_totalprice > 200000 THEN 'Direct Mail' ELSE 'Secure E-Message' END AS method,
       CASE o_orderpriority WHEN '5-LOW' THEN 'Delete' ELSE 'Keep' END AS action, {ORDER_DAY} AS day, o_orderkey AS row_id
FROM {{orders}}""",
    "postal_address": f"""
SELECT CAST(o_custkey AS STRING) AS customer_id, {case('o_orderpriority', {P1: 'Home', P2: 'Work'}, "'Vacation'")} AS addr_type,
       CAST(1 AS INT) AS seq, {case('o_orderstatus', {'F': 'Temporary', 'O': 'Seasonal'})} AS category,
       'Line ' || CAST(o_orderkey AS STRING) AS line1, n_name AS city, c_mktsegment AS state,
       {ORDER_DAY} AS start_on, CASE WHEN o_totalprice > 250000 THEN {ORDER_DAY} + 500 END AS end_on,
       '0501' AS season_start, '0930' AS season_end,
       CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Delete' ELSE 'Keep' END AS action, {ORDER_DAY} AS day, o_orderkey AS row_id
FROM {ORDERS}""",
    "email_address": f"""
SELECT CAST(o_custkey AS STRING) AS customer_id, {case('o_orderstatus', {'F': 'Primary'}, "'Other'")} AS email_type,
       CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 2 END AS INT) AS seq, 'm' || CAST(o_orderkey AS STRING) || '@x.org' AS email,
       {ORDER_DAY} AS start_on, CASE WHEN o_totalprice > 250000 THEN {ORDER_DAY} + 300 END AS end_on,
       CASE o_orderpriority WHEN '5-LOW' THEN 'Delete' ELSE 'Keep' END AS action, {ORDER_DAY} AS day, o_orderkey AS row_id
FROM {{orders}}""",
    "credit_summary": f"""
SELECT CAST(o_custkey AS STRING) AS account_id, {ORDER_DAY} AS day,
       '<<"arStmtCrLineSumm":[<<"apr":"' || CASE WHEN o_orderstatus = 'F' THEN '' ELSE CAST(n_nationkey AS STRING) || '.25' END
         || '","fnceChrg":"1.5","frmDte":"' || CAST(o_orderkey AS STRING) || '","toDte":"b","perdcRte":"0.01","prinOutstdBal":"' || CAST(o_custkey AS STRING)
         || '">>,<<"apr":"7","fnceChrg":"2","frmDte":"c","toDte":"d","perdcRte":"0.02","prinOutstdBal":"10">>]>>' AS summary
FROM {ORDERS}""",
    "account_bill": f"""
SELECT CAST(o_custkey AS STRING) AS account_id, {money('o_totalprice / 10')} AS bill_amount, {ORDER_DAY} + 30 AS next_bill_on,
       {money('o_totalprice * 0.19')} AS interest_owed, {money('o_totalprice * 0.21')} AS principal_owed,
       CASE WHEN o_orderstatus = 'O' THEN {money('o_totalprice * 0.22')} END AS not_yet_due
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS newest FROM {{orders}}) b
WHERE newest = 1""",
    "account_schedule": f"""
SELECT CAST(o_custkey AS STRING) AS account_id, {ORDER_DAY} AS day, o_orderpriority AS term, o_orderkey AS row_id FROM {{orders}}""",
    "statement_detail": f"""
SELECT CAST(c_custkey AS STRING) AS account_id, CAST(c_nationkey AS STRING) AS receiver_id, CAST(n_regionkey AS STRING) AS ledger_id,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'FURNITURE' THEN NULL ELSE 'G' || CAST(CAST(floor(c_custkey / 4) AS BIGINT) AS STRING) END AS group_id,
       CASE WHEN c_acctbal > 8000 THEN 'Primary' ELSE 'member' END AS group_role, DATE '1998-12-31' AS day,
       DATE '1998-01-01' AS period_start, DATE '1998-12-31' AS period_end, {money('c_acctbal')} AS opening_balance,
       CASE WHEN c_acctbal > 0 THEN {money('c_acctbal * 2')} END AS closing_balance, {money('c_acctbal * 0.01')} AS interest_earned
FROM {PARTIES}""",
    "org_unit": """
SELECT CAST(n_regionkey AS STRING) AS ledger_id, CAST(n_nationkey AS STRING) AS unit_id, n_name AS unit_name,
       CASE WHEN n_nationkey < 20 THEN 'Financial Entity' ELSE 'Branch' END AS unit_type,
       'StreetName-' || n_name || ' Road,BuildingId-' || CASE WHEN n_regionkey = 0 THEN '' ELSE CAST(n_nationkey AS STRING) END
         || ',City-' || r_name || CASE WHEN n_regionkey > 2 THEN ',BoxNumber-7' ELSE '' END || ',Postcode-' || CAST(n_nationkey AS STRING) AS address_info,
       '555 - ' || CAST(n_nationkey AS STRING) || ' - 01' AS business_phone
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    # opening hours: suppliers open on the weekday given by the band of their balance
    "open_hours": """
SELECT CAST(s_nationkey AS STRING) AS unit_id,
       CASE WHEN s_acctbal < 2000 THEN 1 WHEN s_acctbal < 4000 THEN 2 WHEN s_acctbal < 6000 THEN 3
            WHEN s_acctbal < 8000 THEN 4 ELSE 5 END AS day_nbr,
       CASE WHEN s_acctbal < 2000 THEN 'Mon' WHEN s_acctbal < 4000 THEN 'Tue' WHEN s_acctbal < 6000 THEN 'Wed'
            WHEN s_acctbal < 8000 THEN 'Thu' ELSE 'Fri' END AS day_name,
       CASE WHEN s_acctbal > 5000 THEN '09:00' ELSE '10:00' END AS starts_at, '17:00' AS ends_at
FROM {supplier}""",
}


def with_roles(*names: str) -> str:
    """``WITH`` clause text that defines the roles for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({duck_dialect(ROLES[n])})" for n in names)
