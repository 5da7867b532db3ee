"""Statement record set of credit lines: one function per record type.

All records share a driving table (the statements of the run) and a common prefix. Lookups
that the record takes "of the run date" take the newest row inside the run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.functions.dates import address_valid_on, age_on, prior_year_end
from recordflow.functions.jsons import json_rows
from recordflow.functions.text import day_span, implied_decimal, map_codes, title_lines
from recordflow.operators.joins import Lookup, fallback_lookup, join_between, lookup, semi
from recordflow.operators.latest import latest_by_max, latest_per_key, only_sole
from recordflow.operators.pivot import join_strings, pivot_latest, pivot_tags
from recordflow.operators.sets import with_sentinel_row
from recordflow.operators.totals import count_distinct_rows
from recordflow.plans.reports.run import Run

# Record and statement labels, marker row, code lists and translations.
DETAIL_TYPE = "DetailedStatement"
DETAIL_PRODUCT = "%LineOfCredit%"
DETAIL_LABEL = "DetailedLOCStatement"
MARKER = "ZZZZZZ-ZZZZZZZ"
MARKER_KEY = "ZZZZZZZ"
FEES = "TotalFeeCollected"
INTEREST = "TotalInterestCollected"
PRINCIPAL_CODES = ["ACHPrincipalPayment", "CashPrincipalPayment", "CheckPrincipalPayment", "PrincipalPayment"]
INTEREST_CODES = ["ACHInterestPayment", "CashInterestPayment", "CheckInterestPayment", "InterestPayment"]
LATE_CODES = [
    "ACHLateChargePayment",
    "CashLateChargePayment",
    "CheckLateChargePayment",
    "LateChargeFeePayment",
    "LatePaymentPenaltyFeeWaive",
    "ManualLatePaymentFeeWaive",
]
MISC_CODES = [
    "ACHMiscellaneousFeePayment",
    "CashMiscellaneousFeePayment",
    "CheckMiscellaneousFeePayment",
    "ManualMiscFeeWaive",
    "MiscellaneousFeeAssessed",
    "MiscellaneousFeePayment",
    "MiscellaneousFeeWaive",
]
CHARGE_OFF_CODES = ["ChargeOff", "PartialChargeOff"]
DELIVERY = {"Electronic": "00", "Paper and Electronic": "01", "Paper": "02"}
ADDRESS_TAGS = {
    "StreetName": "street",
    "BuildingId": "building",
    "BoxNumber": "address_line_2",
    "Postcode": "postal_code",
    "City": "city",
    "State": "state",
}
CREDIT_LINE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("apr", "fnceChrg", "frmDte", "toDte", "perdcRte", "prinOutstdBal")]
)


def driving_rows(statements: DataFrame, run: Run, post_maturity: bool = False) -> DataFrame:
    """Statements of the run: detailed credit-line ones, or those flagged post-maturity."""
    of_run = statements.where(run.holds("starts_on"))
    if post_maturity:
        return of_run.where(F.col("post_maturity") == "Yes").withColumn("label", F.col("statement_type"))
    detailed = (F.col("statement_type") == DETAIL_TYPE) & F.col("product").like(DETAIL_PRODUCT)
    return of_run.where(detailed).withColumn("label", F.lit(DETAIL_LABEL))


def prefix(record: str, sort: str | None = None) -> list[Column]:
    """The columns every record starts with."""
    return [
        F.lit(record).alias("rec_typ"),
        F.concat("account_id", F.lit("-"), "label").alias("filter_val"),
        F.lit(1).alias("sort_order"),
        F.lit(sort or record).alias("sort_order_1"),
        F.concat("account_id", F.lit("-"), "customer_id").alias("accnt_nmbr"),
        F.col("message_id").alias("uuid"),
    ]


def blanks(*names: str) -> list[Column]:
    """Columns that a record has and never fills."""
    return [F.lit("").alias(n) for n in names]


def filter_list(driver: DataFrame) -> DataFrame:
    """Filter values of the run and a marker row, so that the list is never empty."""
    keys = driver.select(F.concat("account_id", F.lit("-"), "label").alias("filter_val"))
    return with_sentinel_row(keys, "filter_val", MARKER)


def yearly_totals(balances: DataFrame, year: int) -> DataFrame:
    """Fees and interest of the year and the year before, one row per account.

    The newest yearly row per (account, code, year) counts. One scan and one aggregation fill
    the four cells of code and year.
    """
    wanted = F.col("code").isin(FEES, INTEREST) & (F.col("period") == "Yearly")
    yearly = balances.where(wanted & F.year("valid_to").isin(year, year - 1))
    which = F.when(F.year("valid_to") == year, F.lit("")).otherwise(F.lit("_prev"))
    names = {
        FEES: "fees_ytd",
        INTEREST: "interest_ytd",
        FEES + "_prev": "fees_prev_ytd",
        INTEREST + "_prev": "interest_prev_ytd",
    }
    cells = yearly.withColumn("cell", F.concat("code", which))
    return pivot_latest(cells, ["account_id"], "cell", "amount", names, ["batch_date", "row_id"])


def ytd_record(driver: DataFrame, balances: DataFrame, year: int) -> DataFrame:
    """791: fees and interest, year to date and previous year."""
    names = ["fees_ytd", "interest_ytd", "fees_prev_ytd", "interest_prev_ytd"]
    joined = lookup(driver, yearly_totals(balances, year), ["account_id"], names)
    unused = blanks("over_limit_amount", "resolved_amount", "vat_total", "capitalized_interest")
    return joined.select(
        *prefix("791"), *unused, *[implied_decimal(n).alias(n) for n in names]
    ).distinct()


def totals_record(
    driver: DataFrame, statements: DataFrame, daily: DataFrame, accounts: DataFrame, run: Run
) -> DataFrame:
    """790: statement totals with the balance of the day before and the previous statement."""
    detailed = (F.col("statement_type") == DETAIL_TYPE) & F.col("product").like(DETAIL_PRODUCT)
    previous = run.before(statements.where(detailed), "starts_on", ["account_id"], [F.col("message_id").desc()])
    today = run.newest(daily, "day", ["account_id"], [F.col("row_id").desc()])
    # Only the day before each statement counts; those days lie within the run, shifted by one.
    out = driver.withColumn("_yesterday", F.date_sub("starts_on", 1))
    shifted = F.date_add("day", 1).between(run.start, run.end)
    needed = semi(daily.where(shifted), out.distinct(), {"account_id": "account_id", "day": "_yesterday"})
    of_day = latest_per_key(needed, ["account_id", "day"], [F.col("row_id").desc()])
    before = {"ledger_balance": "begin_principal", "past_due_interest": "interest_owed", "past_due_principal": "principal_owed"}
    out = lookup(out, of_day, {"account_id": "account_id", "_yesterday": "day"}, {**before, "disbursed": "disbursed"})
    out = lookup(out, today, ["account_id"], {"accrued_interest": "accrued", "misc_fee": "misc_fee", "fee_collected": "fee_collected"})
    out = lookup(out, previous, ["account_id"], {"closing_balance": "begin_total"})
    out = lookup(out, accounts, ["account_id"], ["accrual_factor", "apr", "military_apr", "next_due_on"])
    return out.select(
        *prefix("790"),
        F.col("account_id").alias("account_number"),
        implied_decimal("begin_principal").alias("beginning_principal_balance"),
        implied_decimal("begin_total").alias("beginning_total_balance"),
        *blanks("principal_credit", "total_credit", "principal_debit", "total_debit", "total_debit_and_accrued"),
        implied_decimal("interest_due").alias("current_payment_interest"),
        implied_decimal("principal_balance").alias("ending_principal_balance"),
        implied_decimal("closing_balance").alias("ending_total_balance"),
        *blanks("average_daily_principal"),
        implied_decimal("accrual_factor", 14, 10).alias("daily_rate_factor"),
        F.col("issued_on").alias("statement_generated_on"),
        implied_decimal("days_in_cycle", 3, 0).alias("days_in_cycle"),
        implied_decimal("past_due").alias("amount_past_due"),
        implied_decimal("apr", 14, 10).alias("annual_rate"),
        F.col("starts_on").alias("billing_period_start"),
        implied_decimal(F.col("past_due") + F.col("current_due")).alias("total_payment_due"),
        implied_decimal("military_apr").alias("military_annual_rate"),
        F.col("next_due_on").alias("payment_due_date"),
        implied_decimal("principal_due").alias("current_payment_principal"),
        *blanks("current_payment_both"),
        implied_decimal("late_charge_due").alias("total_late_charges_due"),
        implied_decimal("misc_fee").alias("total_miscellaneous_due"),
        *blanks("late_charges_assessed_after"),
        implied_decimal("accrued").alias("interest_accrued"),
        implied_decimal("interest_owed").alias("total_interest_due"),
        implied_decimal("principal_owed").alias("total_principal_due"),
        *blanks("average_daily_for_accruals"),
        "statement_type",
        F.col("starts_on").alias("statement_start"),
        F.col("ends_on").alias("statement_end"),
        implied_decimal("disbursed").alias("total_disbursements"),
        implied_decimal("payments_made").alias("total_payments"),
        implied_decimal("payoff_penalty").alias("current_payoff_penalty"),
        implied_decimal("insurance_collected").alias("insurance_collected"),
        implied_decimal("insurance_due").alias("insurance_due"),
        F.when(F.upper("post_maturity") == "YES", "1").otherwise("0").alias("post_maturity_indicator"),
        implied_decimal("fee_collected").alias("fees_collected"),
        implied_decimal("late_charge_collected").alias("late_charge_collected"),
        implied_decimal("principal_balance").alias("new_principal_balance"),
        F.col("principal_as_of").alias("new_principal_balance_date"),
        implied_decimal("current_due").alias("total_current_due"),
    ).distinct()


def transaction_record(driver: DataFrame, transactions: DataFrame) -> DataFrame:
    """711: transactions posted inside the statement period, amounts routed by code."""
    periods = driver.select("account_id", "customer_id", "label", "message_id", "starts_on", "ends_on")
    rows = join_between(transactions, periods, ["account_id"], "posted_on", "starts_on", "ends_on")
    amount = implied_decimal("amount")

    def routed(codes: Sequence[str]) -> Column:
        return F.when(F.col("posting_code").isin(list(codes)), amount)

    return rows.select(
        *prefix("711"),
        F.col("account_id").alias("account_number"),
        F.col("txn_id").alias("transaction_number"),
        amount.alias("transaction_amount"),
        routed(PRINCIPAL_CODES).alias("principal_amount"),
        routed(INTEREST_CODES).alias("interest_amount"),
        routed(LATE_CODES).alias("late_charge_amount"),
        routed(MISC_CODES).alias("miscellaneous_charge"),
        routed(CHARGE_OFF_CODES).alias("charged_off_recovered"),
        F.col("posted_on").alias("effective_date"),
        F.col("direction").alias("debit_credit_indicator"),
    ).distinct()


def balance_record(
    driver: DataFrame,
    accounts: DataFrame,
    daily: DataFrame,
    balances: DataFrame,
    bankruptcies: DataFrame,
    details: DataFrame,
    run: Run,
    codes: dict[str, str],
) -> DataFrame:
    """402: single-code balances, delinquency and limits. ``codes`` maps code to column."""
    of_run = balances.where(run.holds("batch_date"))
    cells = pivot_latest(of_run, ["account_id"], "code", "amount", codes, ["batch_date", "row_id"])
    today = run.newest(daily, "day", ["account_id"], [F.col("row_id").desc()])
    of_day = {"ledger_balance": "principal", "accrued_interest": "accrued", "adjustment": "adjustment", "past_due": "delinquent"}
    out = lookup(driver, today, ["account_id"], of_day)
    out = lookup(out, accounts, ["account_id"], ["accrual_factor", "contract_amount", "credit_limit"])
    out = lookup(out, bankruptcies, ["account_id"], ["bankruptcy_status"])
    out = lookup(out, cells, ["account_id"], list(codes.values()))
    out = lookup(out, details, ["message_id"], ["grace_time"])
    credit = (F.col("principal") < 0) | (F.col("adjustment") > 0)
    return out.select(
        *prefix("402"),
        implied_decimal("accrual_factor", 14, 10).alias("interest_daily_factor"),
        *[implied_decimal(c).alias(c) for c in codes.values()],
        *blanks("minimum_payment_percentage"),
        implied_decimal("contract_amount").alias("total_note"),
        *blanks("fixed_late_charge", "cash_advance_limit", "cash_advance_available", "total_disputed"),
        implied_decimal("delinquent").alias("delinquent_amount"),
        "bankruptcy_status",
        implied_decimal("credit_limit").alias("current_credit_limit"),
        "grace_time",
        implied_decimal("accrued").alias("interest_charged"),
        F.when(F.coalesce(credit, F.lit(False)), "Y").otherwise("N").alias("credit_balance_ind"),
        *blanks("term_out_indicator", "term_out_reason", "interest_charge_paid", "tax_year", "rate_as_of"),
    ).distinct()


def payment_record(
    driver: DataFrame,
    statements: DataFrame,
    accounts: DataFrame,
    daily: DataFrame,
    bills: DataFrame,
    balances: DataFrame,
    rates: DataFrame,
    run: Run,
) -> DataFrame:
    """401: payment detail with interest paid this year and on the last day of the prior year."""
    yearly = balances.where((F.col("code") == INTEREST) & (F.col("period") == "Yearly"))
    this_year = run.newest(yearly, "batch_date", ["account_id"], [F.col("row_id").desc()])
    last_year = latest_by_max(
        yearly, ["account_id"], "row_id", where=F.col("batch_date") == prior_year_end(run.end)
    )
    detailed = (F.col("statement_type") == DETAIL_TYPE) & F.col("product").like(DETAIL_PRODUCT)
    previous = run.before(statements.where(detailed), "starts_on", ["account_id"], [F.col("message_id").desc()])
    today = run.newest(daily, "day", ["account_id"], [F.col("row_id").desc()])
    master = ["payment_grace", "contract_amount", "apr", "schedule_amount", "accrual_factor", "rate_frequency", "manager"]
    of_day = {"ledger_balance": "principal", "accrued_interest": "accrued"}
    out = lookup(driver, accounts, ["account_id"], master)
    out = lookup(out, today, ["account_id"], {**of_day, **{c: c for c in ("past_due_interest", "past_due_principal")}})
    out = lookup(out, bills, ["account_id"], ["bill_amount", "interest_owed", "principal_owed", "not_yet_due"])
    out = lookup(out, this_year, ["account_id"], {"amount": "paid"})
    out = lookup(out, last_year, ["account_id"], {"amount": "paid_before"})
    out = lookup(out, rates, ["account_id"], ["index_code", "spread"])
    out = lookup(out, previous, ["account_id"], {"next_auto_debit": "last_auto_debit"})
    return out.select(
        *prefix("401"),
        implied_decimal("past_due_interest").alias("prior_interest_due"),
        implied_decimal("interest_due").alias("current_interest_due"),
        implied_decimal(F.col("past_due_interest") + F.col("interest_owed")).alias("total_interest_due"),
        implied_decimal("past_due_principal").alias("prior_principal_due"),
        implied_decimal("principal_due").alias("current_principal_due"),
        implied_decimal("principal").alias("total_principal_due"),
        implied_decimal("late_charge_due").alias("late_charges_due"),
        implied_decimal("fee_assessed").alias("miscellaneous_due"),
        implied_decimal("not_yet_due").alias("total_billed_not_due"),
        implied_decimal("accrued").alias("accrued_interest"),
        *blanks("last_scheduled_payment"),
        F.col("next_auto_debit").alias("next_scheduled_payment"),
        "payment_grace",
        implied_decimal("contract_amount").alias("amount_financed"),
        implied_decimal("apr", 14, 10).alias("annual_rate"),
        implied_decimal("fee_assessed").alias("total_finance_charge"),
        *blanks("original_payments"),
        implied_decimal("schedule_amount").alias("principal_and_interest"),
        implied_decimal("principal_owed").alias("fixed_principal"),
        implied_decimal("bill_amount").alias("current_payment_amount"),
        *blanks("estimated_balloon_balance"),
        implied_decimal("accrual_factor").alias("payoff_daily_interest"),
        implied_decimal("payoff_balance").alias("payoff_net_amount"),
        F.col("index_code").alias("interest_index"),
        implied_decimal("spread", 14, 10).alias("interest_spread"),
        F.col("rate_frequency").alias("interest_change_frequency"),
        *blanks("next_interest_change"),
        implied_decimal("paid").alias("interest_paid_ytd"),
        implied_decimal("paid_before").alias("interest_paid_prior_year"),
        *blanks("first_payment"),
        F.col("account_id").alias("account_number"),
        *blanks("signature_card", "online_signature_completed", "paper_signature_returned"),
        "next_auto_debit",
        "last_auto_debit",
        F.col("issued_on").alias("payoff_good_through"),
        *blanks("early_payoff_penalty", "last_payment_date", "last_payment_amount", "balloon_amount"),
        *blanks("next_repayment_change", "repayment_change_reason"),
        F.col("manager").alias("relationship_manager"),
    ).distinct()


def title_record(
    driver: DataFrame,
    accounts: DataFrame,
    bills: DataFrame,
    daily: DataFrame,
    relations: DataFrame,
    customers: DataFrame,
    schedules: DataFrame,
    run: Run,
) -> DataFrame:
    """400: title lines, co-borrower, balances and the newest repayment schedule."""
    schedule = run.up_to(schedules, "day", ["account_id"], [F.col("row_id").desc()])
    today = run.newest(daily, "day", ["account_id"], [F.col("row_id").desc()])
    co = relations.where((F.col("relation_code") == "Borrower") & (F.upper("relation_type") == "SECONDARY"))
    out = lookup(driver, accounts, ["account_id"], ["title", "product_code", "family", "rate", "opened_on", "currency"])
    out = lookup(out, bills, ["account_id"], ["next_bill_on"])
    out = lookup(out, today, ["account_id"], {"ledger_balance": "principal", "past_due": "grand_total"})
    out = lookup(out, co, ["account_id"], {"related_id": "_co"})
    out = lookup(out, customers, {"_co": "customer_id"}, {"name_line": "coborrower_name"})
    out = lookup(out, schedule, ["account_id"], ["term"])
    lines = title_lines("title")
    return out.select(
        *prefix("400"),
        "coborrower_name",
        F.col("account_id").alias("account_number"),
        *[line.alias(f"title_line_{i + 1}") for i, line in enumerate(lines)],
        F.col("family").alias("product_group"),
        "product_code",
        "opened_on",
        implied_decimal("principal").alias("outstanding_principal"),
        implied_decimal("rate", 14, 10).alias("interest_rate"),
        implied_decimal("grand_total").alias("grand_total_due"),
        "next_bill_on",
        F.col("currency").alias("currency_code"),
        F.col("term").alias("previous_term"),
    ).distinct()


def customer_record(
    driver: DataFrame, relations: DataFrame, customers: DataFrame, preferences: DataFrame, run: Run, primary: bool = False
) -> DataFrame:
    """200 (primary) or 201 (secondary) customers of an account, with age and preferences."""
    record, kind = ("200", "Primary") if primary else ("201", "Secondary")
    live = F.col("action") != "Delete"
    related = relations.where(live & (F.col("relation_type") == kind) & (F.col("day") <= run.end))
    pref = run.up_to(preferences.where(live), "day", ["customer_id"], [F.col("row_id").desc()])
    out = lookup(driver, related, ["account_id"], ["related_id", "relation_code"], how="inner")
    wanted = ["name_line", "birth_date", "home_phone", "delivery_pref", "id_type", "id_number", "id_issuer"]
    out = lookup(out, customers, {"related_id": "customer_id"}, {"customer_id": "_cid", **{c: c for c in wanted}})
    out = lookup(out, pref, {"_cid": "customer_id"}, ["pref_type", "pref_status"])
    licence = F.col("id_type") == "Driver's License"

    def opted(kind_name: str) -> Column:
        hit = (F.col("pref_type") == kind_name) & (F.col("pref_status") == "Opt In")
        return F.when(hit, "1").otherwise("0")

    return out.select(
        *prefix(record),
        F.col("_cid").alias("customer_number"),
        F.col("name_line").alias("customer_name"),
        F.date_format("birth_date", "yyyy-MM-dd").alias("date_of_birth"),
        "home_phone",
        F.when(licence, F.col("id_number")).otherwise("").alias("licence_number"),
        F.when(licence, F.col("id_issuer")).otherwise("").alias("licence_state"),
        age_on(run.end, "birth_date").cast("string").alias("age"),
        opted("Privacy Notice").alias("annual_privacy_notice"),
        map_codes("delivery_pref", DELIVERY, "").alias("electronic_indicator"),
        opted("ADA Large Print").alias("ada_indicator"),
        F.col("relation_code").alias("relationship_code"),
    ).distinct()


def opening_hours(hours: DataFrame) -> DataFrame:
    """Opening-hours text per unit: day spans with equal hours, sorted and joined."""
    spans = hours.distinct().groupBy("unit_id", "starts_at", "ends_at").agg(
        F.collect_list(F.struct(F.col("day_nbr").alias("nbr"), F.col("day_name").alias("name"))).alias("days")
    )
    text = spans.select("unit_id", day_span(F.col("days"), "starts_at", "ends_at").alias("hours"))
    return join_strings(text, ["unit_id"], "hours")


def company_record(driver: DataFrame, units: DataFrame, hours: DataFrame, phones: DataFrame) -> DataFrame:
    """100: company address from its tags, newest business phone and opening hours."""
    entities = units.where(F.col("unit_type") == "Financial Entity")
    tags = pivot_tags(entities, ["ledger_id", "unit_id", "unit_name"], "address_info", ADDRESS_TAGS)
    has_either = (F.col("street") != "") | (F.col("building") != "")
    line = F.concat("street", F.when(has_either, ",").otherwise(""), "building")
    phone = latest_per_key(phones, ["unit_id"], [F.col("day").desc(), F.col("phone")])
    out = lookup(driver, tags.withColumn("address_line_1", line), ["ledger_id"],
                 ["unit_id", "unit_name", "address_line_1", "address_line_2", "city", "state", "postal_code"])
    out = lookup(out, opening_hours(hours), ["unit_id"], ["hours"])
    out = lookup(out, phone, ["unit_id"], {"phone": "phone_number_2"})
    return out.select(
        *prefix("100"),
        F.col("account_id").alias("account_number"),
        F.col("unit_id").alias("company_code"),
        F.col("unit_name").alias("company_name"),
        "address_line_1",
        "address_line_2",
        "city",
        "state",
        "postal_code",
        "phone_number_2",
        F.col("hours").alias("hours_of_operation"),
    ).distinct()


def contact_record(
    driver: DataFrame,
    addresses: DataFrame,
    address_prefs: DataFrame,
    emails: DataFrame,
    customers: DataFrame,
    accounts: DataFrame,
    run: Run,
) -> DataFrame:
    """TRN: postal address, e-mail and delivery flags with a chain of fallbacks.

    Addresses count when valid on the run's last day; per (customer, type, sequence) the newest
    one wins and, on a tie, temporary before seasonal before other. The wanted address is named
    by the statement's preference, else the account's, else the customer's; failing all, a sole
    address, then the customer master.
    """
    live = F.col("action") != "Delete"
    people = driver.select("customer_id").distinct()
    rank = F.when(F.col("category") == "Temporary", 1).when(F.col("category") == "Seasonal", 2).otherwise(3)
    valid = address_valid_on(run.end, "category", "start_on", "end_on", "season_start", "season_end")
    postal = latest_per_key(
        addresses.where(live & valid).join(people, "customer_id", "left_semi"),
        ["customer_id", "addr_type", "seq"],
        [F.col("day").desc(), rank, F.col("row_id").desc()],
    )
    sole = only_sole(postal.select("customer_id", "line1", "city", "state"), ["customer_id"])

    prefs = address_prefs.where(live & (F.col("day") <= run.end))

    def pref(level: str, keys: list[str]) -> Lookup:
        rows = latest_per_key(prefs.where(F.col("level") == level), keys, [F.col("day").desc(), F.col("row_id").desc()])
        return Lookup(rows, keys, ["addr_type", "seq"])

    out = fallback_lookup(
        driver,
        [
            pref("statement", ["customer_id", "account_id"]),
            pref("account", ["customer_id", "account_id"]),
            pref("customer", ["customer_id"]),
        ],
        ["addr_type", "seq"],
    )
    direct = latest_per_key(
        prefs.where((F.col("level") == "statement") & (F.col("method") == "Direct Mail")),
        ["customer_id", "account_id"],
        [F.col("day").desc(), F.col("row_id").desc()],
    )
    out = lookup(out, direct, ["customer_id", "account_id"], {"method": "_direct"})
    postal = postal.withColumn("addr_key", F.lower("addr_type"))
    out = out.withColumn("addr_key", F.lower("addr_type"))
    out = fallback_lookup(
        out,
        [
            Lookup(postal, ["customer_id", "addr_key", "seq"], ["line1", "city", "state"]),
            Lookup(sole, ["customer_id"], ["line1", "city", "state"]),
            Lookup(customers, ["customer_id"], ["line1", "city", "state"]),
        ],
        ["line1", "city", "state"],
        default="",
    )
    mail = latest_per_key(
        emails.where(live & (F.col("start_on") <= run.end) & (F.col("end_on").isNull() | (F.col("end_on") >= run.end))),
        ["customer_id", "email_type", "seq"],
        [F.col("day").desc(), F.col("start_on").desc(), F.col("row_id").desc()],
    )
    primary = mail.where((F.col("email_type") == "Primary") & (F.col("seq") == 1))
    sole_mail = only_sole(mail.select("customer_id", "email"), ["customer_id"])
    out = fallback_lookup(
        out,
        [
            Lookup(primary, ["customer_id"], ["email"]),
            Lookup(sole_mail, ["customer_id"], ["email"]),
            Lookup(customers, ["customer_id"], ["email_domain"]),
        ],
        ["email"],
        default="",
    )
    out = lookup(out, customers, ["customer_id"], {"customer_id": "_cid", "name_line": "name_line", "delivery_pref": "delivery_pref"})
    out = lookup(out, accounts, ["account_id"], ["title", "branch_id"])
    by_master = F.col("_cid").isNotNull()
    paper = F.when(F.col("_direct").isNotNull(), F.lit(True)).when(
        by_master, F.col("delivery_pref").isin("Paper and Electronic", "Paper")
    ).otherwise(F.col("comm_mode") == "Mail")
    secure = F.when(by_master, F.col("delivery_pref").isin("Paper and Electronic", "Electronic")).otherwise(
        F.col("comm_mode") == "Email"
    )
    lines = title_lines("title", 2)
    notify = {"SMS": "Text", "Email": "Email", "Email, SMS": "Email, Text"}
    return out.select(
        *prefix("TRN", "0"),
        F.col("statement_type").alias("form_type"),
        F.col("_cid").alias("customer_number"),
        F.col("name_line").alias("full_legal_name"),
        lines[0].alias("primary_title"),
        lines[1].alias("secondary_title"),
        F.col("line1").alias("address_line_1"),
        "city",
        F.substring("state", 1, 2).alias("state"),
        F.col("branch_id").alias("branch_of_ownership"),
        F.col("email").alias("electronic_mail"),
        F.when(F.coalesce(paper, F.lit(False)), "1").otherwise("0").alias("paper_indicator"),
        F.when(F.coalesce(secure, F.lit(False)), "1").otherwise("0").alias("secure_indicator"),
        map_codes("notify_mode", notify).alias("notification_method"),
    ).distinct()


def credit_line_record(driver: DataFrame, summaries: DataFrame, run: Run) -> DataFrame:
    """792: one row per element of the JSON array of credit-line summaries; blank APR dropped."""
    of_run = summaries.where(run.holds("day")).select("account_id", "summary")
    rows = json_rows(of_run, "summary", "arStmtCrLineSumm", CREDIT_LINE).where(F.col("apr") != "")
    out = driver.join(rows, "account_id", "inner")
    number = {c: F.col(c).try_cast("decimal(26,10)") for c in ("apr", "fnceChrg", "perdcRte", "prinOutstdBal")}
    return out.select(
        *prefix("792"),
        F.col("account_id").alias("account_number"),
        implied_decimal(number["apr"], 14, 10).alias("apr"),
        implied_decimal(number["fnceChrg"]).alias("finance_charge"),
        F.col("frmDte").alias("from_date"),
        F.col("toDte").alias("to_date"),
        implied_decimal(number["perdcRte"], 14, 10).alias("periodic_rate"),
        implied_decimal(number["prinOutstdBal"]).alias("principal_outstanding"),
    ).distinct()


def control_record(statements: DataFrame, units: DataFrame, run: Run) -> DataFrame:
    """995: number of distinct records per form, for every financial entity of the ledger."""
    forms = statements.where(run.holds("starts_on") & F.col("statement_type").isNotNull()).select(
        F.col("statement_type").alias("form_id"), "ledger_id", "customer_id", "account_id"
    )
    counts = count_distinct_rows(forms, forms.columns, ["form_id", "ledger_id"])
    entities = units.where(F.col("unit_type") == "Financial Entity").select("unit_id", "ledger_id")
    return entities.join(counts, "ledger_id").select(
        F.lit("995").alias("rec_typ"),
        F.lit(MARKER_KEY).alias("accnt_nmbr"),
        F.lit(MARKER_KEY).alias("uuid"),
        F.concat("form_id", F.lit("100")).alias("sort_order"),
        F.lit("995").alias("sort_order_1"),
        F.lit(MARKER).alias("filter_val"),
        F.col("unit_id").alias("company_code"),
        F.col("form_id").alias("form_type"),
        F.lit("100").alias("form_variation"),
        F.col("cnt").alias("total_records"),
    ).distinct()

