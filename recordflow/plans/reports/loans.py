"""Loan reports: early-paid, delinquent, trial balance, forgiven debt."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.functions.dates import days_apart, report_date
from recordflow.functions.jsons import json_rows
from recordflow.functions.text import format_amount, join_nonblank, mask_if
from recordflow.operators.filters import ALL, param_filter
from recordflow.operators.joins import lookup
from recordflow.operators.latest import latest_by_max, latest_day, latest_days, latest_per_key
from recordflow.operators.paging import paginate
from recordflow.operators.pivot import pivot_codes
from recordflow.operators.totals import with_totals_rows
from recordflow.plans.reports.run import Run
from recordflow.sources.tables import stage

# Counter and balance codes, states and marker texts of the loan reports.
EXTENSION_CODES = [
    "NoOfExtsnsForDlqcyPayment",
    "NoOfExtsnsForDelinquency",
    "NoOfExtsnsForPromotional",
    "NoOfExtsnsForPymntDueDateChange",
]
TRIAL_EXTENSION_CODES = ["NoOfExtsnsForPymntDueDateChange", "NoOfExtsnsForDelinquency", "NoOfExtsnsForPromotional"]
PAST_DUE_DAYS = {"TimesPastDue1": 10, "TimesPastDue2": 20, "TimesPastDue3": 30, "TimesPastDue4": 60, "TimesPastDue5": 90}
PAYMENT_COUNTER = "NoOfPaymentsReceived"
LIFE = "LifeToDate"
OPEN_STATES = ["Normal", "PartialChargeOff", "ChargeOff"]
CHARGED_OFF = ["PartialChargeOff", "ChargeOff"]
NO_AMOUNT = "00099999999"
NOT_APPLICABLE = "Not Applicable"
TRIAL_CELLS = {
    ("TotalInterestCollected", "Yearly"): "interest_paid_ytd",
    ("TotalFeeReceivable", "LifeToDate"): "fee",
    ("TotalFeeReceivable", "BillingCycle"): "fee_current",
    ("TotalFeeCollected", "Yearly"): "fee_paid_ytd",
}

_FREQUENCY = T.StructType([T.StructField(n, T.StringType()) for n in ("balTyp", "typ", "val")])


def early_paid(
    bills: DataFrame,
    accounts: DataFrame,
    daily: DataFrame,
    counters: DataFrame,
    customers: DataFrame,
    run: Run,
    ledgers: str = ALL,
    branches: str = ALL,
) -> DataFrame:
    """Bills paid before they were due, with counters, one row per loan and bill."""
    paid = bills.where((F.col("bill_status") == "Paid") & (F.col("due_on") > F.col("paid_on")) & run.holds("paid_on"))
    both = ["account_id", "ledger_id"]
    out = lookup(paid, accounts, both, ["customer_id", "contract_amount", "substate", "branch_id", "product_code", "product_name"])
    out = param_filter(param_filter(out, "ledger_id", ledgers), "branch_id", branches)
    out = lookup(out, latest_day(daily, "day"), both, ["principal", "late_charge", "fee_due", "past_due_since"])
    out = lookup(out, latest_day(counters, "day"), both, {"code": "code", "period": "period", "counter": "counter"})
    address = join_nonblank(["name_line", "line1", "city", "state"])
    people = customers.select("customer_id", "ledger_id", address.alias("name_address"),
                              F.coalesce("home_phone", "mobile_phone").alias("phone"))
    out = lookup(out, people, ["customer_id", "ledger_id"], ["name_address", "phone"])
    life = F.coalesce(F.col("period") == LIFE, F.lit(False))
    history = [
        F.concat(F.lit(f"{days}-"), F.when(life & (F.col("code") == code), F.col("counter")).otherwise(0).cast("string"))
        for code, days in PAST_DUE_DAYS.items()
    ]
    rows = out.select(
        F.col("account_id").alias("loan_number"),
        "ledger_id",
        "customer_id",
        "name_address",
        "phone",
        "branch_id",
        F.col("substate").alias("processing_state"),
        "product_code",
        "product_name",
        "contract_amount",
        "bill_amount",
        "principal",
        "late_charge",
        "fee_due",
        days_apart("due_on", "paid_on").cast("string").alias("days_ahead"),
        report_date("paid_on").alias("paid_date"),
        report_date("past_due_since").alias("old_due_date"),
        F.when(life & F.col("code").isin(EXTENSION_CODES), F.col("counter")).alias("extensions"),
        F.concat_ws(",", *history).alias("credit_history"),
    )
    # All columns of a loan line are the key; keep the key null-safe by grouping on it as it is.
    keys = [c for c in rows.columns if c not in ("extensions", "credit_history")]
    return rows.groupBy(*keys).agg(
        F.sum("extensions").cast("int").alias("extensions"),
        F.array_join(F.array_sort(F.collect_set("credit_history")), ",").alias("credit_history"),
    )


def early_paid_pages(lines: DataFrame, size: int = 10) -> DataFrame:
    """Formatted amounts and page numbers by loan and ledger."""
    money = ["contract_amount", "bill_amount", "principal", "late_charge", "fee_due"]
    order = ["loan_number", "ledger_id", *[c for c in lines.columns if c not in ("loan_number", "ledger_id", *money)], *money]
    return paginate(lines, [F.col(c) for c in order], size).withColumns({m: format_amount(m) for m in money})


def delinquent(
    accounts: DataFrame,
    daily: DataFrame,
    activity: DataFrame,
    counters: DataFrame,
    rates: DataFrame,
    customers: DataFrame,
    dealers: DataFrame,
    run: Run,
    params: Mapping[str, str] | None = None,
) -> DataFrame:
    """Active loans that are late on their newest balance of the run.

    ``params`` maps an output column to its parameter text. Rates are ranked over all charge
    types and shown only when the newest one is debit interest.
    """
    live = accounts.where((F.upper("status") == "ACTIVE") & F.col("substate").isin(OPEN_STATES))
    late = latest_by_max(daily, ["account_id"], "day", where=run.holds("day")).where(F.coalesce("days_late", F.lit(0)) > 0)
    both = ["account_id", "ledger_id"]
    newest = [F.col("day").desc(), F.col("tie").desc()]
    out = lookup(live, late, both, ["principal", "late_charge", "past_due", "interest", "fee_due", "days_late", "past_due_since"], how="inner")
    out = lookup(out, latest_per_key(activity, ["account_id"], newest), ["account_id"], {"day": "last_paid"})
    received = counters.where((F.col("code") == PAYMENT_COUNTER) & (F.col("period") == LIFE))
    top = latest_per_key(received, ["account_id"], [F.col("day").desc(), F.col("counter").desc()])
    out = lookup(out, top, both, {"counter": "payments"})
    rate = latest_per_key(
        rates,
        ["account_id"],
        [F.col("booked_on").desc(), F.col("line_nbr"), F.col("part_id"), F.col("dealer_id")],
    )
    out = lookup(out, rate, both, {"interest_type": "interest_kind"}, F.col("charge_type") == "DebitInterest")
    out = lookup(out, customers, ["customer_id"], {"name_line": "short_name"})
    dealer = latest_per_key(dealers, ["account_id"], [F.col("day").desc(), F.col("dealer_id")])
    out = lookup(out, dealer, ["account_id"], {"dealer_id": "dealer"})
    hidden = F.col("employee_flag") == "Y"
    rows = out.select(
        F.col("account_id").alias("loan_number"),
        F.col("substate").alias("processing_state"),
        "interest_kind",
        "principal",
        "late_charge",
        F.col("past_due").alias("amount_past_due"),
        report_date("last_paid").alias("last_payment_date"),
        report_date("next_due_on").alias("next_due_date"),
        mask_if(hidden, "customer_id").alias("customer_number"),
        mask_if(hidden, "short_name").alias("short_name"),
        "interest",
        "fee_due",
        report_date("past_due_since").alias("old_due_date"),
        F.col("dealer").cast("string").alias("dealer_number"),
        F.coalesce("collateral_code", F.lit("Unsecured Loan")).alias("collateral"),
        "contract_amount",
        "days_late",
        "payments",
        "branch_id",
        "ledger_id",
        "product_name",
        "currency",
    )
    for column, text in (params or {}).items():
        rows = param_filter(rows, column, text, blank_is_all=True)
    return rows


def delinquent_pages(rows: DataFrame, size: int = 10) -> DataFrame:
    return paginate(rows, [F.col("customer_number"), F.col("loan_number"), *[F.col(c) for c in rows.columns]], size)


def trial_detail(
    accounts: DataFrame,
    customers: DataFrame,
    units: DataFrame,
    bills: DataFrame,
    counters: DataFrame,
    daily: DataFrame,
    rates: DataFrame,
    date: str,
) -> DataFrame:
    """One line per open loan (and extension code): balances, newest bill and rate, schedule."""
    day = F.lit(date).cast("date")
    both = ["account_id", "ledger_id"]
    rank = F.when(F.lower("bill_status") == "paid", 2).when(F.lower("bill_status") == "due", 1).otherwise(0)
    bill = latest_per_key(
        bills,
        ["account_id"],
        [F.col("updated_on").desc(), F.col("bill_number").desc(), rank.desc(), F.col("part_id"), F.col("dealer_id")],
    )
    ext = counters.where(F.col("code").isin(TRIAL_EXTENSION_CODES) & (F.col("period") == LIFE))
    ext = _newest_sums(ext, "day", F.sum(F.coalesce("counter", F.lit(0))).cast("bigint").alias("extensions"))
    rate = latest_per_key(
        rates,
        ["account_id"],
        [F.col("booked_on").desc(), F.col("accrual_factor").desc_nulls_last(), F.col("interest_type"), F.col("accrues_from")],
        where=F.col("charge_type") == "DebitInterest",
    )
    freq = json_rows(accounts.select("account_id", "ledger_id", "payment_frequency"), "payment_frequency", "pmtFreq", _FREQUENCY)
    freq = freq.where(F.col("balTyp").like("%Interest%"))
    out = lookup(accounts, customers, ["customer_id"], {"name_line": "customer_name"})
    out = lookup(out, units, {"branch_id": "unit_id"}, {"unit_name": "cost_centre"})
    out = lookup(out, bill, both, {"bill_amount": "bill_amount"})
    out = lookup(out, ext, both, ["extensions"])
    out = lookup(out, latest_day(daily, "day"), both, ["principal", "interest", "days_late", "late_charge"])
    out = lookup(out, freq, both, {"typ": "typ", "val": "val"})
    out = lookup(out, rate, both, ["accrual_factor", "accrues_from", "interest_type"])
    status, substate = F.upper("status"), F.col("substate")
    done = ((status == "ACTIVE") & (substate == "PaidOff")) | ((status == "SETTLED") & (substate == "Closed"))
    closed_before = (status == "SETTLED") & (F.upper(substate) == "CLOSED") & (F.year("closed_on") != F.year(day))
    per_diem = F.abs(F.coalesce("principal", F.lit(0)) * F.coalesce("accrual_factor", F.lit(0))).cast("decimal(38,4)")

    def amount(col: str) -> Column:
        return F.when(done, F.lit(NO_AMOUNT)).otherwise(F.coalesce(F.col(col), F.lit(0)).cast("decimal(26,2)").cast("string"))

    return out.where(~F.coalesce(closed_before, F.lit(False))).select(
        F.col("account_id").alias("loan_number"),
        "customer_id",
        "customer_name",
        "cost_centre",
        "currency",
        "principal",
        "interest",
        F.when(F.col("accrues_from") <= day, per_diem).otherwise(F.lit(0).cast("decimal(38,4)")).alias("per_diem"),
        "branch_id",
        "product_code",
        "interest_type",
        "rate",
        report_date("opened_on").alias("issued"),
        report_date("matures_on").alias("matures"),
        F.when(done, F.lit(NOT_APPLICABLE)).otherwise(report_date("next_due_on")).alias("next_due_date"),
        amount("bill_amount").alias("next_payment"),
        F.concat("status", F.lit("-"), "substate").alias("loan_status"),
        "extensions",
        "days_late",
        F.concat_ws("-", "typ", "val").alias("payment_frequency"),
        amount("scheduled_amount").alias("payment_amount"),
        "late_charge",
        "ledger_id",
    ).distinct()


def _newest_sums(counters: DataFrame, day: str, total: Column) -> DataFrame:
    """(account_id, ledger_id, code, the total of its rows) on each account's newest day; accounts without a day have none.

    Counters are read once. A day's rows of a code are one row before the days are ranked, and the planner keeps
    a task's newest day of an account below the shuffle, so that an account with very many rows does not travel.
    """
    known = counters.where(F.col("account_id").isNotNull() & F.col(day).isNotNull())
    days = known.groupBy("account_id", "ledger_id", "code", day).agg(total)
    rank = F.rank().over(Window.partitionBy("account_id").orderBy(F.col(day).desc()))
    return days.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", day)


def trial_balances(balances: DataFrame, date: str) -> DataFrame:
    """Balances by code and period, valid on the date at their latest batch day, ties kept."""
    wanted = F.lit(False)
    for code, period in TRIAL_CELLS:
        wanted = wanted | ((F.col("code") == code) & (F.col("period") == period))
    top = latest_days(balances.where(wanted), ["account_id", "code", "period"], "batch_date")
    return top.where(F.lit(date).cast("date").between(F.col("valid_from"), F.col("valid_to")))


def trial_balance(detail: DataFrame, balances: DataFrame, date: str, params: Mapping[str, str] | None = None) -> DataFrame:
    """Detail with the four balance columns, one pivot instead of four self joins.

    Equal batch days of one code keep their largest amount; that leaves one row per loan line.
    """
    cell = F.concat_ws("|", "code", "period")
    long = trial_balances(balances, date).withColumn("cell", cell)
    names = {"|".join(k): v for k, v in TRIAL_CELLS.items()}
    wide = pivot_codes(long, ["account_id", "ledger_id"], "cell", "amount", names, agg="max")
    rows = detail
    for column, text in (params or {}).items():
        rows = param_filter(rows, column, text, blank_is_all=True)
    out = lookup(rows, wide, {"loan_number": "account_id", "ledger_id": "ledger_id"}, list(names.values()))
    return out


def trial_pages(rows: DataFrame, size: int = 100) -> DataFrame:
    """The rows are staged first: the range sort reads its input twice, and would run the report's joins twice."""
    rows = stage(rows, "trial")
    return paginate(rows, [F.col("loan_number"), F.col("extensions"), *[F.col(c) for c in rows.columns]], size)


def _newest_of_both(balances: DataFrame, codes: Mapping[str, str], run: Run) -> DataFrame:
    """(account_id, ledger_id, an amount for each code): the rows of each code's newest day in the run.

    Balances are read once. The rows of an account, code and day are a list, the newest list of each code is
    kept, and the lists meet by ledger; rows whose validity does not hold their day drop out first. A list is
    as long as an account has rows of one code on one day.
    """
    of_code = F.col("code").isin(list(codes.values())) & (F.col("period") == "Yearly")
    day = F.col("batch_date")
    valid = day.between(F.col("valid_from"), F.col("valid_to"))
    row = F.when(valid, F.struct("ledger_id", "amount"))
    days = balances.where(of_code & run.holds("batch_date")).groupBy("account_id", "code", "batch_date")
    lists = days.agg(F.collect_list(row).alias("rows"))

    def newest(code: str) -> Column:
        own = F.col("code") == code
        return F.max_by(F.when(own, F.col("rows")), F.when(own, day))

    out = lists.groupBy("account_id").agg(*[newest(code).alias(name) for name, code in codes.items()])
    for name in codes:
        out = out.withColumn(name, F.explode(name))
    first, *others = codes
    for name in others:
        out = out.where(F.col(f"{name}.ledger_id") == F.col(f"{first}.ledger_id"))
    amounts = [F.col(f"{name}.amount").alias(name) for name in codes]
    return out.select("account_id", F.col(f"{first}.ledger_id").alias("ledger_id"), *amounts)


def forgiven_debt(accounts: DataFrame, balances: DataFrame, customers: DataFrame, year: int) -> DataFrame:
    """Charged-off accounts with both forgiven debt and forgiven interest in the year."""
    run = Run(f"{year}-01-01", f"{year}-12-31")

    forgiven = _newest_of_both(balances, {"debt": "ForgivenDebt", "interest": "ForgivenInterest"}, run)
    both = ["account_id", "ledger_id"]
    amounts = {"debt": "forgiven_debt", "interest": "forgiven_interest"}
    out = lookup(accounts.where(F.col("substate").isin(CHARGED_OFF)), forgiven, both, amounts, how="inner")
    out = lookup(out, customers, ["customer_id", "ledger_id"], {"name_line": "customer_name"})
    return out.select(
        F.col("ledger_id").alias("financial_entity"),
        "branch_id",
        "account_id",
        "customer_name",
        "forgiven_debt",
        "forgiven_interest",
        "ledger_id",
    )


def forgiven_debt_pages(rows: DataFrame, ledgers: str = ALL, branches: str = ALL, size: int = 10) -> DataFrame:
    """Details and a total per ledger, then the parameters, then pages in presentation order."""
    rows = stage(rows, "forgiven")  # read for the details and for the totals
    full = with_totals_rows(
        rows, ["forgiven_debt", "forgiven_interest"], "financial_entity", {"Total": None}, keys=["ledger_id"]
    )
    full = param_filter(param_filter(full, "ledger_id", ledgers), "branch_id", branches, blank_is_all=True)
    order = ["financial_entity", "branch_id", "account_id", "ledger_id", "forgiven_debt", "forgiven_interest"]
    return paginate(full, [F.col(c) for c in order], size)

