"""Deposit reports: savings interest, deposit listing, balances by rate, incentives, controls."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.functions.dates import prior_year_end, prior_year_start, report_date, year_start
from recordflow.functions.text import any_like, format_amount, map_codes
from recordflow.operators.filters import ALL, keep_any_positive, param_filter
from recordflow.operators.joins import lookup, scaffold, with_totals
from recordflow.operators.latest import latest_by_max, latest_day, latest_per_key
from recordflow.operators.paging import paginate
from recordflow.operators.pivot import pivot_codes, pivot_latest
from recordflow.operators.sets import active_plus_closed, values_frame
from recordflow.operators.totals import metric_lines, share_of, with_totals_rows
from recordflow.plans.reports.run import Run
from recordflow.sources.tables import stage

# Balance codes, families, tax patterns, transaction codes and report labels.
SAVINGS_FAMILIES = ["Savings", "MMDA"]
SAVINGS_CODES = {
    "InterestPaidBalance": "interest_ytd",
    "EarlyWithdrawalPenaltyCharged": "penalty_ytd",
    "FATCATaxPaid": "fatca_ytd",
    "FederalTaxPaid": "federal_ytd",
}
DEPOSIT_CODES = {**SAVINGS_CODES, "DistributionFederalTax": "distribution_ytd"}
TAX_PATTERNS = ["%W-8%", "W8%", "%NRA%", "%NRE%", "Foreign%"]
INCENTIVE_CODES = {
    "CustIncentiveMiscPaymentBal": "incentive_1",
    "CustGoodwillMiscPaymentBal": "incentive_2",
    "CustIncentiveGiftCashMiscBal": "incentive_3",
    "IncentiveFederaltaxBalance": "federal_tax",
    "IncentiveFATCATaxBalance": "fatca_tax",
}
TRANSACTION_CODES = {
    "clearingcheckwithdrawal": "0127",
    "remotedepositcheckexternal": "0122",
    "creditinterest": "0190",
}
CONTROL_LABELS = {
    "open": "Records counts for the Account master table by STATUS - Open State",
    "closed": "Records counts for the Account master table by STATUS - Closed State",
    "paid": "Total Interest Paid Year to date ",
    "count": "Count of Tran Type - ",
    "value": "$Value by Tran Code - ",
    "daily": "Total Daily Interest Accrued Amount ",
    "month": "Total MTD Interest Accrued Amount ",
    "balance": "Total Current Savings Balance Amount ",
}


def newest_yearly(balances: DataFrame, run: Run, codes: Mapping[str, str], loose: bool = False) -> DataFrame:
    """Yearly balances by code, one row per account.

    Strict: the newest row of each (account, code). Loose: a row of any listed code counts when
    its day is the newest day of *some* listed code of the account, so a code may appear from
    an older day of its own; the newest such row is shown.
    """
    yearly = (F.col("period") == "Yearly") & run.holds("valid_to")
    of_year = balances.where(run.holds("batch_date"))
    listed = of_year.where(yearly & F.col("code").isin(list(codes)))
    if loose:
        tops = listed.groupBy("account_id", "code").agg(F.max("batch_date").alias("batch_date"))
        days = tops.select("account_id", "batch_date").distinct()
        listed = of_year.where((F.col("period") == "Yearly") & F.col("code").isin(list(codes))).join(
            days, ["account_id", "batch_date"], "left_semi"
        )
    return pivot_latest(listed, ["account_id"], "code", "amount", codes, ["batch_date", "row_id"])


def savings_interest(
    accounts: DataFrame,
    daily: DataFrame,
    transactions: DataFrame,
    balances: DataFrame,
    run: Run,
    ledgers: str = ALL,
    products: str = ALL,
    currencies: str = ALL,
) -> DataFrame:
    """Savings accounts: active ones, and those closed in the year with interest or tax."""
    rows = accounts.where(F.col("family").isin(SAVINGS_FAMILIES))
    rows = param_filter(param_filter(rows, "ledger_id", ledgers), "product_code", products)
    rows = param_filter(rows, "currency", currencies)
    last = transactions.groupBy("account_id").agg(F.max("day").alias("last_day"))
    rows = lookup(rows, latest_day(daily, "day"), ["account_id", "ledger_id"], ["ledger_balance", "accrued_interest", "running_balance"])
    rows = lookup(rows, last, ["account_id"], ["last_day"])
    totals = newest_yearly(balances, run, SAVINGS_CODES, loose=True)
    kept = active_plus_closed(
        rows,
        totals,
        "account_id",
        F.upper("status") == "ACTIVE",
        run.holds("closed_on"),
        ["federal_ytd", "fatca_ytd", "interest_ytd"],
    )
    zero = F.lit(0).cast("decimal(26,4)")
    withheld = F.coalesce("fatca_ytd", zero) + F.coalesce("federal_ytd", zero)
    return kept.select(
        "account_id",
        "product_code",
        F.col("title").alias("account_title"),
        format_amount("accrued_interest", 4, 26).alias("accrued_interest"),
        "currency",
        format_amount("ledger_balance", 4, 26).alias("ledger_balance"),
        format_amount("running_balance", 4, 26).alias("running_balance"),
        F.coalesce("rate", F.lit(0).cast("decimal(14,10)")).alias("rate"),
        format_amount("interest_ytd", 4, 26).alias("interest_ytd"),
        report_date("last_day", " ").alias("last_transaction"),
        report_date("opened_on", " ").alias("opened"),
        format_amount(withheld, 4, 26).alias("withheld_ytd"),
        F.col("index_name").alias("interest_index"),
    ).distinct()


def savings_pages(rows: DataFrame, size: int = 10) -> DataFrame:
    order = ["product_code", "account_id", *[c for c in rows.columns if c not in ("product_code", "account_id")]]
    return paginate(rows, [F.col(c) for c in order], size)


def deposit_rows(
    accounts: DataFrame, daily: DataFrame, customers: DataFrame, transactions: DataFrame, balances: DataFrame, run: Run
) -> DataFrame:
    """Deposit accounts with balance, rate and yearly codes; closed ones only with activity."""
    last = transactions.groupBy("account_id").agg(F.max("day").alias("last_day"))
    newest = latest_per_key(daily, ["account_id"], [F.col("day").desc(), F.col("row_id").desc()])
    rows = lookup(accounts, newest, ["account_id", "ledger_id"], ["ledger_balance", "accrued_interest"])
    rows = lookup(rows, customers, ["customer_id"], {"name_line": "customer_name"})
    rows = lookup(rows, last, ["account_id"], ["last_day"])
    idle = (F.col("substate") == "Unredeemed") & (F.col("unredeemed_option") == "NoAccrual")
    zero_rate = F.lit(0).cast("decimal(14,10)")
    rows = rows.select(
        F.lit("Retail Deposits").alias("product_line"),
        "product_code",
        "account_id",
        "customer_name",
        F.coalesce("ledger_balance", F.lit(0)).cast("decimal(26,4)").alias("ledger_balance"),
        "currency",
        F.when(idle, zero_rate).otherwise(F.coalesce("rate", zero_rate)).alias("rate"),
        F.coalesce("accrued_interest", F.lit(0)).cast("decimal(26,4)").alias("accrued_interest"),
        report_date("last_day", " ").alias("last_activity"),
        report_date("opened_on", " ").alias("opened"),
        "closed_on",
        "status",
    )
    totals = newest_yearly(balances, run, DEPOSIT_CODES)
    closed = run.holds("closed_on") | F.col("closed_on").isNull()
    amounts = ["federal_ytd", "fatca_ytd", "distribution_ytd", "interest_ytd"]
    return active_plus_closed(rows, totals, "account_id", F.upper("status") == "ACTIVE", closed, amounts).drop("status")


def deposit_listing(rows: DataFrame) -> DataFrame:
    """Detail lines and one sub-total line per product.

    The logged form of this report is cut off inside its sub-total branch; what is built is the
    detail and plain sub-totals of the amounts.
    """
    lines = rows.select("product_line", "product_code", "account_id", "customer_name", "currency", "ledger_balance", "accrued_interest", "interest_ytd")
    lines = stage(lines.withColumn("group_code", F.col("product_code")), "deposit-lines")  # read for lines and sub-totals
    out = with_totals_rows(
        lines, ["ledger_balance", "accrued_interest", "interest_ytd"], "product_line", {"SubTotal": None}, keys=["group_code"]
    )
    return out


def balances_by_rate(rows: DataFrame) -> DataFrame:
    """Accounts and balances per rate and currency, with their shares of the whole."""
    grouped = rows.groupBy("rate", "currency").agg(
        F.count("account_id").alias("accounts"), F.sum("ledger_balance").alias("balance")
    )
    grouped = stage(grouped, "by-rate")  # read for the rows and for their totals
    whole = with_totals(grouped, {"all_accounts": F.sum("accounts"), "all_balance": F.sum("balance")})
    return whole.select(
        F.col("rate").cast("string").alias("rate"),
        F.col("accounts").cast("string").alias("accounts"),
        F.format_number(share_of(F.col("accounts"), F.col("all_accounts"), 6), 2).alias("account_share"),
        "currency",
        F.format_number(F.col("balance").cast("decimal(26,2)"), 2).alias("balance"),
        F.format_number(share_of(F.col("balance"), F.col("all_balance"), 6), 2).alias("balance_share"),
        F.lit("0").alias("dataordering"),
    )


def incentive_rows(
    accounts: DataFrame, customers: DataFrame, balances: DataFrame, year: int, ledgers: str = ALL, branches: str = ALL
) -> DataFrame:
    """Incentives and their taxes of the year per account; accounts without any are left out.

    Sums per (account, code) at the newest batch of the year, then one column per code.
    """
    of_year = F.year("valid_to") == year
    listed = F.col("code").isin(list(INCENTIVE_CODES)) & (F.col("period") == "Yearly")
    top = latest_by_max(balances, ["account_id", "code", "period"], "batch_date", where=of_year & listed)
    sums = top.groupBy("account_id", "code").agg(
        F.sum(F.coalesce("amount", F.lit(0))).cast("decimal(38,4)").alias("amount")
    )
    wide = pivot_codes(sums, ["account_id"], "code", "amount", INCENTIVE_CODES)
    rows = param_filter(param_filter(accounts, "ledger_id", ledgers), "branch_id", branches)
    rows = lookup(rows, customers, ["customer_id", "ledger_id"], ["name_line", "tax_status"])
    rows = lookup(rows, wide, ["account_id"], list(INCENTIVE_CODES.values()))
    zero = F.lit(0).cast("decimal(38,4)")
    total = sum((F.coalesce(F.col(f"incentive_{i}"), zero) for i in (1, 2, 3)), zero)
    out = rows.select(
        F.col("ledger_id").alias("financial_entity"),
        "branch_id",
        "account_id",
        F.col("name_line").alias("customer_name"),
        total.cast("decimal(38,4)").alias("incentives"),
        "federal_tax",
        "fatca_tax",
        F.when(any_like("tax_status", TAX_PATTERNS), "Yes").otherwise("").alias("nra"),
    )
    return keep_any_positive(out, ["incentives", "federal_tax", "fatca_tax"])


def incentive_report(rows: DataFrame, size: int = 10) -> DataFrame:
    """Details, then totals of all, of non-residents and of the others; numbered by page."""
    rows = stage(rows, "incentives")  # read for the details and for the totals
    foreign = F.col("nra") == "Yes"
    labels = {"Totals": None, "NRA Totals": foreign, "All Others": ~foreign}
    full = with_totals_rows(rows, ["incentives", "federal_tax", "fatca_tax"], "financial_entity", labels)
    order = [F.col("financial_entity"), F.col("branch_id"), F.col("account_id"), F.col("dataordering")]
    return paginate(full.withColumn("pagenbr", F.lit("1")), order, size, col="rowid")


def batch_windows(batches: DataFrame, day: str = "batch_date") -> DataFrame:
    """Per ledger: the batch day, the bounds of the year before and the year's first day."""
    return batches.select(
        "ledger_id",
        F.date_format(day, "yyyyMMdd").alias("batch_day"),
        prior_year_start(day).alias("prior_first"),
        prior_year_end(day).alias("prior_last"),
        year_start(day).alias("year_first"),
    )


def yearly_in_window(balances: DataFrame, windows: DataFrame, code: str) -> DataFrame:
    """Newest yearly balance of a code per account inside its ledger's prior-year window.

    One row per ledger is a small side, but the join says nothing of it: the planner decides.
    """
    of_code = (F.upper("code") == code.upper()) & (F.upper("period") == "YEARLY")
    joined = balances.where(of_code).join(windows, "ledger_id")
    inside = (
        (F.col("full_date") <= F.col("batch_day"))
        & (F.col("valid_from") >= F.col("prior_first"))
        & (F.col("valid_to") <= F.col("prior_last"))
    )
    newest = [F.col("batch_date").desc(), F.col("row_id").desc()]
    return latest_per_key(joined.where(inside), ["account_id"], newest).select(*balances.columns)


def control_totals(
    accounts: DataFrame, daily: DataFrame, postings: DataFrame, ledger: DataFrame, date: str
) -> DataFrame:
    """Daily control totals: labelled metrics in order."""
    day = F.lit(date).cast("date")
    per_account = _account_controls(accounts, daily, ledger, day)
    posted = postings.where(
        (F.col("day") == day)
        & (F.col("arrangement") != "InternalArrangement")
        & F.lower("posting_code").isin(list(TRANSACTION_CODES))
    )
    signed = F.when(F.col("direction") == "Debit", -F.abs("amount")).otherwise(F.abs("amount"))
    per_txn = (
        posted.select("account_id", "txn_id", map_codes(F.lower("posting_code"), TRANSACTION_CODES, "").alias("code"), signed.alias("amount"))
        .groupBy("account_id", "txn_id", "code")
        .agg(F.round(F.sum("amount"), 2).alias("amount"))
        .where(F.col("amount") != 0)
    )
    by_code = per_txn.groupBy("code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(17,2)").alias("value")
    )
    codes = values_frame(accounts.sparkSession, sorted(TRANSACTION_CODES.values()), "code")
    money0 = F.lit(0).cast("decimal(17,2)")
    lines = scaffold(codes, by_code, "code", {"n": F.lit(0).cast("bigint"), "value": money0})

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("decimal(17,2)")

    def count(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    say, rows = CONTROL_LABELS, F.col("rows")
    totals = metric_lines(
        per_account,
        [
            (say["open"], count(rows), 1),
            (say["closed"], count(F.col("closed")), 2),
            (say["paid"], total(F.col("ytd") * (rows + F.col("closed"))), 3),
            (say["daily"], total(F.col("daily") * rows), 6),
            (say["month"], total(F.col("month") * rows), 7),
            (say["balance"], total(F.col("running") * rows), 8),
        ],
    )
    by_line = metric_lines(lines, [(say["count"], F.col("n"), 4), (say["value"], F.col("value"), 5)], suffix=F.col("code"))
    return totals.unionByName(by_line).withColumn("pagenbr", F.lit("1"))


def _account_controls(accounts: DataFrame, daily: DataFrame, ledger: DataFrame, day: Column) -> DataFrame:
    """What the totals need of each account, from one aggregation over the rows of three sources.

    ``rows``: the day's balance rows of open accounts; ``closed``: accounts closed that day; ``daily``,
    ``month``, ``running``, ``ytd``: the values of one row. Each source is read once, and an account's rows are
    aggregated before they are shuffled.
    """
    open_ = (F.lower("status") == "active") | ((F.col("status") == "Settled") & (F.col("closed_on") > day))
    year_end = prior_year_end(day)
    today = F.col("day") == day
    accrual = F.col("operation") == "accrual"
    liability = accrual & (F.col("gl_class") == "Liability")
    balance = F.struct("running_balance", "accrued_interest", "interest_paid")
    tagged = [
        accounts.select("account_id", open_.cast("int").alias("open"), (F.col("closed_on") == day).cast("int").alias("closed")),
        daily.where(today | (F.col("day") == year_end)).select(
            "account_id",
            F.when(today, F.lit(1)).alias("today"),
            F.when(today, F.col("row_id")).alias("new_id"),
            F.when(today, balance).alias("new"),
            F.when(~today, F.col("row_id")).alias("old_id"),
            F.when(~today, F.col("interest_paid")).alias("old_paid"),
        ),
        ledger.where((F.col("booked_on") == day) & (F.col("booked_on") == F.col("effective_on"))).select(
            "account_id",
            F.when(liability, F.col("credit")).alias("credit"),
            F.when(liability, F.col("debit")).alias("debit"),
            accrual.cast("int").alias("accrued"),
            (F.col("operation") == "reversal").cast("int").alias("reversed"),
        ),
    ]
    rows = tagged[0]
    for part in tagged[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    grouped = rows.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        *[F.sum(c).alias(c) for c in ("open", "closed", "today", "credit", "debit")],
        F.max_by("new", "new_id").alias("new"),
        F.max_by("old_paid", "old_id").alias("old_paid"),
        *[F.max(c).alias(c) for c in ("accrued", "reversed")],
    )
    zero = F.lit(0).cast("decimal(26,4)")
    none = F.lit(0).cast("bigint")
    swapped = (F.col("credit") < 0) & (F.col("debit") > 0)
    booked = F.when(swapped, -F.col("debit")).otherwise(F.col("credit") - F.col("debit"))
    reversed_ = F.coalesce((F.col("reversed") == 1) & (F.col("accrued") == 1), F.lit(False))
    paid = F.coalesce("new.interest_paid", zero) - F.coalesce("old_paid", zero)
    return grouped.select(
        (F.coalesce("today", none) * F.coalesce("open", none)).cast("int").alias("rows"),
        F.coalesce("closed", none).cast("int").alias("closed"),
        F.coalesce("new.running_balance", zero).alias("running"),
        F.when(reversed_, zero).otherwise(F.coalesce(booked, zero)).alias("daily"),
        F.when(reversed_, zero).otherwise(F.coalesce("new.accrued_interest", zero)).alias("month"),
        F.when(F.col("today").isNotNull(), paid).otherwise(zero).alias("ytd"),
    )
