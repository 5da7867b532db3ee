"""Statement masters of deposits: back-fill, orphan groups, master record, preferences, units."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.functions.text import is_blank, strip_chars, title_lines, token
from recordflow.operators.joins import Lookup, anti, fallback_lookup, lookup, self_related, semi
from recordflow.operators.latest import latest_per_key
from recordflow.operators.pivot import explode_list, pivot_codes, pivot_latest, pivot_tags

# Balance codes per window and the columns they fill, attribute types.
STATEMENT_CELLS: dict[tuple[str, str], str] = {
    ("ytd", "InterestPaidBalance"): "interest_paid_ytd",
    ("prior_year", "InterestPaidBalance"): "interest_paid_prior_year",
    ("ytd", "FederalTaxPaid"): "withheld_ytd",
    ("prior_year", "FederalTaxPaid"): "withheld_prior_year",
    ("ytd", "EarlyWithdrawalPenaltyCharged"): "penalty_ytd",
    ("prior_year", "EarlyWithdrawalPenaltyCharged"): "penalty_prior_year",
    ("period", "OverdraftFeeCharged"): "overdraft_fees_period",
    ("prior_period", "OverdraftFeeCharged"): "overdraft_fees_prior_period",
    ("ytd", "OverdraftFeeCharged"): "overdraft_fees_ytd",
    ("prior_year", "OverdraftFeeCharged"): "overdraft_fees_prior_year",
    ("period", "ReturnItemFeeBalance"): "returned_item_fees_period",
    ("prior_period", "ReturnItemFeeBalance"): "returned_item_fees_prior_period",
    ("ytd", "ReturnItemFeeBalance"): "returned_item_fees_ytd",
    ("prior_year", "ReturnItemFeeBalance"): "returned_item_fees_prior_year",
    ("period", "ACHOrgntdReturnFeeRefundBalance"): "ach_return_refunds_period",
    ("ytd", "ACHOrgntdReturnFeeRefundBalance"): "ach_return_refunds_ytd",
    ("period", "ACHDeclineFeeBalance"): "ach_decline_fees_period",
    ("period", "ACHReturnFeeBalance"): "ach_return_fees_period",
    ("ytd", "ACHReturnFeeBalance"): "ach_return_fees_ytd",
    ("ytd", "ACHReturnFeeRefundBalance"): "ach_decline_refunds_ytd",
    ("period", "BillPaymentFeeBalance"): "bill_payment_fees_period",
    ("ytd", "BillPaymentFeeBalance"): "bill_payment_fees_ytd",
    ("period", "BillPaymentFeeRefundBalance"): "bill_payment_refunds_period",
    ("ytd", "BillPaymentFeeRefundBalance"): "bill_payment_refunds_ytd",
    ("period", "RemoteDepositFeeBalance"): "remote_deposit_fees_period",
    ("ytd", "RemoteDepositFeeBalance"): "remote_deposit_fees_ytd",
    ("period", "RemoteDepositCheckFeeRefundBal"): "remote_deposit_refunds_period",
    ("ytd", "RemoteDepositCheckFeeRefundBal"): "remote_deposit_refunds_ytd",
    ("period", "FeeWaived"): "fees_waived_period",
    ("prior_period", "FeeWaived"): "fees_waived_prior_period",
    ("ytd", "FeeWaived"): "fees_waived_ytd",
    ("prior_year", "FeeWaived"): "fees_waived_prior_year",
    ("period", "FeeDiscounted"): "fees_discounted_period",
    ("prior_period", "FeeDiscounted"): "fees_discounted_prior_period",
    ("ytd", "FeeDiscounted"): "fees_discounted_ytd",
    ("prior_year", "FeeDiscounted"): "fees_discounted_prior_year",
    ("period", "FeeReversed"): "fees_reversed_period",
    ("prior_period", "FeeReversed"): "fees_reversed_prior_period",
    ("ytd", "FeeReversed"): "fees_reversed_ytd",
    ("prior_year", "FeeReversed"): "fees_reversed_prior_year",
    ("period", "InterestPaidBalance"): "interest_paid_period",
    ("period", "InterestAccruedBalance"): "interest_accrued_period",
    ("period", "LedgerBalance"): "average_ledger_balance",
    ("prior_period", "CustGoodwillIntPaymentBal"): "goodwill_period",
    ("prior_period", "CustIncentiveIntPaymentBal"): "incentive_period",
    ("ytd", "CustGoodwillIntPaymentBal"): "goodwill_ytd",
    ("ytd", "CustIncentiveIntPaymentBal"): "incentive_ytd",
    ("period", "InterestAndIncentivePaidBalance"): "interest_and_incentive_period",
    ("ytd", "InterestAndIncentivePaidBalance"): "interest_and_incentive_ytd",
    ("period", "PositiveCollectedBalance"): "average_positive_collected",
    ("period", "IntBasisPositiveCollectedBal"): "average_interest_basis_collected",
    ("period", "InterestEarnedBalance"): "interest_earned_period",
}
AVERAGE_CODES = ["LedgerBalance", "PositiveCollectedBalance", "IntBasisPositiveCollectedBal"]
ATTRIBUTES = {"CalType": "cal_type", "BlendedAPY": "blended_apy", "Curr": "curr", "APY": "apy", "CheckImageDisposition": "check_images"}
CAL_TYPES = ["Flat", "Tier"]
PRIVACY, LARGE_PRINT = "Privacy Notice", "ADA Large Print"


def backfill(master: DataFrame, staged: DataFrame, dates: Mapping[str, Column], key: str = "account_id") -> DataFrame:
    """Master rows of accounts that are not staged, with the date columns replaced."""
    return anti(master, staged, [key]).withColumns(dict(dates))


def orphan_groups(details: DataFrame, run_date: str) -> DataFrame:
    """Rows of the run date whose (non-blank) group has no primary member."""
    of_day = details.where((F.col("day") == F.lit(run_date).cast("date")) & ~is_blank("group_id"))
    led = of_day.where(F.lower("group_role") == "primary").select("group_id").distinct()
    return anti(of_day, led, ["group_id"]).select("group_id", "group_role", "day", "account_id", "ledger_id")


def classify(details: DataFrame, orphans: DataFrame) -> DataFrame:
    """``stmnt`` 1: no group, or an orphan group; 2: a group with a primary member."""
    groups = orphans.where(~is_blank("group_id")).select("group_id").distinct().withColumn("_orphan", F.lit(True))
    out = lookup(details, groups, ["group_id"], ["_orphan"])
    kind = F.when(is_blank("group_id") | F.col("_orphan").isNotNull(), 1).otherwise(2)
    return out.withColumn("stmnt", kind).drop("_orphan")


def statement_periods(rows: DataFrame) -> DataFrame:
    """Days derived from the statement period."""
    year = F.year("period_end")
    return rows.withColumns(
        {
            "before_start": F.date_sub("period_start", 1),
            "before_end": F.date_sub("period_end", 1),
            "year_end": F.make_date(year, F.lit(12), F.lit(31)),
            "prior_year_end": F.make_date(year - 1, F.lit(12), F.lit(31)),
        }
    )


def balances_by_window(
    driver: DataFrame,
    balances: DataFrame,
    cells: Mapping[tuple[str, str], str] = STATEMENT_CELLS,
    average_codes: Sequence[str] = tuple(AVERAGE_CODES),
) -> DataFrame:
    """Balances by code for the period, the period before, the year and the year before.

    The four windows of a statement are rows with a kind and an end day, so balances meet them by
    a hash on (account, kind, end day) and are pivoted once per related account and set of days; the
    accounts that share those get the finished row. The newest row per code and window counts. Codes in
    ``average_codes`` show their average amount.
    """
    batch, period = F.col("batch_date"), F.col("period")
    days = ["period_start", "period_end", "before_start", "year_end", "prior_year_end"]
    windows = driver.select("related_id", *days).distinct()
    codes = sorted({code for _, code in cells})
    long = balances.where(F.col("code").isin(codes) & period.isin("Statement", "Yearly")).withColumnRenamed("account_id", "_owner")

    def window(name: str, kind: str, end: str, latest: str) -> Column:
        return F.struct(
            F.lit(name).alias("label"), F.lit(kind).alias("kind"), F.col(end).alias("end"), F.col(latest).alias("latest")
        )

    listed = windows.withColumn(
        "_w",
        F.explode(
            F.array(
                window("period", "Statement", "period_end", "period_end"),
                window("prior_period", "Statement", "before_start", "period_start"),
                window("ytd", "Yearly", "year_end", "period_end"),
                window("prior_year", "Yearly", "prior_year_end", "period_end"),
            )
        ),
    )
    w = F.col("_w")
    same = (F.col("_owner") == F.col("related_id")) & (period == w["kind"]) & (F.col("valid_to") == w["end"])
    # A row of this period is not one of the period before, even where both end on one day.
    current = (F.col("valid_to") == F.col("period_end")) & batch.between(F.col("period_start"), F.col("period_end"))
    holds = F.when(w["label"] == "period", batch.between(F.col("period_start"), F.col("period_end"))).otherwise(
        (batch <= w["latest"]) & ~((w["label"] == "prior_period") & F.coalesce(current, F.lit(False)))
    )
    value = F.when(F.col("code").isin(list(average_codes)), F.col("average_amount")).otherwise(F.col("amount"))
    labelled = long.join(listed, same).where(holds).withColumns({"cell": F.concat_ws("|", w["label"], "code"), "value": value})
    keys = ["related_id", *days]
    newest = latest_per_key(labelled, [*keys, "cell"], [batch.desc(), F.col("row_id").desc()])
    amounts = pivot_codes(newest, keys, "cell", "value", {"|".join(k): v for k, v in cells.items()})
    ours = driver.select("account_id", "receiver_id", *keys).distinct()
    named = amounts.select(*[F.col(k).alias(f"_{k}") for k in keys], *cells.values())
    out = ours.join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return out.select("account_id", "receiver_id", "related_id", *cells.values())


def related_customers(driver: DataFrame, relations: DataFrame, preferences: DataFrame, customers: DataFrame, run_date: str) -> DataFrame:
    """Customers related to the statement accounts, with their two preference flags."""
    day = F.lit(run_date).cast("date")
    accounts = driver.select("account_id").distinct()
    newest = latest_per_key(
        relations.where(F.col("day") <= day).join(accounts, "account_id", "left_semi"),
        ["account_id", "relation_code", "relation_type", "related_id"],
        [F.col("day").desc(), F.col("action")],
    ).where(F.col("action") != "Delete")
    opted = preferences.where((F.col("action") != "Delete") & (F.col("pref_status") == "Opt In"))
    first = opted.groupBy("customer_id").agg(
        F.min(F.when(F.col("pref_type") == PRIVACY, F.col("day"))).alias("_privacy_day"),
        F.min(F.when(F.col("pref_type") == LARGE_PRINT, F.col("day"))).alias("_print_day"),
    )
    out = lookup(newest, first, {"related_id": "customer_id"}, ["_privacy_day", "_print_day"])
    flags = out.groupBy("account_id", "related_id", "relation_type", "relation_code").agg(
        F.max((F.col("_privacy_day") <= F.col("day")).cast("int")).alias("privacy"),
        F.max((F.col("_print_day") <= F.col("day")).cast("int")).alias("large_print"),
    )
    flags = flags.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("privacy", "large_print")})
    return lookup(flags, customers, {"related_id": "customer_id"}, ["name_line", "birth_date", "delivery_pref"])


def attributes(driver: DataFrame, extra: DataFrame) -> DataFrame:
    """Additional attributes of the accounts, one column per type; the newest value counts."""
    kind = F.col("attr_type")
    valid = (
        ((kind == "CalType") & F.col("attr_value").isin(CAL_TYPES))
        | ((kind == "BlendedAPY") & (F.col("attr_value") == "True"))
        | kind.isin("Curr", "APY", "CheckImageDisposition")
    )
    keys = driver.select(F.col("related_id").alias("account_id")).distinct()
    known = extra.where(valid).join(keys, "account_id", "left_semi")
    return pivot_latest(known, ["account_id"], "attr_type", "attr_value", ATTRIBUTES, ["day", "row_id"])


def statement_driver(details: DataFrame, orphans: DataFrame, accounts: DataFrame, run_date: str) -> DataFrame:
    """Classified statements of the run date with period days and retirement relation.

    An account with a retirement plan is related through that plan; amounts and period of the
    related statement then take precedence.
    """
    of_day = details.where(F.col("day") == F.lit(run_date).cast("date")).distinct()
    out = statement_periods(classify(of_day, orphans))
    out = lookup(out, accounts, ["account_id"], ["plan_id", "family", "title", "branch_id", "status", "closed_on"])
    plan = F.when((F.col("stmnt") == 1) & ~is_blank("plan_id"), F.col("plan_id"))
    main = accounts.where(~is_blank("plan_id")).groupBy("plan_id").agg(F.min("account_id").alias("main_id"))
    out = lookup(out.withColumn("_plan", plan), main, {"_plan": "plan_id"}, ["main_id"])
    out = out.withColumn("related_id", F.coalesce("main_id", "account_id")).drop("_plan", "main_id")
    taken = ["opening_balance", "closing_balance", "interest_earned", "period_start", "period_end", "before_start", "before_end"]
    return self_related(out, "account_id", "related_id", taken, extra=["receiver_id"])


def statement_master(
    driver: DataFrame,
    customers_of: DataFrame,
    attrs: DataFrame,
    daily: DataFrame,
    balances: DataFrame,
    cells: Mapping[tuple[str, str], str] = STATEMENT_CELLS,
    average_codes: Sequence[str] = tuple(AVERAGE_CODES),
) -> DataFrame:
    """Master record: statement, customers, attributes, balances at both ends and by code.

    The last column is the class, which is also the partition to write to.
    """
    by_code = balances_by_window(driver, balances, cells, average_codes)
    wanted_days = driver.select("related_id", F.explode(F.array("before_end", "period_end")).alias("_day")).distinct()
    needed = semi(daily, wanted_days, {"account_id": "related_id", "day": "_day"})
    of_day = latest_per_key(needed, ["account_id", "day"], [F.col("row_id").desc()])
    keys = ["account_id", "receiver_id", "related_id"]
    names = ["related_id", "relation_type", "relation_code", "privacy", "large_print", "name_line", "birth_date", "delivery_pref"]
    out = lookup(driver, customers_of, ["account_id"], {n: f"customer_{n}" for n in names})
    out = lookup(out, attrs, {"related_id": "account_id"}, list(ATTRIBUTES.values()))
    out = lookup(out, by_code, keys, list(cells.values()))
    for name, day in (("prev", "before_end"), ("curr", "period_end")):
        wanted = {"ledger_balance": f"{name}_ledger_balance", "running_balance": f"{name}_running_balance"}
        out = lookup(out, of_day, {"related_id": "account_id", day: "day"}, wanted)
    last = [c for c in out.columns if c != "stmnt"] + ["stmnt"]
    return out.select(*last).distinct()


def address_preferences(master: DataFrame, contacts: DataFrame) -> DataFrame:
    """One row per account, receiver and notification mode, with where to send it.

    Paper is a mode of its own when paper copies are asked for. A paper row takes its address;
    every row falls back to the first address of the receiver. The logged form of this report
    is cut off in its last join; the columns up to there are built.
    """
    modes = F.replace(F.coalesce("notify_mode", F.lit("")), F.lit(" "), F.lit(""))
    paper = F.col("paper_count") > 0
    listed = F.when(paper & (modes != ""), F.concat(modes, F.lit(",Paper"))).when(paper, F.lit("Paper")).otherwise(modes)
    rows = explode_list(master.withColumn("_modes", listed), "_modes", ",", "mode").drop("_modes").distinct()
    keys = ["account_id", "receiver_id"]
    address = ["line1", "city", "state", "addr_type", "seq"]
    first = latest_per_key(contacts, keys, [F.col("seq"), F.col("addr_type"), F.col("line1")])
    own = contacts.select(*keys, *address).distinct().withColumn("_mode", F.lit("Paper"))
    sources = [
        Lookup(own, {"account_id": "account_id", "receiver_id": "receiver_id", "mode": "_mode"}, address),
        Lookup(first, keys, address),
    ]
    out = fallback_lookup(rows, sources, address)
    secure = F.col("secure_count") > 0
    lines = title_lines("title", 2)
    return out.select(
        *keys,
        "mode",
        F.when(paper, "1").otherwise("0").alias("paper_indicator"),
        F.when(secure, "1").otherwise("0").alias("secure_indicator"),
        F.col("line1").alias("address_line_1"),
        "city",
        "state",
        F.when(secure & (F.col("mode") == "SMS"), "Text").when(secure & (F.col("mode") == "Email"), "Email").otherwise("").alias("secure_message"),
        lines[0].alias("primary_title"),
        lines[1].alias("secondary_title"),
    ).distinct()


def organisation_record(units: DataFrame, websites: DataFrame) -> DataFrame:
    """Financial entities with address parts from their tags and the newest website.

    An item without a value is shown by its tag, and a unit without address text by its name.
    """
    entities = units.where(F.col("unit_type") == "Financial Entity").withColumn(
        "address_info", F.coalesce("address_info", "unit_name")
    )
    keys = ["ledger_id", "unit_id", "unit_name", "business_phone", "address_info"]
    tags = {"StreetName": "street", "BuildingId": "building", "BoxNumber": "address_line_2", "Postcode": "postal_code"}
    parts = pivot_tags(entities.withColumn("_text", F.col("address_info")), keys, "_text", tags)
    bare = F.filter(F.split("address_info", ",", -1), lambda x: is_blank(token(x, "-", 1)))
    bare_tag = F.coalesce(F.array_max(F.transform(bare, lambda x: token(x, "-", 0))), F.lit(""))
    line = F.concat(
        "street",
        F.when(F.size(bare) > 0, ",").otherwise(""),
        bare_tag,
        F.when((F.col("street") != "") | (F.col("building") != ""), ",").otherwise(""),
        "building",
    )
    site = latest_per_key(websites, ["unit_id"], [F.col("day").desc(), F.col("site")])
    out = lookup(parts, site, ["unit_id"], {"site": "website"})
    return out.select(
        "unit_id",
        "unit_name",
        "ledger_id",
        line.alias("address_line"),
        "address_line_2",
        "postal_code",
        "website",
        strip_chars("business_phone", "- ").alias("business_phone"),
        "address_info",
    ).distinct()
