"""Plan rules that must hold for every registered query."""

import re
from collections import Counter

import pytest
from conftest import SF_DIR

from recordflow.catalog import all_queries
from recordflow.catalog.registry import Inputs
from recordflow.catalog.statements import RUN
from recordflow.functions.text import implied_decimal
from recordflow.operators.joins import lookup
from recordflow.operators.latest import latest_per_key
from recordflow.plans.reports import loans, statements
from pyspark.sql import functions as F

QUERIES = all_queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_no_python_no_one_task_window(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "PythonUDF"):
        assert bad not in text, bad
    # A window without partitions may only run over one row per task (row numbering).
    for line in text.splitlines():
        if " Window [" in line and "windowspecdefinition(" in line:
            spec = line.split("windowspecdefinition(", 1)[1]
            alone = spec.split(" ASC")[0].split(" DESC")[0]
            assert "," in alone or "_part" in alone, line[:300]


def test_ytd_record_scans_balances_once(spark):
    inputs = Inputs(spark, SF_DIR)
    driver = statements.driving_rows(inputs.account_statement, RUN)
    ours = statements.ytd_record(driver, inputs.period_balance, 1998)
    assert plan(statements.yearly_totals(inputs.period_balance, 1998)).count("orders.parquet") == 1
    # the form with one self join per code and year, on unique rows
    yearly = (F.col("period") == "Yearly") & F.col("code").isin(statements.FEES, statements.INTEREST)
    one = latest_per_key(
        inputs.period_balance.where(yearly).withColumn("y", F.year("valid_to")),
        ["account_id", "code", "y"],
        [F.col("batch_date").desc(), F.col("row_id").desc()],
    )
    out = driver
    for name, code, year in (
        ("fees_ytd", statements.FEES, 1998),
        ("interest_ytd", statements.INTEREST, 1998),
        ("fees_prev_ytd", statements.FEES, 1997),
        ("interest_prev_ytd", statements.INTEREST, 1997),
    ):
        out = lookup(out, one, ["account_id"], {"amount": name}, (F.col("code") == code) & (F.col("y") == year))
    names = ["fees_ytd", "interest_ytd", "fees_prev_ytd", "interest_prev_ytd"]
    joined = out.select("message_id", *[implied_decimal(n).alias(n) for n in names]).distinct()
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, ours.select("uuid", *names).collect()))


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["filter_between"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull" in text and "o_orderpriority" not in text


def scans(df):
    """How often each table is read."""
    return Counter(re.findall(r"/(\w+)\.parquet", plan(df)))


def test_daily_controls_read_each_source_once(spark):
    df = QUERIES["report_daily_controls"](spark, SF_DIR)
    read = scans(df)
    # accounts: customer; balances, postings and entries: orders; postings and entries: lineitem
    assert read["lineitem"] == 2 and read["orders"] == 3 and sum(read.values()) <= 10
    assert plan(df).count("Exchange hashpartitioning") <= 4


def test_forgiven_debt_reads_balances_once(spark):
    inputs = Inputs(spark, SF_DIR)
    df = loans.forgiven_debt(inputs.deposit_account, inputs.period_balance, inputs.customer_master, 1998)
    assert scans(df)["orders"] == 1


def test_trial_detail_reads_counters_once_for_the_newest_extensions(spark):
    """By hand: the newest day's counters of the account, by ledger and code; a null day or account has none."""
    counters = spark.createDataFrame(
        [("a", "1", "x", 5, "2024-01-02"), ("a", "1", "x", None, "2024-01-02"), ("a", "2", "y", 7, "2024-01-02"), ("a", "1", "x", 90, "2024-01-01")]
        + [("a", "1", "y", 80, None), ("b", "1", "x", 3, None), (None, "1", "x", 4, "2024-01-02"), ("c", None, "x", None, "2024-01-05")],
        "account_id string, ledger_id string, code string, counter bigint, day string",
    )
    got = loans._newest_sums(counters, "day", F.sum(F.coalesce("counter", F.lit(0))).alias("n"))
    assert sorted(map(tuple, got.collect()), key=repr) == [("a", "1", "x", 5), ("a", "2", "y", 7), ("c", None, "x", 0)]
    t = Inputs(spark, SF_DIR)
    detail = loans.trial_detail(t.loan_account, t.customer_master, t.org_unit, t.loan_bill, t.loan_counter, t.loan_balance, t.loan_rate, "1999-07-28")
    assert "LeftSemi" not in plan(detail)  # a second read of the counters, for their newest day


def test_trial_pages_run_the_report_once(spark, monkeypatch):
    """The range sort, which reads its input twice, gets rows that were written."""
    seen = []
    monkeypatch.setattr(loans, "paginate", lambda rows, *rest: seen.append(rows) or rows)
    rows = spark.range(3).select(F.col("id").cast("string").alias("loan_number"), F.col("id").alias("extensions")).join(spark.range(3), F.lit(True))
    assert loans.trial_pages(rows).count() == 9
    assert "Join" not in plan(seen[0])
