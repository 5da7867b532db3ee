"""Row filters, including optional report parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the parameter text that stands for "all".
ALL = "99999998"


def param_filter(
    df: DataFrame, col: str, values: str, sentinel: str = ALL, blank_is_all: bool = False
) -> DataFrame:
    """Optional parameter: keep everything for the sentinel, else rows whose value is listed.

    The decision is made while the plan is built, so "all" leaves no trace in the plan. A list of any
    length is one IN predicate on the value's text (a text column's reaches the scan; a long list is a
    hash set). NULL is compared as ''.
    """
    if values == sentinel or (blank_is_all and values == ""):
        return df
    wanted = values.split(",")
    test = F.col(col).cast("string").isin(wanted)
    return df.where(test | F.col(col).isNull() if "" in wanted else test)


def keep_any_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows with at least one amount above zero; NULL is not above zero."""
    test = F.lit(False)
    for name in cols:
        test = test | (F.coalesce(F.col(name), F.lit(0)) > 0)
    return df.where(test)


def valid_as_of(df: DataFrame, date: Column | str, low: str, high: str) -> DataFrame:
    """Rows whose validity range, both ends included, holds the date."""
    day = F.lit(date).cast("date") if isinstance(date, str) else date
    return df.where(day.between(F.col(low), F.col(high)))


def date_range_filter(df: DataFrame, col: str, low: str, high: str) -> DataFrame:
    return df.where(F.col(col).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def prior_dates(df: DataFrame, col: str, before: str) -> DataFrame:
    """Slices strictly before a date; on a partition column this prunes folders."""
    return df.where(F.col(col) < F.lit(before).cast("date"))
