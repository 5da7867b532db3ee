"""Date encodings and calendar arithmetic.

Four encodings meet in the data: epoch days, ``yyyy-MM-dd`` text, ``yyyyMMdd`` text and
``MM-dd-yyyy`` report text. All helpers return NULL on dirty text unless told otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def from_epoch_day(col: Column | str) -> Column:
    return F.date_from_unix_date(_c(col).cast("int"))


def to_epoch_day(col: Column | str) -> Column:
    return F.unix_date(_c(col).cast("date"))


def parse_date(col: Column | str, pattern: str) -> Column:
    return F.try_to_timestamp(_c(col), F.lit(pattern)).cast("date")


def reformat_date(col: Column | str, src: str, dst: str, on_error: str = "null") -> Column:
    """Re-write date text; ``on_error='blank'`` turns unreadable text into ''."""
    text = F.date_format(parse_date(col, src), dst)
    return F.coalesce(text, F.lit("")) if on_error == "blank" else text


def report_date(col: Column | str, default: str | None = "") -> Column:
    """``MM-dd-yyyy`` text of a date, as printed on reports."""
    text = F.date_format(_c(col).cast("date"), "MM-dd-yyyy")
    return text if default is None else F.coalesce(text, F.lit(default))


def compact_date(col: Column | str) -> Column:
    return F.date_format(_c(col).cast("date"), "yyyyMMdd")


def year_start(col: Column | str) -> Column:
    return F.trunc(_c(col).cast("date"), "year")


def year_bounds(col: Column | str) -> tuple[Column, Column]:
    """First and last day of the year."""
    first = year_start(col)
    return first, F.date_sub(F.add_months(first, 12), 1)


def prior_year_start(col: Column | str) -> Column:
    return F.add_months(year_start(col), -12)


def prior_year_end(col: Column | str) -> Column:
    return F.date_sub(year_start(col), 1)


def age_on(date: Column | str, birth: Column | str) -> Column:
    """Completed years: the difference in years, less one before this year's birthday."""
    day, born = _c(date).cast("date"), _c(birth).cast("date")
    before = F.date_format(day, "MMdd") < F.date_format(born, "MMdd")
    return (F.year(day) - F.year(born) - before.cast("int")).cast("int")


def days_apart(a: Column | str, b: Column | str) -> Column:
    """Unsigned number of days between two dates."""
    return F.abs(F.date_diff(_c(a).cast("date"), _c(b).cast("date")))


def valid_on(date: Column | str, low: Column | str, high: Column | str) -> Column:
    return _c(date).between(_c(low), _c(high))


def address_valid_on(
    date: Column | str,
    category: Column | str,
    start: Column | str,
    end: Column | str,
    season_start: Column | str,
    season_end: Column | str,
) -> Column:
    """Seasonal addresses count by month and day (MMdd text), others by start and open end."""
    day = _c(date).cast("date")
    month_day = F.month(day) * 100 + F.dayofmonth(day)
    seasonal = F.coalesce(_c(category), F.lit("")) == "Seasonal"
    in_season = month_day.between(_c(season_start).try_cast("int"), _c(season_end).try_cast("int"))
    in_force = (_c(start) <= day) & (_c(end).isNull() | (_c(end) >= day))
    return F.coalesce(F.when(seasonal, in_season).otherwise(in_force), F.lit(False))
