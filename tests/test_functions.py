import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.functions import dates, jsons, text


def one(spark, **cols):
    row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()
    return row.asDict()


def test_implied_decimal_edges(spark):
    got = one(
        spark,
        none=text.implied_decimal(F.lit(None).cast("double")),
        small=text.implied_decimal(F.lit(0.5)),
        minus=text.implied_decimal(F.lit(-12.34567)),
        rate=text.implied_decimal(F.lit(0.05), 14, 10),
        zero=text.implied_decimal(F.lit(0), 14, 10),
        large=text.implied_decimal(F.lit(1e9), 14, 10),
    )
    assert got["none"] == "00000"
    assert got["small"] == "05000"
    assert got["minus"] == "-123457"
    assert got["rate"] == "00500000000"
    assert got["zero"] == "00000000000"
    assert got["large"] is None


def test_blank_and_like(spark):
    got = one(
        spark,
        a=text.is_blank(F.lit("")),
        b=text.is_blank(F.lit(None).cast("string")),
        c=text.is_blank(F.lit("x")),
        d=text.any_like(F.lit(None).cast("string"), ["%a%"]),
        e=text.any_like(F.lit("W8 form"), ["%NRA%", "W8%"]),
    )
    assert got == {"a": True, "b": True, "c": False, "d": False, "e": True}


def test_text_numbers_do_not_fail_on_blanks(spark):
    df = spark.createDataFrame([("1.5",), ("",), (None,), ("junk",), ("2",)], "x string")
    assert str(df.agg(text.sum_text("x").alias("s")).first()["s"]) == "3.5000"


@pytest.mark.parametrize(
    "title,want",
    [
        (None, [None, None]),
        ("", ["", ""]),
        ("x" * 70, ["x" * 60, "x" * 10]),
        ("a\nb", ["a", "b"]),
        ("a\n" + "b" * 80 + "\nc\nd\ne", ["a", "b" * 60]),
        ("only\n", ["only", ""]),
    ],
)
def test_title_lines(spark, title, want):
    df = spark.createDataFrame([(title,)], "t string")
    assert list(df.select(*text.title_lines("t", 2)).first()) == want


def test_tokens(spark):
    df = spark.createDataFrame([("a-b",), ("a",), ("",), ("a-",)], "x string")
    got = [tuple(r) for r in df.select(text.token("x", "-", 0), text.token("x", "-", 1), text.last_token("x", "-")).collect()]
    assert got == [("a", "b", "b"), ("a", None, ""), ("", None, ""), ("a", "", "")]


def test_format_amount(spark):
    got = one(spark, a=text.format_amount(F.lit(1234567.891)), b=text.format_amount(F.lit(None).cast("double")), c=text.format_amount(F.lit(-0.5), 4))
    assert got == {"a": "1,234,567.89", "b": "0.00", "c": "-0.5000"}


def test_day_span_ignores_collect_order(spark):
    kind = T.ArrayType(T.StructType([T.StructField("nbr", T.IntegerType()), T.StructField("name", T.StringType())]))
    schema = T.StructType([T.StructField("d", kind)])
    df = spark.createDataFrame([([(5, "Fri"), (1, "Mon"), (3, "Wed")],), ([(2, "Tue")],)], schema)
    got = [r[0] for r in df.select(text.day_span(F.col("d"), F.lit("9"), F.lit("17"))).collect()]
    assert got == ["Mon to Fri - 9 to 17", "Tue - 9 to 17"]


@pytest.mark.parametrize("birth,age", [("1990-07-27", 35), ("1990-07-28", 35), ("1990-07-29", 34), ("2024-02-29", 1)])
def test_age_around_the_birthday(spark, birth, age):
    assert one(spark, a=dates.age_on(F.lit("2025-07-28"), F.lit(birth)))["a"] == age


def test_date_encodings(spark):
    got = one(
        spark,
        day=dates.from_epoch_day(F.lit(20181)),
        nbr=dates.to_epoch_day(F.lit("2025-04-03")),
        text=dates.reformat_date(F.lit("20250728"), "yyyyMMdd", "yyyy-MM-dd"),
        bad=dates.reformat_date(F.lit("07/28"), "yyyyMMdd", "yyyy-MM-dd"),
        blank=dates.reformat_date(F.lit(""), "yyyyMMdd", "yyyy-MM-dd", on_error="blank"),
        end=dates.prior_year_end(F.lit("2025-07-28")),
        start=dates.prior_year_start(F.lit("2025-07-28")),
        us=dates.report_date(F.lit("2025-07-28")),
        none=dates.report_date(F.lit(None).cast("date"), " "),
    )
    assert got["day"] == datetime.date(2025, 4, 3) and got["nbr"] == 20181
    assert (got["text"], got["bad"], got["blank"]) == ("2025-07-28", None, "")
    assert (str(got["start"]), str(got["end"])) == ("2024-01-01", "2024-12-31")
    assert (got["us"], got["none"]) == ("07-28-2025", " ")


@pytest.mark.parametrize(
    "category,start,end,low,high,valid",
    [
        (None, "2025-01-01", None, None, None, True),
        ("Temporary", "2025-01-01", "2025-07-28", None, None, True),
        ("Temporary", "2025-01-01", "2025-07-27", None, None, False),
        ("Permanent", "2025-07-29", None, None, None, False),
        ("Seasonal", None, None, "0601", "0901", True),
        ("Seasonal", None, None, "601", "728", True),
        ("Seasonal", "2025-01-01", None, "1001", "1201", False),
        ("Seasonal", None, None, None, None, False),
    ],
)
def test_address_validity(spark, category, start, end, low, high, valid):
    df = spark.createDataFrame([(category, start, end, low, high)], "c string, s string, e string, l string, h string")
    df = df.withColumns({"s": F.col("s").cast("date"), "e": F.col("e").cast("date")})
    assert df.select(dates.address_valid_on(F.lit("2025-07-28"), "c", "s", "e", "l", "h")).first()[0] is valid


def test_json_rows_edges(spark):
    item = T.StructType([T.StructField("apr", T.StringType())])
    df = spark.createDataFrame([(1, '{"a":[{"apr":"1"},{"apr":""}]}'), (2, '{"a":[]}'), (3, None), (4, "junk"), (5, "{}")], "k int, j string")
    got = sorted(tuple(r) for r in jsons.json_rows(df, "j", "a", item, pos="p").collect())
    assert got == [(1, 0, "1"), (1, 1, "")]
