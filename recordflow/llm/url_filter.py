"""URL verdicts: domain and path rules, then a character language-model ratio.

URLs that a rule decides are the labelled ones. Two character models, of accepted and of rejected
URLs, interpolate contexts of zero to four characters (Witten-Bell: a context passes on as much as
it has seen different characters). A URL's score is the difference of the two log-likelihoods over
its length; the threshold is the one that separates held-out labelled URLs best. Everything is
grouping and joins on short strings, and the model is a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordflow.llm.common import staged

ORDER = 5  # characters of a gram: a context of four and the next one
START = "^"
FLOOR = 1 / 128  # probability of a character that no context knows
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Scores are whole millionths, thresholds whole hundredths.
MICRO, STEP = 1_000_000, 10_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z), and path; both empty for null or a URL without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits: its host or a subdomain, and the beginning of the path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def _tail(c: str, k: int) -> Column:
    return F.substring(c, ORDER - k + 1, k) if k < ORDER else F.col(c)


def gram_scores(grams: DataFrame) -> DataFrame:
    """``grams`` (gram, accepted, rejected: counts) to (gram, score in millionths)."""
    lower = None
    for k in range(1, ORDER + 1):
        counts = grams.groupBy(_tail("gram", k).alias("s")).agg(
            F.sum("accepted").alias("na"), F.sum("rejected").alias("nr")
        )
        counts = counts.withColumn("ctx", F.substring("s", 1, k - 1) if k > 1 else F.lit(""))
        context = counts.groupBy("ctx").agg(
            F.sum("na").alias("ca"),
            F.sum("nr").alias("cr"),
            F.sum(F.when(F.col("na") > 0, 1).otherwise(0)).alias("ta"),
            F.sum(F.when(F.col("nr") > 0, 1).otherwise(0)).alias("tr"),
        )
        both = counts.join(context, "ctx")
        if lower is None:
            both = both.withColumns({"la": F.lit(FLOOR), "lr": F.lit(FLOOR)})
        else:
            both = both.withColumn("up", F.substring("s", 2, k - 1)).join(lower, "up")

        def smooth(x: str) -> Column:
            n, c, t, low = (F.col(y + x) for y in "nctl")
            return F.when(c + t > 0, (n + t * low) / (c + t)).otherwise(low)

        lower = both.select(F.col("s").alias("up"), smooth("a").alias("la"), smooth("r").alias("lr"))
    ratio = F.log("la") - F.log("lr")
    return lower.select(F.col("up").alias("gram"), F.round(ratio * MICRO).cast("long").alias("score"))


def _grams(text: str) -> Column:
    padded = F.concat(F.lit(START * (ORDER - 1)), F.col(text))
    return F.explode(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(padded, i, F.lit(ORDER))))


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``row`` (all columns of ``pages``), host, path, rule, verdict of every row.

    Digits are one character to the models, so URLs that differ in numbers share one score. A URL
    without host and path (null, empty, no ``://``) has no evidence and is allowed, and so is
    every URL without a rule when the rules accept or reject no held-out URL. Repeated rows are
    judged alike and count as often as they occur. The row is a struct, so columns cannot clash.
    """
    host, path = url_parts(F.col(url))
    verdicts = F.lit(None).cast("string")
    for rule in rules:
        verdicts = F.when(F.col("rule") == rule.text, rule.verdict).otherwise(verdicts)
    split = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    split = split.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("ruled", verdicts)
    split = split.withColumn("text", F.translate(F.concat("host", "path"), "123456789", "000000000"))
    held = F.substring(F.md5(F.col("text").cast("binary")), 1, 1).isin("0", "1", "2", "3")
    texts = staged(
        split.where("text != ''").groupBy("text").agg(
            F.sum(F.when(F.col("ruled") == "allow", 1).otherwise(0)).alias("accepted"),
            F.sum(F.when(F.col("ruled") == "block", 1).otherwise(0)).alias("rejected"),
        ),
        "url-texts",
    )
    learn = lambda c: F.when(held, 0).otherwise(F.col(c)).alias(c)
    grams = texts.select(_grams("text").alias("gram"), learn("accepted"), learn("rejected"))
    grams = staged(grams.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "grams")
    points = texts.select("text", _grams("text").alias("gram")).join(gram_scores(grams), "gram")
    scored = staged(
        points.groupBy("text").agg(F.floor(F.sum("score").cast("double") / F.count(F.lit(1))).alias("score")), "url-scores"
    )
    # The threshold: a few thousand steps at most, whatever the number of URLs.
    steps = (
        scored.join(texts.where(held), "text")
        .groupBy(F.floor(F.col("score") / STEP).alias("step"))
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    )
    before = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    gain = F.coalesce(F.sum("rejected").over(before), F.lit(0)) / F.sum("rejected").over(whole) - F.coalesce(
        F.sum("accepted").over(before), F.lit(0)
    ) / F.sum("accepted").over(whole)
    usable = (F.sum("rejected").over(whole) > 0) & (F.sum("accepted").over(whole) > 0)
    best = (
        steps.select("step", F.when(usable, F.round(gain, 9)).alias("gain"))
        .where("gain > 0")
        .agg(F.max_by("step", F.struct("gain", -F.col("step"))).alias("cut"))
    )
    cut = best.select(F.col("cut") * STEP).scalar()
    judged = scored.select("text", F.when(F.col("score") < cut, "block").otherwise("allow").alias("judged"))
    return split.join(judged, "text", "left").select(
        "row", "host", "path", "rule", F.coalesce("ruled", "judged", F.lit("allow")).alias("verdict")
    )
