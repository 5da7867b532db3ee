"""Quality rules with thresholds whose false rejections are bounded.

Each rule compares one measure of a text with a list of cutoffs. Labelled documents show, per
stratum, how many good ones each cutoff would reject. A cutoff is safe when so few rejections would
be improbable if the true rate were above the limit: an exact binomial bound, its error shared out
over all strata, rules and cutoffs that are tried. Of the safe cutoffs a rule takes the one that gains most.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordflow.llm.common import WORD, staged, words

WINDOW = 5
#: Most good documents of a stratum that one rule may reject, and the error of all bounds together.
LIMIT, ERROR = 0.01, 0.05
#: A rejected good document weighs as much as so many rejected bad ones.
COST = 5


@dataclass(frozen=True)
class Measure:
    """Rejects above a cutoff; ``value`` is a ratio of two columns in thousandths, high when bad."""

    name: str
    above: str
    below: str
    cutoffs: tuple[int, ...]
    inverse: bool = False

    def passed(self) -> Column:
        """How many cutoffs, ascending, the value exceeds."""
        over = [
            (F.col(self.above) * 1000 < c * F.col(self.below)) if self.inverse else (F.col(self.above) * 1000 > c * F.col(self.below))
            for c in self.cutoffs
        ]
        return sum((F.when(o, 1).otherwise(0) for o in over[1:]), F.when(over[0], 1).otherwise(0))


#: Cutoffs in the order of severity from lax to strict are read from the end: see ``_choices``.
MEASURES = (
    Measure("symbols", "n_symbols", "word_chars", tuple(range(10, 330, 10))),
    Measure("long_words", "word_chars", "n_words", tuple(range(4000, 20000, 500))),
    Measure("short_words", "word_chars", "n_words", tuple(range(4000, 800, -100)), inverse=True),
    Measure("repeats", "n_repeat_words", "n_words", tuple(range(6, 198, 6))),
    Measure("lines", "n_dup_lines", "n_words", tuple(range(1, 33))),
)


def describe(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The measures of every text; all 0 for null, empty and wordless texts.

    Columns: ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.
    Windows are compared by 64-bit hashes within one text, and only texts that repeat one are sorted.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    a = docs.select(
        *keep, text.alias("_text"), words(F.col("text")).alias("_words"), lines.alias("_lines")
    ).withColumn("n_words", F.size("_words").cast("long"))
    window = F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(WINDOW)]),
    )
    none = F.expr("cast(array() as array<bigint>)")
    b = a.select(
        *keep,
        "n_words",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("n_words") >= WINDOW, window).otherwise(none).alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
    c = b.withColumn("_order", F.when(repeats, ordered))
    places = F.filter(
        F.transform(
            "_order",
            lambda x, j: F.when(
                x["h"].eqNullSafe(F.get("_order", j - 1)["h"]) | x["h"].eqNullSafe(F.get("_order", j + 1)["h"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.aggregate(
        F.array_sort(places),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, i: F.struct((s["n"] + i + WINDOW - F.greatest(s["end"], i)).alias("n"), (i + WINDOW).alias("end")),
        lambda s: s["n"],
    )
    d = c.withColumn("n_repeat_words", F.when(F.col("_order").isNotNull(), covered).otherwise(F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return d.drop("_windows", "_order").withColumn("base_failed", failed)


def _allowed(n: Column, error: Column) -> Column:
    """The most rejections among n good documents that prove a rate of at most ``LIMIT``; -1: none do.

    Adds up the binomial probabilities of 0, 1, 2 ... rejections at the limit until they pass the error.
    """
    last = F.ceil(n * LIMIT).cast("int")
    start = F.struct(
        F.lit(0.0).alias("sum"), (n * math.log(1 - LIMIT)).alias("log"), F.lit(-1).cast("long").alias("k")
    )

    def step(s: Column, k: Column) -> Column:
        total = s["sum"] + F.exp(s["log"])
        following = s["log"] + F.log((n - k) / (k + 1.0)) + math.log(LIMIT / (1 - LIMIT))
        return F.struct(
            total.alias("sum"),
            F.coalesce(following, F.lit(-1e300)).alias("log"),
            F.when(total <= error, k.cast("long")).otherwise(s["k"]).alias("k"),
        )

    return F.aggregate(F.sequence(F.lit(0), last), start, step, lambda s: s["k"])


def choose_cutoffs(labelled: DataFrame, measures: Sequence[Measure] = MEASURES) -> DataFrame:
    """(stratum, rule, cut): the cutoff, by number, of each rule in each stratum; none where none is safe.

    ``labelled`` has stratum, good (boolean) and the measures. Counts are per stratum, rule and number of
    passed cutoffs, so their table has a few hundred rows a stratum.
    """
    rules = F.explode(F.array(*[F.struct(F.lit(m.name).alias("rule"), m.passed().alias("bin")) for m in measures]))
    counts = staged(
        labelled.select("stratum", "good", rules.alias("r"))
        .groupBy("stratum", F.col("r.rule").alias("rule"), F.col("r.bin").alias("bin"))
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")),
        "cutoff-counts",
    )
    group = Window.partitionBy("stratum", "rule")
    strict = group.orderBy(F.col("bin").desc())
    tries = sum(len(m.cutoffs) for m in measures)
    strata = counts.select("stratum").distinct().agg(F.count(F.lit(1))).scalar()
    seen = counts.select(
        "stratum",
        "rule",
        "bin",
        F.sum("good").over(strict).alias("rejected_good"),
        F.sum("bad").over(strict).alias("rejected_bad"),
        F.sum("good").over(group).alias("n_good"),
        F.sum("bad").over(group).alias("n_bad"),
    )
    safe = seen.where("bin > 0 and n_bad > 0").withColumn("error", F.lit(ERROR) / (tries * strata))
    safe = safe.withColumn("allowed", _allowed(F.col("n_good"), F.col("error")))
    gain = F.col("rejected_bad") / F.col("n_bad") - COST * F.col("rejected_good") / F.col("n_good")
    return (
        safe.where(F.col("rejected_good") <= F.col("allowed"))
        .withColumn("gain", F.round(gain, 9))
        .where("gain > 0")
        .groupBy("stratum", "rule")
        .agg(F.max_by("bin", F.struct("gain", "bin")).alias("cut"))
    )


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", measures: Sequence[Measure] = MEASURES) -> DataFrame:
    """Measures of every document, ``base_failed``, and ``kept``.

    ``labels`` has doc_id and quality (1 good, 0 bad); of several labels of a document the worst counts,
    null ones count nothing. A document without a label or with a null stratum value is judged like the
    others of its stratum (null: a stratum of its own). Without enough labels a stratum has no cutoffs,
    and then only the base rules reject. Repeated rows are judged alike. Only ``doc_id``, ``text`` and the
    stratum's column are read.
    """
    plain = docs.select("doc_id", "text", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))
    seen = staged(describe(plain, ("doc_id", "stratum")), "measures")
    marks = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    cuts = choose_cutoffs(seen.where(~F.col("base_failed")).join(marks, "doc_id"), measures)
    by_rule = [F.max(F.when(F.col("rule") == m.name, F.col("cut"))).alias(f"cut_{m.name}") for m in measures]
    chosen = cuts.groupBy("stratum").agg(*by_rule)
    fails = F.col("base_failed")
    for m in measures:
        fails = fails | F.coalesce(m.passed() >= F.col(f"cut_{m.name}"), F.lit(False))
    return seen.join(chosen, "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~fails).alias("kept")
    )
