import math
import random
import re
from collections import Counter

from corpus_fixtures import docs, messy  # noqa: F401
from pyspark.sql import functions as F
from recordflow.llm import quality


def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_measures_equal_plain_code(docs, messy):
    rng = random.Random(7)
    rows = [*messy, (30, "é # * a\vb\fc\u00a0d <x> " * 4), (31, "a b c d e " * 9 + "f g h")]
    rows += [(40 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(30)))) for i in range(60)]
    rows += [(200 + i, "\n".join(rng.choice(["x y", "", " ", "z"]) for _ in range(9))) for i in range(20)]
    got = quality.describe(docs(rows), ("doc_id", "text")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[n] for n in NAMES) == measures(r.text)


def test_allowed_rejections_are_the_exact_bound(spark):
    error = 1e-3
    df = spark.createDataFrame([(n,) for n in (0, 1, 100, 687, 700, 5000, 40000)], "n long")
    for n, k in df.select("n", quality._allowed(F.col("n"), F.lit(error))).collect():
        p, total, best = quality.LIMIT, 0.0, -1
        for i in range(n + 1 if n < 3000 else math.ceil(n * p) + 1):
            total += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p))
            if total > error:
                break
            best = i
        assert k == best, n


def test_junk_goes_and_good_documents_stay(spark, docs):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8)))
    good = [(i, " ".join(word() for _ in range(60)), "en") for i in range(4000)]
    junk = [(5000 + i, " ".join(word() + "###" for _ in range(60)), "en") for i in range(300)]
    rare = [(9000 + i, " ".join(word() + "###" for _ in range(60)), "fr") for i in range(20)]
    labels = [(i, 1) for i in range(0, 4000, 2)] + [(5000 + i, 0) for i in range(0, 300, 2)] + [(1, None), (9000, 0), (9001, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality.judge(docs(good + junk + rare), marks).collect()}
    assert all(kept[i] for i in range(4000)) and not any(kept[5000 + i] for i in range(300))
    assert all(kept[9000 + i] for i in range(20))  # too few labels in this stratum to reject safely


def test_messy_rows(spark, docs, messy):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.judge(docs(messy), none).collect()
    assert len(rows) == len(messy) and all(r.kept == (not r.base_failed) for r in rows)
    assert quality.judge(docs([]), none).collect() == []
