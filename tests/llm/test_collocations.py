import re
from collections import Counter

import numpy as np
import pytest

from corpus_fixtures import docs, messy  # noqa: F401
from recordflow.llm import collocations as C


def counts_of(rows):
    out = {}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang, *_ in rows:
        own = out.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                own.update(zip(*(words[i:] for i in range(k))))
    return out


def brute(rows, least=30, top=2000, covered=80):
    out = []
    for lang, f in counts_of(rows).items():
        wanted = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        above = {}
        for g, a in wanted.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    above[g[i : i + k]] = max(above.get(g[i : i + k], 0), a)
        found = []
        for g, a in wanted.items():
            if 100 * above.get(g, 0) >= covered * a:
                continue
            score, _, l, r = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), l, r))
        n = sum(c for g, c in f.items() if len(g) == 1)
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def result(df, **how):
    return sorted(tuple(r) for r in C.collocations(df, **how).collect())


def texts(n, seed, words=40, size=120):
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, words + 1)
    out = []
    for i in range(n):
        some = rng.choice(words, size, p=p / p.sum())
        text = "".join(f"{'W' if x % 3 else 'é'}{x}" + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ". "]) for x in some)
        out.append((i, text, ("en", "de", None)[i % 3]))
    return out


@pytest.mark.parametrize("chunk", [1 << 10, 2 << 20])
def test_against_plain_counts(docs, monkeypatch, chunk):
    monkeypatch.setattr(C, "_CHUNK", chunk)
    rows = texts(60, 1, words=9)
    want = brute(rows, least=5)
    assert result(docs(rows), least=5) == want and len({len(r[2].split()) for r in want}) == 3


def test_flow_of_shorter_phrases(docs):
    rows = texts(30, 2, words=6)
    f = counts_of(rows)
    bits = C.pair_filter(docs(rows).selectExpr("text", "lang", "xxhash64(coalesce(lang, 'und')) lang_key"), 3)
    assert len(bits) * 8 >= 1 << C.FILTER_BITS[0]
    want = brute(rows, least=3, top=10)
    assert result(docs(rows), least=3, top=10) == want and len(want) == 30
    assert sum(c for g, c in f["en"].items() if len(g) == 1) == next(r[6] for r in want if r[0] == "en")


def test_unary_paths_are_contracted(spark, docs):
    passage = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(i, f"x{i} {passage} y{i}", "en") for i in range(7)] + [(9, "gamma delta epsilon", "en")] * 2
    edges = [(" ".join(w[i : i + 4]), i) for w in [passage.split()] for i in range(5)]
    f = counts_of(rows)["en"]
    counts = [("en", " ".join(g), len(g), c) for g, c in f.items() if c >= 7]
    got = C.paths(spark.createDataFrame(counts, "lang string, gram string, size int, flow long")).collect()
    # The node "gamma delta epsilon" has two more ends, so the path is cut there.
    assert sorted(" ".join(r.words) for r in got) == ["alpha beta gamma delta epsilon", "gamma delta epsilon zeta eta theta"]
    assert len(edges) == sum(len(r.words) - 3 for r in got) and {r.flow for r in got} == {7}
    assert result(docs(rows), least=7) == brute(rows, least=7)


def test_ties_and_a_dominating_text(docs):
    rows = [(i, "b a, c a, B a, c a; b a. the the the the the", "fr") for i in range(40)]
    rows += [(100 + i, f"the {i}. the {i} a", "fr") for i in range(60)]
    assert result(docs(rows)) == brute(rows)


def test_messy_rows(docs, messy):
    assert result(docs(messy), least=2) == brute(messy, least=2)
    assert result(docs([])) == [] and result(docs([(1, None, None)])) == []
