import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from corpus_fixtures import docs, messy  # noqa: F401
from recordflow.llm import lblm

LEARN = "crc32(cast(doc_id as string)) % 7 != 2"


def tokens(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower)) + [None]


def brute(rows):
    counts = Counter()
    for i, text, *_ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(tokens(text))
    n, v = counts.total(), len(counts)
    out = []
    for i, text, *_ in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        ts = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)
        out.append((repr(i), held, len(ts), sum(counts[t] > 0 for t in ts), n, base))
    return sorted(out)


def scored(df):
    return lblm.score_texts(df, F.expr(LEARN)).collect()


def agree(got, rows):
    have = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    want = brute(rows)
    assert [h[:5] for h in have] == [w[:5] for w in want]
    assert np.allclose([h[5] for h in have], [w[5] for w in want], rtol=1e-9, atol=1e-9)


def speech(n, seed, long=150):
    """Two languages of 400 words each, and words that no other text has."""
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, 401)
    rows = []
    for i in range(n):
        words = [f"{'xy'[i % 2]}{w}{'ab'[i % 2]}" for w in rng.choice(400, long, p=p / p.sum())] + [f"own{i}Z"] * 3
        rows.append((i, " ".join(words)))
    return rows


def test_counts_and_held_out_gain(docs, monkeypatch):
    monkeypatch.setattr(lblm, "TABLE", 500)
    rows = speech(300, 1)
    got = scored(docs(rows))
    agree(got, rows)
    held = [r for r in got if r.held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    # The words of a context tell the language, worth log10(2) a word at most.
    assert len(held) > 30 and gain > 0.1
    assert all(r.score < 0 for r in got)


def test_probabilities_are_normalised(spark, docs):
    rows = speech(40, 2, 60)
    words, model = lblm.fit(docs(rows).select("text", F.lit(0).alias("deal")))
    before = np.random.default_rng(3).integers(0, lblm.OUTPUTS + 1, (lblm.CONTEXT, 5))
    each = [np.exp(model.log_probabilities(np.full(5, t), before)) for t in range(lblm.OUTPUTS)]
    assert np.allclose(sum(each), 1, atol=1e-6)
    # The words of each class, with one share for those never seen, are one as well.
    local = words.local()
    named = {int(k) for k in local.keys[local.outputs > 0].view(np.int64)}
    inside = Counter()
    for r in words.words.collect():
        if r.key not in named:
            inside[r.kind] += r.n + 1
    assert all(inside[c] + 1 == local.class_size[c] for c in range(lblm.CLASSES))
    assert words.tokens == sum(len(tokens(t)) for _, t in rows)


def test_steps_follow_the_gradient():
    """The step of a batch against numeric derivatives of the estimation's objective."""
    rng = np.random.default_rng(4)
    share = rng.dirichlet(np.ones(lblm.OUTPUTS))
    model = lblm.Model.initial(share)
    model.flat[len(model.flat) // 2 :] = 1e12
    target, before = rng.integers(0, lblm.OUTPUTS, 64), rng.integers(0, lblm.OUTPUTS, (lblm.CONTEXT, 64))
    start = model.flat.astype(np.float64)
    noise = np.random.default_rng(9).choice(lblm.OUTPUTS, lblm.NOISE, p=share)

    def objective(flat):
        m = lblm.Model(flat)
        odds = np.log(lblm.NOISE * share)
        q = m.vectors(before)
        data = (q * m.p["out"][target]).sum(1) + m.p["bias"][target] - odds[target]
        false = q @ m.p["out"][noise].T + m.p["bias"][noise] - odds[noise]
        return -(np.log1p(np.exp(-data)).sum() + np.log1p(np.exp(false)).sum()) / len(target)

    model.flat = start.copy()
    model.__init__(model.flat)
    model.learn(target, before, share, np.random.default_rng(9))
    step = (model.flat - start)[: len(start) // 2] * 1e6 / lblm.RATE
    for at in rng.integers(0, len(start) // 2, 60):
        up, down = start.copy(), start.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        assert abs((objective(up) - objective(down)) / 2e-5 - step[at]) < 1e-4


def test_messy_rows(docs, messy):
    got = scored(docs(messy))
    agree(got, messy)
    twins = [r.score for r in got if r.doc_id == 4]
    assert np.isclose(*twins, rtol=1e-6) and all(np.isfinite(r.score) for r in got)
    assert scored(docs([])) == []
    # doc 8 alone may be held out: nothing to learn from
    alone = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    (only,) = scored(docs([(alone, "a b")]))
    assert (only.train_tokens, only.n_known, only.base_score) == (0, 0, 0.0) and np.isfinite(only.score)
