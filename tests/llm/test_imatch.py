import base64
import hashlib
import re

import numpy as np
import pyarrow as pa

from corpus_fixtures import docs, messy  # noqa: F401
from recordflow.llm import imatch
from recordflow.llm.common import text_bytes
from recordflow.llm.wordhash import mix, word_hashes


def following(rows):
    """Each row with its edited text and the next text, rows without ties: descending id, null last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, r in enumerate(order):
        text, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        out[r[0]] = (text, text[: len(text) - k] + nxt[:k], nxt)
    return out


def cells(text):
    """Distinct terms by plain means: a hash of each word."""
    lower = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = set(re.findall(r"[^\x20\x09-\x0D]+", lower))
    hashes = [word_hashes(*text_bytes(pa.array([w])))[0][0] for w in words]
    return {int(h) % imatch.CELLS for h in hashes}


def one(x):
    return int(mix(np.array([x % 2**64], np.uint64))[0])


def brute_print(terms, frequency, n):
    """(level, whole, broad, narrow) of a set of terms."""
    low, high = (max(2, b * n) for b in imatch.BAND)

    def rank(c):
        f = frequency.get(c, 0)
        return 0 if low <= f <= high else min(255, 1 + round(8 * float(np.log2(max(f, 1)))))

    order = sorted(terms, key=lambda c: (rank(c), one(c)))
    own = sum(rank(c) == 0 for c in order)
    kept = order[: own + (-(-(len(order) - own) // 2) if 2 * own < len(order) else 0)]
    spot = {c: one(c + 0x51ED270B) for c in kept}
    value = {c: one(c * 0xD6E8FEB86659FD93 + 1) for c in kept}

    def whole(some):
        return max(1, one(sum(value[c] for c in some))) if some else 0

    level = int(np.ceil(np.log2(max(1, len(kept)))))
    broad = [whole([c for c in kept if (spot[c] >> 3 * k) % 8 < imatch.BROAD_EIGHTHS]) >> 32 for k in range(imatch.BROAD)]
    narrow = []
    for step in imatch.LEVELS:
        bits = min(max(level + step, 0), imatch.MOST_LEVEL)
        sums = [whole([c for c in kept if (spot[c] >> (64 - bits) if bits else 0) == s]) for s in range(imatch.SUBSETS)]
        narrow.append([max(1, x >> 48) if x else 0 for x in sums])
    return level, whole(kept), broad, narrow


def brute_likeness(a, b):
    if a[1] == b[1]:
        return 1.0
    if not a[1] or not b[1]:
        return 0.0
    broad = sum(x == y for x, y in zip(a[2], b[2])) / imatch.BROAD
    shared = [x + a[0] for x in imatch.LEVELS if x + a[0] >= 0 and x + a[0] - b[0] in imatch.LEVELS]
    if not shared:
        return broad
    best = min(shared, key=lambda x: (abs(x - a[0]) + abs(x - b[0]), -x))
    x, y = a[3][imatch.LEVELS.index(best - a[0])], b[3][imatch.LEVELS.index(best - b[0])]
    some = [(p, q) for p, q in zip(x, y) if p or q]
    return max(broad, sum(p == q for p, q in some) / len(some) if some else 0.0)


def check(rows, got):
    frequency = {}
    for r in rows:
        for c in cells(r[1] or ""):
            frequency[c] = frequency.get(c, 0) + 1
    told = {}
    for r in got:
        text, edited, nxt = following(rows)[r.doc_id]
        prints = []
        for t in (text, edited, nxt):
            if t not in told:
                told[t] = brute_print(cells(t), frequency, len(rows))
            prints.append(told[t])
        level, whole, broad, narrow = prints[0]
        raw = base64.b64decode(r.fingerprint)
        assert not set(r.fingerprint) & set("\r\n")
        want = bytes([level]) + whole.to_bytes(8, "big") + b"".join(x.to_bytes(4, "big") for x in broad)
        assert raw == want + b"".join(x.to_bytes(2, "big") for level in narrow for x in level)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - brute_likeness(prints[0], prints[1])) < 1e-12
        assert abs(r.near_next - brute_likeness(prints[0], prints[2])) < 1e-12


def test_against_plain_code(docs):
    rng = np.random.default_rng(1)
    words = [f"w{x}" for x in range(150)] + ["Der", "the", "É"]
    rows = [(i, " ".join(words[j] for j in rng.integers(0, 153, n))) for i, n in enumerate(rng.integers(0, 60, 40))]
    rows += [(100, rows[3][1]), (101, None), (102, "")]
    check(rows, imatch.fingerprint_edits(docs(rows)).collect())


def test_edits_and_likeness(spark, docs):
    rng = np.random.default_rng(3)
    words = [f"é{x}" for x in range(3000)]
    rows = [(i, " ".join(words[j] for j in rng.integers(0, 3000, n))) for i, n in enumerate(rng.integers(30, 900, 300))]
    rows += [(400, rows[7][1]), (401, rows[7][1])]
    got = {r.doc_id: r for r in imatch.fingerprint_edits(docs(rows)).collect()}
    assert got[400].fingerprint == got[401].fingerprint == got[7].fingerprint
    assert got[401].near_next == 1.0
    usual = [r for r in got.values() if r.doc_id < 400]
    assert np.mean([r.near_edited for r in usual]) > 0.25 and np.mean([r.near_next for r in usual]) < 0.1
    assert np.mean([r.near_edited > r.near_next for r in usual]) > 0.95


def test_near_copies_that_are_a_third_of_the_rows(docs):
    rng = np.random.default_rng(5)
    template = [f"t{x}" for x in range(120)]
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 4000, 150))) for i in range(400)]
    for i in range(200):
        own = list(template)
        for j in rng.integers(0, 120, 3):
            own[j] = f"own{i}x{j}"
        rows.append((1000 + 2 * i, " ".join(own)))
        # every other neighbour is another text, the rest are copies of the template
        if i % 2:
            rows.append((1001 + 2 * i, " ".join(f"v{x}" for x in rng.integers(0, 4000, 150))))
    got = [r for r in imatch.fingerprint_edits(docs(rows)).collect() if r.doc_id >= 1000 and r.doc_id % 2 == 0]
    assert len(got) == 200 and min(r.near_edited for r in got) > 0.1 and np.mean([r.near_edited for r in got]) > 0.25


def test_every_term_counts_and_few_changes_show(docs):
    base = [f"a{x}" for x in range(2000)]
    fill = [(i, " ".join(base)) for i in range(40, 42)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, "more"])), (3, " ".join(base[1:])), *fill]
    prints = {r.doc_id: base64.b64decode(r.fingerprint) for r in imatch.fingerprint_edits(docs(rows)).collect()}
    assert prints[1] == prints[40]
    for i in (2, 3):
        assert prints[1][1:9] != prints[i][1:9]  # one term of 2,000 changes the hash of all
        broad = [prints[1][9 + 4 * k : 13 + 4 * k] == prints[i][9 + 4 * k : 13 + 4 * k] for k in range(imatch.BROAD)]
        assert not all(broad)


def test_messy_rows(docs, messy):
    rows = [m for i, m in enumerate(messy) if i != 4]
    got = imatch.fingerprint_edits(docs(rows)).collect()
    check(rows, got)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len(imatch.fingerprint_edits(docs(messy)).collect()) == len(messy)
    assert imatch.fingerprint_edits(docs([])).collect() == []
    (one_row,) = imatch.fingerprint_edits(docs([(5, "abc def ghi")])).collect()
    assert one_row.edited_sha256 == hashlib.sha256(b"abc def abc").hexdigest() and one_row.near_next == 1.0
