import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpus_fixtures import docs, messy  # noqa: F401
from recordflow.llm import jaccard
from recordflow.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets, up = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in lists[x])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                up[find(i)] = find(j)
        for x in s:
            lists[x].append(i)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    named = [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(rows))]
    return sorted(
        ((r[0], len(s), n if s else r[0]) for r, s, n in zip(rows, sets, named)), key=repr
    )


def result(df):
    out = jaccard.near_duplicates(df)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)


def groups(seed=5):
    """Sets of many sizes, with neighbours just above and below the limit, and one large near group."""
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for size in [3, 5, 6, 7, 8, 9, 11, 16, 20, 30, 44, 60, 61, 63, 64, 65, 90, 120, 200]:
        base = [f"t{x}" for x in rng.integers(0, 10**9, size)]
        for changed in [0, 0, 1, 1, 2, size // 20, size // 9]:
            words = list(base)
            for at in rng.integers(0, size, changed):
                words[at] = f"c{rng.integers(0, 10**9)}"
            rows.append((n, " ".join(words)))
            n += 1
    common = [f"p{x}" for x in range(60)]
    for _ in range(40):  # near copies, and documents that only share the passage
        rows.append((n, " ".join([*common, f"u{n}"])))
        rows.append((n + 1, " ".join([*common, *[f"v{x}" for x in rng.integers(0, 10**9, 30)]])))
        n += 2
    return rows


@pytest.mark.parametrize("hot,block", [(2000, 1000), (3, 1000), (2000, 7)])
def test_equals_brute_force(spark, docs, monkeypatch, hot, block):
    monkeypatch.setattr(jaccard, "HOT_LIST", hot)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rows = groups()
    assert result(docs(rows)) == brute(rows)


def test_messy_rows(docs, messy):
    assert result(docs(messy)) == brute(messy)


def test_empty_table(docs):
    assert result(docs([])) == []


def test_boundary_follows_the_lists():
    lone, crowded = jaccard.small_boundary(1e6, 1e6), jaccard.small_boundary(1e6, 5e9)
    assert jaccard.small_boundary(0, 0) == 2 and lone < crowded <= jaccard.MOST_SMALL


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (100, 101)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_texts_travel_compressed():
    import pyarrow as pa

    text = " ".join(f"word{i % 40}" for i in range(2000)) + " é 日"
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 1, None], pa.int64()), "text": [text, text, ""]})
    sent = pa.Table.from_batches(jaccard._wanted_texts(b"\xff" * 1024)(iter([rows])))
    assert sent.column("doc_id").to_pylist() == [1, None]
    assert sum(len(x) for x in sent.column("text").to_pylist()) < len(text) / 4
    found, rest = jaccard._sets_of(sent)
    (plain,) = jaccard._sets(iter([rows.slice(0, 1)]))
    assert rest.num_rows == 0 and found[int(plain[3][0])].tolist() == plain[1].tolist()
