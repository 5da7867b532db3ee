import numpy as np
import pytest
from pyspark.sql import functions as F

from recordflow.llm import gnat

KINDS = "vec_id long, embedding array<float>, label int, score long, block int, leaf string, rank int"


def brute(rows, positives=5, negatives=10):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    size = max((len(r[1]) for r in rows if r[1]), default=1)
    known = []
    for i, v, label in rows:
        if i is not None and label is not None and usable(v):
            q = np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)
            known.append((i, np.pad(q, (0, size - len(q))), label))
    out = []
    for a, x, own in known:
        if a % 100:
            continue
        s = [(int(-(x @ y)), i, label == own) for i, y, label in known if i != a]
        for p, pid, _ in sorted(t for t in s if t[2])[:positives]:
            fits = sorted(t for t in s if not t[2] and 30 * -p <= 100 * -t[0] <= 90 * -p)[:negatives]
            out += [(a, pid, k + 1, n[1], -p, -n[0]) for k, n in enumerate(fits)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], KINDS)


def mined(spark, rows):
    return sorted(tuple(r) for r in gnat.mine(frame(spark, rows), F.col("vec_id") % 100 == 0).collect())


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(int(i) * 5, [float(a) for a in v.astype(np.float32)], int(c)) for i, v, c in zip(range(n), x, rng.integers(0, 4, n))]


@pytest.mark.parametrize("block", [16, 512])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(gnat, "BLOCK", block)
    rows = clustered(900, 8, 1)
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 1000


def test_a_third_of_the_rows_is_one_vector(spark, monkeypatch):
    monkeypatch.setattr(gnat, "BLOCK", 32)
    rows = clustered(600, 6, 2)
    rows += [(10_000 + i, rows[3][1], i % 3) for i in range(300)]
    assert mined(spark, rows) == brute(rows)


def test_messy_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (100, [1.0, 0.5], 1),
        (100, [1.0, 0.5], 1),
        (200, [1.0], 1),
        (300, [], 2),
        (400, [0.0, 0.0], 2),
        (500, [-1.0, 3.0], None),
        (600, None, 1),
        (700, [nan, 1.0], 1),
        (800, [inf, 1.0], 1),
        (900, [None, 1.0], 1),
        (None, [1.0, 1.0], 1),
        (1, [0.9, 0.5], 1),
        (2, [0.9, 0.5], 1),
        (3, [0.4, 0.5], 2),
        (4, [0.4, 0.5], 2),
        (5, [100.0, -90.0], 3),
    ]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, rows[5:11]) == []
    assert mined(spark, [(100, [1.0], 1)]) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(100 * i, [float(x) for x in rng.integers(100_000, 260_000, 3)], int(i % 2)) for i in range(40)]
    assert mined(spark, rows) == brute(rows)


def test_subtrees_are_left_out():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 6)) * 200
    x = np.rint(centres[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 6))).astype(np.int32)
    longest = float((x.astype(float) ** 2).sum(1).max())
    tree = gnat.Tree(x[:400], 4, longest)
    leaf = tree.leaves(x)
    for node, low, high in tree.measure(x, leaf):
        for old, new in zip(tree.ranges[node], (low, high)):
            old[: len(new), : len(new)] = new
    top = np.sort(gnat.scores(x[:1], x)[0])[-5]
    found = tree.visits(gnat.Annuli(x[:1], np.array([top]), np.array([1 << 60]), longest))
    hit = np.isin(leaf, list(found))
    assert set(np.flatnonzero(gnat.scores(x[:1], x)[0] >= top)) <= set(np.flatnonzero(hit))
    assert hit.mean() < 0.5


def test_neither_rows_nor_anchors_are_sent_to_leaves(spark, monkeypatch):
    monkeypatch.setattr(gnat, "BLOCK", 16)
    found = gnat.mine(frame(spark, clustered(900, 8, 6)), F.col("vec_id") % 100 == 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "Aggregate" not in plan


def test_anchors_are_dealt_evenly_whatever_their_ids(spark, monkeypatch):
    monkeypatch.setattr(gnat, "BLOCK", 16)
    one = [(5 * i, [0.5, 0.25], i % 3) for i in range(3200)]
    rows = gnat.usable(frame(spark, one).coalesce(1), "embedding", F.col("label"))
    index = gnat.Index(rows, F.col("vec_id") % 100 == 0)
    sizes = [r[0] // 8 for r in index.anchors.select(F.length("ids")).collect()]
    assert sum(sizes) == 160 and max(sizes) <= 25


@pytest.mark.parametrize("files, blocks, pairs", [(1, 1, 1), (7, 40, 1 << 30)])
def test_files_and_blocks_of_any_size(spark, monkeypatch, files, blocks, pairs):
    monkeypatch.setattr(gnat, "BLOCK", 8)
    monkeypatch.setattr(gnat, "LEAST_FILES", files)
    monkeypatch.setattr(gnat, "LEAST_ANCHOR_BLOCKS", blocks)
    for name in ("PAIRS", "PAIRS_OF_SAME", "PAIRS_A_LABEL"):
        monkeypatch.setattr(gnat, name, pairs)
    monkeypatch.setattr(gnat, "MOST_ADDED", 50)
    rows = clustered(500, 5, 7)
    rows += [(20_000 + i, rows[i % 9][1], i % 5) for i in range(100)] + rows[:60]
    assert mined(spark, rows) == brute(rows)


@pytest.mark.parametrize("copies", [1, 40])
def test_the_sample_is_the_smallest_hashes(spark, monkeypatch, copies):
    monkeypatch.setattr(gnat, "SAMPLE", 30)
    rows = gnat.usable(frame(spark, clustered(400, 3, 8)[:: copies] * copies), "embedding", F.col("label"))
    every = rows.orderBy(F.xxhash64("vec_id", "label", "vec")).limit(30).select("vec").collect()
    assert gnat._few(rows, rows.count()).column("vec").to_pylist() == [r["vec"] for r in every]


def test_best_rows_of_windows():
    rng = np.random.default_rng(9)
    low, high = np.array([[-50, 0], [10, 1], [-5, -50]]), np.array([[50, 9], [9, 30], [5, 50]])
    best = gnat.Best(low, high, 4)
    seen = []
    for first in rng.permutation(40) * 10:
        a, s, ids = rng.integers(0, 3, 12), rng.integers(-12, 12, 12), rng.integers(first, first + 10, 12)
        least, most = best.bounds(np.arange(3), int(first))
        use = (s >= least[a]) & (s <= most[a])
        best.add(a[use], s[use], ids[use])
        seen += zip(a, s, ids)
    best.settle()
    for a in range(3):
        for w in range(2):
            fits = sorted((-s, i) for x, s, i in seen if x == a and low[a, w] <= s <= high[a, w])[:4]
            n = best.found[a, w]
            assert list(zip(-best.score[a, w, :n], best.ids[a, w, :n])) == fits


def test_blocks_come_back_from_their_bytes():
    rng = np.random.default_rng(10)
    for n, dim, kind in ((1, 1, np.int16), (37, 5, np.int16), (70, 3, np.int32)):
        rows = rng.integers(-999, 999, (n, dim)).astype(np.int32)
        one = gnat.Block.of(np.arange(n), rng.integers(0, 3, n), rows, float((rows.astype(float) ** 2).sum(1).max()))
        data = np.frombuffer(one.to_bytes(kind), np.uint8)
        two = gnat.Block.read(data, dim, kind)
        assert len(data) % 8 == 0 and all(np.array_equal(x, vars(two)[name]) for name, x in vars(one).items())
