import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_fixtures import docs, messy  # noqa: F401
from recordflow.llm import mixing


def test_targets_reshare_the_excess():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([187.5, 75, 37.5])
    assert mixing.targets([10, 100, 100], [5, 2, 1]) == pytest.approx([30, 120, 60])
    assert mixing.targets([0, 0], [5, 2]).tolist() == [0, 0] and len(mixing.targets([], [])) == 0


def test_tree_keeps_the_quotas():
    quotas = np.array([7, 0, 130, 1])
    parts = mixing.split_quotas(quotas, 13, np.random.default_rng(1))
    assert parts.shape == (13, 4) and (parts.sum(0) == quotas).all() and (parts >= 0).all()
    assert np.ptp(parts.sum(1)) <= 4  # shards are alike in size


def rows_of(df):
    return mixing.mix(df).select("row.doc_id", "row.source", "row.size", F.col("size").alias("words"), "source_size", "target", "uses").collect()


def test_words_come_to_their_targets(spark, docs):
    rng = np.random.default_rng(4)
    sources = rng.choice(["a", "b", "c", "tiny"], 4000, p=[0.1, 0.6, 0.29, 0.01])
    df = docs([(i, "w " * int(n), None, str(s)) for i, (n, s) in enumerate(zip(rng.integers(1, 300, 4000), sources))])
    rows = rows_of(df)
    size = {s: sum(r.words for r in rows if r.source == s) for s in set(sources)}
    want = dict(zip(sorted(size), mixing.targets([size[s] for s in sorted(size)], [5, 2, 1, 5])))
    for s in size:
        own = [r for r in rows if r.source == s]
        assert {(r.source_size, r.target) for r in own} == {(size[s], want[s])}
        assert sum(r.words * len(r.uses) for r in own) == pytest.approx(want[s], rel=0.01)
        uses = {len(r.uses) for r in own}
        assert max(uses) <= 3 and max(uses) - min(uses) <= 1
    assert sorted(map(repr, rows)) == sorted(map(repr, rows_of(df)))
    mixed = mixing.mixed_rows(mixing.mix(df, shards=8))
    assert mixed.count() == sum(len(r.uses) for r in rows) and mixed.select("row.*").columns == df.columns
    shards = [r["count"] for r in mixed.groupBy("shard").count().collect()]
    assert len(shards) == 8 and max(shards) < 1.5 * min(shards)  # each shard is mixed like the whole


def test_messy_rows(docs, messy):
    rows = rows_of(docs(messy))
    assert len(rows) == len(messy) and all(r.words * len(r.uses) <= 3 * r.words for r in rows)
    assert {r.words for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert len({len(r.uses) for r in rows if r.doc_id == 4}) == 1
    assert rows_of(docs([])) == []
