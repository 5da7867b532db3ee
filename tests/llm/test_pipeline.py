import corpus_pipeline
from conftest import SF_DIR
from corpus_fixtures import LONG, docs, messy  # noqa: F401
from recordflow.llm import jaccard
from recordflow.llm.common import staged, table
from recordflow.session import scratch_scope

STAGE = dict(corpus_pipeline.STAGES)


def test_every_stage_has_its_effect(spark):
    docs = table(spark, SF_DIR, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF_DIR), name)
        assert tuple(out.columns) == corpus_pipeline.COLUMNS
        seen[name] = (docs, out)
        docs = out
    ids = {k: {r.doc_id for r in v[1].select("doc_id").collect()} for k, v in seen.items()}
    before, after = seen["language_id"]
    assert after.count() >= 0.97 * before.count() and after.where("lang = 'und'").isEmpty()
    assert ids["line_dedup"] <= ids["language_id"]
    before, after = seen["near_dedup"]
    groups = {r.doc_id: r.component_id for r in jaccard.near_duplicates(before).collect()}
    assert ids["near_dedup"] == set(groups.values()) and after.count() == len(ids["near_dedup"])
    assert jaccard.near_duplicates(after).where("doc_id != component_id").isEmpty()
    before, after = seen["mixing"]
    assert ids["mixing"] <= ids["near_dedup"] and after.groupBy("doc_id").count().where("count > 3").isEmpty()
    packed = corpus_pipeline.pack(spark, docs, SF_DIR)
    pieces = packed.where("start = 0").count()
    assert pieces == docs.count()
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 1024").isEmpty()


def clashing(df):
    """The same rows with columns named like what the operators add."""
    extra = ("lang_pred", "score", "kept_text", "n_lines", "first", "k", "_key", "_group", "component_id", "place", "shard")
    return df.selectExpr("*", *[f"'x' as {c}" for c in extra if c not in df.columns])


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=repr)


def test_messy_rows_through_each_stage(spark, docs, messy):
    df = clashing(docs(messy))
    kept = rows_of(STAGE["language_id"](spark, df, SF_DIR))
    letterless = {None, "", " \t\n "}
    assert {t for _, t in kept}.isdisjoint(letterless) and set(kept) <= {(r[0], r[1]) for r in messy}
    assert kept.count((4, "one two")) in (0, 2)

    lines = rows_of(STAGE["line_dedup"](spark, df, SF_DIR))
    shorter = "Line one has words\nLine two has words\n"
    assert lines == sorted(((r[0], shorter if r[0] == 9 else r[1]) for r in messy), key=repr)

    near = rows_of(STAGE["near_dedup"](spark, df, SF_DIR))
    # LONG and LONG + " end" are near; the repeated row is one document
    assert near == sorted({(r[0], r[1]) for r in messy if r[0] != 7}, key=repr)

    mixed = rows_of(STAGE["mixing"](spark, df, SF_DIR))
    assert set(mixed) <= {(r[0], r[1]) for r in messy}
    packed = STAGE["packing"](spark, df, SF_DIR)
    starts = sorted((r.doc_id for r in packed.where("start = 0").collect()), key=repr)
    assert starts == sorted((r[0] for r in messy), key=repr)
    assert LONG.split()[0] == "w0x0"


def test_equal_and_null_ids_lose_no_text(spark, docs):
    a, b = ("the quick brown fox jumps over it " * 3).strip(), ("another text that has nothing of the first one at all " * 3).strip()
    rows = [(1, a), (1, b), (1, a), (None, a + " x"), (None, b), (None, "alone without any id, but with words of its own"), (None, "alone without any id, but with words of its own"), (None, None), (None, None), (2, "")]
    got = rows_of(STAGE["near_dedup"](spark, docs(rows), SF_DIR))
    want = [(1, a), (1, b), (None, "alone without any id, but with words of its own"), (None, None), (2, "")]
    assert got == sorted(want, key=repr)


def test_empty_tables(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, clashing(docs([])), SF_DIR).collect() == []


def test_run_leaves_only_what_its_result_reads(spark):
    with scratch_scope(spark) as scope:
        out = corpus_pipeline.run(spark, SF_DIR)
        held = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in scope.paths]
        assert out.count() > 0
    assert not {"language_id", "line_dedup", "near_dedup", "described", "places"} & set(held) and "pieces" in held
