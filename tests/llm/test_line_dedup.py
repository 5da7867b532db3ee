import numpy as np

from corpus_fixtures import docs, messy  # noqa: F401
from recordflow.llm import line_dedup


def result(df):
    rows = line_dedup.dedup_lines(df).select("row.doc_id", "row.text", "row.size", "kept_text", "n_lines", "n_removed")
    return sorted(rows.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))


def prose(rng, lines, words):
    return [" ".join(f"x{v}" for v in rng.integers(0, 10**9, words)) for _ in range(lines)]


def test_passages_go_from_all_but_the_first(spark, docs):
    rng = np.random.default_rng(1)
    long, multi = prose(rng, 1, 60), prose(rng, 5, 14)
    common = "A line that very many documents begin with."
    rows = []
    for i in range(60):
        own = prose(rng, 6, 12)
        put = [long, multi, multi[1:4], [common], []][i % 5]
        rows.append((i, "\n".join([*own[:3], *put, *own[3:]])))
    left = {r.doc_id: r.kept_text.split("\n") for r in result(docs(rows))}
    text = "\n".join("\n".join(x) for x in left.values())
    assert text.count(long[0]) == 1 and all(text.count(x) == 1 for x in multi[1:4])
    assert sum(common in x for x in left.values()) == 12  # one short line is no passage
    for i, whole in rows:  # what is a document's own stays
        assert all(x in left[i] for x in whole.split("\n") if x not in (*long, *multi))


def test_removed_lines_stay_in_an_earlier_document(spark, docs):
    rng = np.random.default_rng(2)
    pool = prose(rng, 40, 8) + prose(rng, 5, 55)
    rows = [(i, "\n".join(pool[j] for j in rng.integers(0, 45, 12))) for i in range(80)]
    seen = set()
    for r in result(docs(rows)):
        kept = r.kept_text.split("\n")
        assert all(x in seen or x in kept for x in r.text.split("\n"))
        assert r.n_removed == len(r.text.split("\n")) - (len(kept) if r.kept_text else 0)
        seen |= set(r.text.split("\n"))


def test_copies_and_messy_rows(docs, messy):
    whole = "The first line of it all.\nAnd here the second line."
    rows = result(docs([*messy, (20, whole), (21, whole), (22, whole + "\nWith one more.")]))
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 13 and by_id[1].kept_text is None and by_id[2].kept_text == "" and by_id[3].kept_text == " \t\n "
    assert [by_id[i].kept_text for i in (20, 21, 22)] == [whole, "", "With one more."]
    assert [r.kept_text for r in rows if r.doc_id == 4] == ["one two"] * 2
    assert by_id[6].size == "s" and by_id[6].n_removed == 0
    assert result(docs([])) == []


def test_whole_passages_go_whatever_stands_around_them(spark, docs):
    rng = np.random.default_rng(4)
    gaps = ["\n", "\n\n", "\n \n\n"]
    passages = [prose(rng, n, words) for n, words in [(2, 4), (2, 30), (3, 12), (8, 38), (5, 1)] for _ in range(6)]
    alone = [x for p in passages[::2] for x in p]
    rows = [(i, "\n".join([*prose(rng, 1, 9), x, *prose(rng, 1, 9)])) for i, x in enumerate(alone)]
    own = {}
    for i in range(180):
        p, gap = passages[i % 30], gaps[i // 30 % 3]
        own[1000 + i] = prose(rng, 4, 9)
        lines = [*own[1000 + i][:2], *p, *own[1000 + i][2:]]
        rows.append((1000 + i, gap.join(lines)))
    left = {r.doc_id: [x for x in r.kept_text.split("\n") if x.strip()] for r in result(docs(rows))}
    assert all(left[i] == rows[i][1].split("\n") for i in range(len(alone)))  # a short line alone is no passage
    for i in range(180):
        assert left[1000 + i] == [*own[1000 + i][:2], *(passages[i] if i < 30 else []), *own[1000 + i][2:]]


def test_passages_repeated_inside_a_document(spark, docs):
    a, b, c = prose(np.random.default_rng(5), 3, 7)
    cases = {
        (a, b, c, "", a, b): [a, b, c, ""],
        (a, b, a, b, a): [a, b],
        (a, a, a): [a, a, a],  # its two pairs overlap
        (b, b, b, b): [b, b],
        (a, "---", c, "", c, a, "", "---", c): [a, "---", c, "", c],
    }
    for lines, kept in cases.items():
        (row,) = result(docs([(1, "\n".join(lines))]))
        assert row.kept_text.split("\n") == kept and row.n_removed == len(lines) - len(kept)
