import numpy as np
from pyspark.sql import functions as F

from conftest import SF_DIR
from corpus_fixtures import docs, messy  # noqa: F401
from recordflow.llm import langid
from recordflow.llm.common import table
from recordflow.llm.queries import held_out


def test_held_out_accuracy(spark):
    docs = table(spark, SF_DIR, "documents")
    model = langid.fit(docs.where(~held_out()))
    found = langid.identify(docs.where(held_out()), model).where(F.length("row.text") > 100)
    right, n = found.agg(F.count_if(F.col("row.lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert right >= 0.97 * n


FOREIGN = [
    "これは日本語の文章です。" * 9,
    "Tämä on suomenkielinen teksti, jossa kerrotaan pohjoisen metsistä ja järvistä sekä ihmisistä, jotka asuvat siellä. " * 3,
    "To jest tekst po polsku, w którym mowa o lasach i jeziorach północy oraz o ludziach, którzy tam mieszkają od dawna. " * 3,
    "Bu metin Türkçe yazılmıştır ve kuzeydeki ormanları, gölleri ve orada yaşayan insanları uzun uzun anlatmaktadır. " * 3,
    "Это текст на русском языке, в котором рассказывается о лесах и озёрах севера и о людях, которые там живут. " * 3,
]


def test_foreign_texts_are_rejected(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    model = langid.fit(docs.where(~held_out()))
    rows = list(enumerate(FOREIGN))
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert {r["row"].doc_id: r.lang_pred for r in got} == dict.fromkeys(range(len(rows)), "und")
    # and nearly all texts of the corpus stay
    kept = langid.identify(docs.where(held_out() & langid.has_letter(F.col("text"))), model)
    n, und = kept.agg(F.count(F.lit(1)), F.count_if(F.col("lang_pred") == "und")).first()
    assert und <= max(2, 0.02 * n)


def test_cuts_by_language_and_length(monkeypatch):
    monkeypatch.setattr(langid, "CUT_LEAST", 10)
    own, other = np.zeros((32, 101), int), np.zeros((32, 101), int)
    own[8, 60:70], other[8, 40:50], other[5, 20:24], other[6, 20:26] = 4, 2, 1, 1
    cuts = langid._cuts(own, own + other)
    low = langid._low
    assert cuts[8] == low(own[8]) == 0.6  # texts of its own
    assert cuts[5] == 0 and cuts[6] == low(other[5] + other[6])  # too few; enough with shorter ones of all languages
    assert cuts[7] == cuts[6] and cuts[9] == low((own + other)[8])
    assert low(np.r_[1, np.zeros(49, int), np.full(51, 4)]) == 0.5  # less than one in a hundred


def test_messy_rows(spark, docs, messy):
    model = langid.fit(table(spark, SF_DIR, "documents"))
    rows = langid.identify(docs(messy), model).select("row.doc_id", "row.label", "lang_pred", "score").collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(messy) and by_id[1].label == "l"
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 8))
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 4}) == 1
    assert langid.identify(docs([]), model).collect() == []


def test_nothing_to_learn_from(docs, messy):
    assert langid.fit(docs([])) is None and langid.fit(docs([(1, "text", None), (2, "12", "en")])) is None
    rows = langid.identify(docs(messy), None).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
