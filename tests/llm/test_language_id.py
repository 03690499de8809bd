import duckdb
import numpy as np
import pytest

from conftest import SF
from salesflow.llm import language_id as L
from salesflow.llm.queries import op1_language_id


def answers(spark, df, model, n=None):
    from pyspark.sql import functions as F

    rows = df.select("doc_id", L.predict(spark, model, F.col("text")).alias("a")).collect()
    return [(r.doc_id, r.a.lang, r.a.score) for r in rows]


def test_held_out_accuracy(spark):
    got = op1_language_id(spark, SF).toPandas().set_index("doc_id")
    truth = duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").df().set_index("doc_id")
    held = got[got.held_out]
    assert len(got) == len(truth) and len(held) > 20
    assert (held.lang_pred == truth.lang[held.index]).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_odd_rows(spark, odd):
    model = L.fit(odd)
    got = answers(spark, odd, model)
    assert len(got) == odd.count()
    none = {d for d, lang, s in got if lang == "und" and s == 0}
    assert none == {2, 3, 4, 5, 9}
    same = [(lang, s) for d, lang, s in got if d in (1, None)]
    assert len(set(same)) == 1


def test_nothing_learned_and_empty_table(spark, odd):
    assert L.fit(odd.where("lang = 'xx'")) is None
    assert {a[1] for a in answers(spark, odd, None)} == {"und"}
    assert answers(spark, odd.limit(0), L.fit(odd)) == []


def test_a_hot_id_and_a_hot_text_are_learned_from(spark):
    rows = [(7, f"the words of text {k} with the other and this") for k in range(3000)]
    english = spark.createDataFrame([(*r, "en") for r in rows], "doc_id int, text string, lang string")
    german = spark.createDataFrame([(8, "und der die das nicht mit von", "de")] * 3000, english.schema)
    model = L.fit(english.union(german))
    got = {lang for _, lang, _ in answers(spark, english, model)}, {lang for _, lang, _ in answers(spark, german, model)}
    assert got == ({"en"}, {"de"})


def test_too_many_labels_are_an_error(spark):
    many = spark.range(1001).selectExpr("id doc_id", "'some text' text", "concat('l', id) lang")
    with pytest.raises(ValueError, match="1000 labels"):
        L.fit(many)


def test_one_language_is_always_the_answer(spark, odd):
    model = L.fit(odd.where("lang = 'en'"))
    assert {lang for d, lang, _ in answers(spark, odd, model) if d in (1, 6, 8)} == {"en"}


def test_features_do_not_depend_on_chunks(monkeypatch):
    text = "Les élèves  étaient, à l'école; " * 50
    whole = L.features(text)
    monkeypatch.setattr(L, "CHUNK_BYTES", 97)
    assert np.allclose(L.features(text), whole, atol=0.05) and L.features("").sum() == 0


def test_families():
    assert L.family("en") == L.family("de-AT") != L.family("fr")
    assert L.family("tlh") == "tlh"
