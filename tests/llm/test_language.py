import zlib

import numpy as np
from llm_fixtures import DOCS

from shelfwise.llm import language
from shelfwise.llm.queries import LLM_CATALOG

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = LLM_CATALOG["op6_language_id"](spark, FOLDER).toPandas()
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(table, on="doc_id")
    assert len(both) == len(got) == len(table)
    assert (both["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in both["doc_id"]]).all()
    held = both[both["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert both["score"].between(0, 1).all()


def test_texts_without_letters_and_whole_rows(spark, odd_docs, odd_rows, no_docs):
    model = language.train(odd_docs)
    clash = odd_docs.withColumnRenamed("source", "SCORE").withColumnRenamed("n_chars", "found")
    got = language.identify(clash, model).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in ("en", "de")) if letters else (r["lang_pred"], r["score"]) == ("und", 0.0)
    kept = language.accepted(clash, model)
    assert kept.columns == clash.columns and kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in odd_rows)
    assert language.identify(no_docs, model).count() == 0


def test_nothing_to_learn_from(spark, no_docs, odd_docs):
    model = language.train(no_docs)
    assert {r["lang_pred"] for r in language.identify(odd_docs, model).collect()} == {"und"}


def test_many_families(spark):
    rng = np.random.default_rng(0)
    sounds = {"en": "th ing er", "de": "sch ung ich", "fr": "eau oi que", "ru": "ый ств ое", "xx": "qzk zkq kqq", "uk": "ій ств ія"}
    rows = [
        (i, " ".join("".join(rng.choice(own.split(), 3)) for _ in range(30)), lang, "s", 0)
        for i, (lang, own) in enumerate(list(sounds.items()) * 30)
    ]
    docs = spark.createDataFrame(rows, DOCS)
    model = language.train(docs)
    assert model.families == ["germanic", "romance", "slavic", "xx"]
    got = language.identify(docs, model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.98


def test_held_out_rows_teach_nothing(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "only words of one kind", "zz" if i in held else "en", "s", 0) for i in range(400)]
    assert language.train(spark.createDataFrame(rows, DOCS)).members == {"germanic": ["en"]}


def test_numerals_are_no_letters(spark):
    model = language.LanguageModel(["a"], np.zeros((1, language.SIZE), np.float32), np.zeros(1), {"a": ["en"]}, {"a": []})
    texts = ["½ ² ①", "Ⅷ 3 ٣", "", None, "½ a", "ª"]
    assert [lang for lang, _ in model.predict(texts)] == ["und"] * 4 + ["en"] * 2
    judged = language.identify(spark.createDataFrame([(t,) for t in texts], "text string"), model).toPandas()
    letters = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr(r"coalesce(text rlike '\\p{L}', false) AS l").toPandas()
    assert (judged["lang_pred"] != "und").tolist() == letters["l"].tolist()


def test_least_score_passes_taught_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.train(docs)
    assert 0 < model.least < 0.5
    right = language.identify(docs.where("lang is not null"), model).where("lang_pred = lang")
    assert right.where(right["score"] < model.least).count() <= 0.002 * right.count()
    foreign = spark.createDataFrame([(1, "Ω ж 語")], "doc_id long, text string")
    assert language.accepted(foreign, model, 1.1).count() == 0
