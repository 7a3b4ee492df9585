import zlib

import numpy as np
import pytest
from llm_fixtures import DOCS

from shelfwise.llm import toxicity
from shelfwise.llm.queries import LLM_CATALOG
from shelfwise.llm.toxicity import Voters, fit_label_model, read_text, words_of

FOLDER = "/root/testdata/sf0.01"


def test_held_out_documents(spark):
    got = LLM_CATALOG["op4_toxicity"](spark, FOLDER).toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    both = got.merge(labels, on="doc_id")
    held = both[both["held_out"]]
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").toPandas().set_index("doc_id")["text"]
    insulting = both[[any(w in toxicity.INSULTS for w in words_of(texts[i])) for i in both["doc_id"]]]
    assert insulting.loc[insulting["toxic"] == 1, "predicted"].mean() > 0.95
    assert held.loc[held["toxic"] == 0, "predicted"].mean() < 0.05


def test_voters():
    voters = Voters.of(["moro*", "zap"])
    memory = toxicity._Words(voters)
    assert voters.word("morons") == voters.word("moroxyz") >= 0 and voters.word("mor") == -1
    assert "moron" not in voters.words and "idiot" in voters.words
    assert words_of("An IDIOT, 2 idiots!") == ["an", "idiot", "idiots"]
    fired, shares, share = read_text("You IDIOT, zap zap", memory)
    assert fired[voters.word("idiot")] == 1 and fired[voters.word("zap")] == 2 and fired[-1] == 0
    assert (shares**2).sum() == pytest.approx(1) and share == 0.75
    for text in ("", "  ", "clean words"):
        assert read_text(text, memory)[0].tolist() == [0] * (voters.number - 1) + [1]


def test_shouting_after_many_digits():
    voters = Voters.of([])
    memory = toxicity._Words(voters)
    for text, loud in (("SHOUTED WORDS", 1), ("7" * (1 << 20) + " SHOUTED WORDS", 1), ("7" * (1 << 20) + " TEN LETTER", 0)):
        assert read_text(text, memory)[0][voters.number - 3] == loud


def votes(rng, n, rates, twin):
    """Votes of voters with known rates, one that repeats the voter ``twin``, and one that fires where none does."""
    toxic = rng.random(n) < 0.2
    fired = rng.random((n, rates.shape[1])) < np.where(toxic[:, None], rates[1], rates[0])
    return toxic, np.concatenate([fired, fired[:, [twin]], ~fired.any(axis=1, keepdims=True)], axis=1)


@pytest.mark.parametrize("known", [0.3, 1.0])
def test_label_model_finds_rates_and_groups(spark, known):
    rng = np.random.default_rng(3)
    rates = np.array([[0.01, 0.05, 0.02, 0.1], [0.4, 0.5, 0.3, 0.6]])
    toxic, fired = votes(rng, 20_000, rates, 2)
    rows = [(np.packbits(f).tobytes(), int(t) if rng.random() < known else None) for f, t in zip(fired, toxic, strict=True)]
    model = fit_label_model(spark.createDataFrame(rows, "fired binary, toxic int"), 6)
    assert np.abs(model.rates[:, :4] - rates).max() < 0.06 and abs(model.prior - 0.2) < 0.05
    assert model.groups[2] == model.groups[4]
    belief = model.posterior(fired.astype(float))
    assert ((belief > 0.5) == toxic).mean() > 0.85


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = [(i, f"plain words number {i}" + " you idiot scum" * (i % 3 == 0), "en", "s", 0) for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(None, 1), (5, None), (4, 7)], "doc_id long, toxic int")
    model = toxicity.train(docs.union(odd_docs), labels)
    clash = docs.union(odd_docs).withColumnRenamed("lang", "found").withColumnRenamed("n_chars", "Score")
    got = toxicity.score_toxicity(clash, model).collect()
    assert len(got) == 120 + len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["score"] >= 0.5) == ("idiot" in (r["text"] or "")) for r in got)
    kept = toxicity.accepted(clash, model)
    assert kept.columns == clash.columns and kept.count() == 80 + len(odd_rows)
    assert toxicity.score_toxicity(no_docs, model).count() == 0


def test_without_labels_or_documents(spark, odd_docs, no_docs):
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    for docs in (no_docs, odd_docs):
        model = toxicity.train(docs, nothing)
        assert toxicity.accepted(odd_docs, model).count() == odd_docs.count()
