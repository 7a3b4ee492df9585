"""From raw documents to packed sequences: language, toxicity, near duplicates, source mixture, packing.

Each stage takes the session, the documents that the stage before kept, and the folder of the tables, and gives the
documents that go on (the last one: the pieces of the packed sequences). Rules that reject a document:

* language: the text is null or has no letter, or scores less than the model asks of a text in a language it was taught;
* toxicity: the classifier, taught by the labels of the folder, scores 0.5 or more;
* near duplicates: another document of its class has a smaller doc_id;
* mixture: none; documents of sources below their target weight are drawn again, those beyond it up to their budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import bagminhash, language, mixing, packing, toxicity
from shelfwise.llm.common import fresh, importable, table
from shelfwise.llm.tokens import with_token_counts
from shelfwise.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return language.accepted(docs, language.train(docs))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return bagminhash.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    tokens = fresh(docs, "n_tokens")
    drawn = mixing.mix(with_token_counts(docs, tokens), tokens=tokens)
    return drawn.select(*(f"`{c}`" for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return packing.pack(docs)


STAGES = [
    ("language identification", known_language),
    ("toxicity", not_toxic),
    ("near duplicates", one_of_each),
    ("source mixture", mixed),
    ("packing", packed),
]

#: Trained models and signatures are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each reading what the one before has written."""
    *before, (_, last) = STAGES
    docs = table(spark, sf_dir, "documents")
    for _, stage in before:
        docs = materialize(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
