import subprocess
import sys
import textwrap
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_bagminhash import plainly as classes_of
from test_packing import check

from shelfwise.session import materialize

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def outputs(spark):
    """What goes into and comes out of every stage."""
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    extra = docs.limit(3).select(F.lit(None).cast("long").alias("doc_id"), F.lit(" 12 ").alias("text"), "lang", "source", "n_chars")
    docs = materialize(docs.union(extra))
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, FOLDER))
        found.append((name, docs, after))
        docs = after
    return found


def test_columns(outputs):
    for _, before, after in outputs[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"] == before.columns


def test_filters_keep_rows_whole(outputs):
    for _, before, after in outputs[:3]:
        assert after.exceptAll(before).isEmpty()


def test_language(outputs):
    _, before, after = outputs[0]
    gone = before.exceptAll(after).collect()
    assert [r["text"] for r in gone] == [" 12 "] * 3


def test_toxicity(spark, outputs):
    _, before, after = outputs[1]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    gone = before.join(after, "doc_id", "left_anti").join(labels, "doc_id").collect()
    clean = before.join(labels.where("toxic = 0"), "doc_id").count()
    assert gone and sum(1 for r in gone if r["toxic"] == 0) <= 0.05 * clean


def test_one_document_of_each_class(outputs):
    _, before, after = outputs[2]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert Counter(r["doc_id"] for r in after.collect()) == Counter({c: 1 for _, c in classes_of(rows)})


def test_packing(outputs):
    _, before, after = outputs[4]
    check([(r["doc_id"], r["text"]) for r in before.collect()], after.collect(), 2048, 0)


def test_the_rest_does_without(tmp_path):
    """The library, the entry file and its queries work where the operators are not installed."""
    code = """
        import importlib.abc, sys
        class Missing(importlib.abc.MetaPathFinder):
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline" or name.startswith("shelfwise.llm"):
                    raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        sys.meta_path.insert(0, Missing())
        import __spark_entry__ as entry
        names = entry.queries()
        assert "outlet_performance" in names and "pipeline" not in names
        assert not any(n.startswith("op1") for n in names) and not any(m.startswith("shelfwise.llm") for m in sys.modules)
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, check=True, timeout=120)
