import re
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_fixtures import FOLDER, read_table
from pyspark.sql import functions as F

from shelfwise.llm.collocations import COUNTS, Summary, collocations, counted, frequent_of, frequent_phrases, marks_of_phrases, packed, unpacked
from shelfwise.llm.queries import LLM_CATALOG


def grams_of(rows, longest=3):
    """Occurrences of every phrase, and of all words, by language; rows are (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                f[lang or "und"].update(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
    return f, n


def plainly(rows, least=10, longest=3, inside=50, first=2000):
    f, n = grams_of(rows, longest)
    out = []
    for lang, own in f.items():
        cands = {p: a for p, a in own.items() if " " in p and a >= least}
        held = Counter()
        for p, a in cands.items():
            w = p.split(" ")
            for size in range(2, len(w)):
                for i in range(len(w) - size + 1):
                    held[" ".join(w[i : i + size])] = max(held[" ".join(w[i : i + size])], a)
        ranked = []
        for p, a in cands.items():
            if p in held and 100 * held[p] >= inside * a:
                continue
            w = p.split(" ")
            cuts = []
            for k in range(1, len(w)):
                l, r = own[" ".join(w[:k])], own[" ".join(w[k:])]
                cuts.append((1_000_000 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            ranked.append((-score, -a, p.encode(), p, a, l, r, score))
        out += [(lang, i + 1, p, a, l, r, n[lang], s) for i, (_, _, _, p, a, l, r, s) in enumerate(sorted(ranked)[:first])]
    return sorted(out)


def rows_of(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 5000, "part_bytes": 2000, "fan": 4}])
def test_against_plain_counts(spark, sizes):
    table = read_table(FOLDER, "documents").head(150)
    rows = list(zip(table["text"], table["lang"]))
    got = collocations(spark.createDataFrame(rows, "text string, lang string").repartition(5), **sizes)
    assert rows_of(got) == plainly(rows)


def test_longer_phrases_and_other_limits(spark):
    rows = [("a b c d e. a b c d f! x A B c", "en"), ("a\tb  c d\x0be b a", None), ("ä Ö ä Ö ä, Ö ä", "de")] * 4
    got = collocations(spark.createDataFrame(rows, "text string, lang string"), least=3, longest=4, inside=80, first=5)
    assert rows_of(got) == plainly(rows, 3, 4, 80, 5)


def test_ties_and_repeated_rows(spark):
    rows = [("b a", "en"), ("a b", "en"), ("é z", "en"), ("z é", "en"), ("a a a a", "en")] * 10
    assert rows_of(collocations(spark.createDataFrame(rows, "text string, lang string"))) == plainly(rows)


def test_products_beyond_64_bits(spark):
    text = "new york " * 400_000
    got = collocations(spark.createDataFrame([(text, "en")] * 4, "text string, lang string"))
    assert rows_of(got) == plainly([(text, "en")] * 4)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    clash = odd_docs.withColumnsRenamed({"n_chars": "phrase", "source": "F"})
    assert rows_of(collocations(clash)) == plainly([(r[1], r[2]) for r in odd_rows])
    assert rows_of(collocations(no_docs)) == []
    assert rows_of(collocations(odd_docs.withColumn("text", F.lit(None).cast("string")))) == []


def test_every_frequent_phrase_survives_a_summary():
    counts = [(f"rare{i}", 1) for i in range(5000)] + [("often", 10), ("more", 30)]
    blocks = [pa.table([[p for p, _ in part], [n for _, n in part]], schema=COUNTS) for part in (counts[i::7] for i in range(7))]
    blocks += [pa.table([["often", "steady"], [1, 1]], schema=COUNTS)] * 9
    mass = sum(sum(b.column("n").to_pylist()) for b in blocks)
    summary = Summary(mass // 10 + 1)
    for block in blocks:
        summary.merge(block)
        assert summary.kept.num_rows <= summary.capacity
    kept = set(summary.settle().column("phrase").to_pylist())
    assert len(kept) <= mass // 10 + 1
    assert {"often", "more"} <= kept


def test_many_small_blocks_are_looked_up_together(monkeypatch):
    rows = [[(f"é{i % 40} w{j}", 1 + i % 3) for j in range(3)] for i in range(900)]
    blocks = [packed(pa.table([[p for p, _ in part], [n for _, n in part]], schema=COUNTS)) for part in rows]
    assert unpacked(*blocks[:2]).to_pylist() == [{"phrase": p, "n": n} for part in rows[:2] for p, n in part]
    assert unpacked().num_rows == 0 and unpacked(packed(COUNTS.empty_table())).num_rows == 0
    asked, is_in = [], pc.is_in
    monkeypatch.setattr(pc, "is_in", lambda *a, **k: asked.append(1) or is_in(*a, **k))
    true = Counter()
    for part in rows:
        true.update(dict(part))
    found = frequent_of(blocks, 44)
    assert len(asked) < 5
    assert {r["phrase"]: r["n"] for r in found.to_pylist()} == {p: n for p, n in true.items() if n >= 44} != dict(true)


def test_languages_fill_chunks_of_their_own(spark):
    rows = [(f"one two three {i % 7}. " * 5, f"l{i % 5}") for i in range(200)]
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    for sizes in ({"chunk_bytes": 400}, {"chunk_bytes": 2000, "part_bytes": 200, "fan": 3}):
        assert rows_of(collocations(df, **sizes)) == plainly(rows)


def test_hashes_agree():
    words, found = counted(["the same words, again the same", "Ä ö; the same"], 3)
    assert words == 10
    for phrases, marks, _ in found:
        assert marks_of_phrases(phrases.cast(pa.string())).tolist() == marks.tolist()


def test_counts_are_exact(spark):
    table = read_table(FOLDER, "documents").head(80)
    rows = list(zip(table["text"], table["lang"]))
    f, n = grams_of(rows, 2)
    got = frequent_phrases(spark.createDataFrame(rows, "text string, lang string"), F.coalesce("lang", F.lit("und")), 4, 2).collect()
    assert {(r["lang"], r["phrase"]): r["f"] for r in got if r["phrase"]} == {(l, p): a for l in f for p, a in f[l].items() if a >= 4}
    assert {r["lang"]: r["f"] for r in got if r["phrase"] is None} == {l: a for l, a in n.items() if a}


def test_query(spark):
    table = read_table(FOLDER, "documents")
    assert rows_of(LLM_CATALOG["op12_collocations"](spark, FOLDER)) == plainly(zip(table["text"], table["lang"]))
