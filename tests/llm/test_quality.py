import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import FOLDER, read_table

from shelfwise.llm import quality
from shelfwise.llm.quality import Limits, figures, judge_quality
from shelfwise.llm.queries import LLM_CATALOG

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def plainly(rows, limits):
    """Verdicts from dense histograms, document by document; rows are (text, lang)."""
    failed, shares, sizes = [], [], []
    for text, _ in rows:
        n, _, _, _, repeated = base(text)
        *_, length, chars, words = figures(text or "")
        failed.append(n < 10 or 100 * repeated > 20 * n)
        shares.append([h / max(h.sum(), 1) for h in (chars, words)])
        sizes.append((length >= limits.least_chars, n >= limits.least_words))
    by_lang = defaultdict(list)
    for (_, lang), bad, s in zip(rows, failed, shares, strict=True):
        if not bad:
            by_lang[lang].append(s)
    out = []
    for (_, lang), bad, s, looked in zip(rows, failed, shares, sizes, strict=True):
        far = []
        for k in (0, 1):
            if not by_lang[lang] or not looked[k]:
                far.append(None)
                continue
            q = np.mean([x[k] for x in by_lang[lang]], axis=0)
            m = (s[k] + q) / 2
            halves = [np.sum(p[p > 0] * np.log2(p[p > 0] / m[p > 0])) for p in (s[k], q)]
            far.append(np.sqrt(sum(halves) / 2))
        fits = all(d is None or d <= most for d, most in zip(far, (limits.chars, limits.words), strict=True))
        out.append((bad, not bad and fits, *far))
    return out


def compare(got, rows, limits):
    for r, (text, _), want in zip(got, rows, plainly(rows, limits), strict=True):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base(text)
        assert (r["base_failed"], r["kept"]) == want[:2]
        for name, value in (("chars_distance", want[2]), ("words_distance", want[3])):
            assert r[name] is None if value is None else r[name] == pytest.approx(value, abs=1e-9)


ODD = [
    "", None, " \x0b\x0c", "\x1c\x1d a b   c", "line\nline\n \n \nline \nline", "a b c d e a b c d e f", "a a a a a a a",
    "#*$%&|<> # x", "é ü 日本 " * 40, "the of and to in a is that for it was " * 9, "word " * 9, "x\ty\nz\rw\x0bv\x0cu " * 30,
]


def test_figures():
    for text in ODD:
        assert figures(text or "")[:5] == base(text)


def test_long_text_and_limits(spark):
    rng = np.random.default_rng(4)
    common = quality.COMMON_WORDS["en"].split()
    texts = [*ODD, *(" ".join(rng.choice(common, 80)) for _ in range(9)), "$$ 77 " * 60, " ".join(f"zq{i}x" for i in range(90)), " ".join(rng.choice(common, 60_000))]
    rows = [(t, lang) for t, lang in zip(texts, ["en", None, "de"] * 99)]
    docs = spark.createDataFrame([(i, t, lang, 1) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, kept int")
    for limits in (Limits(), Limits(0.05, 0.3, 1, 1)):
        compare(judge_quality(docs, limits).orderBy("doc_id").collect(), rows, limits)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert Counter(r["doc_id"] for r in judge_quality(odd_docs).collect()) == Counter(r[0] for r in odd_rows)
    assert judge_quality(no_docs).count() == 0


def test_query(spark):
    table = read_table(FOLDER, "documents").sort_values("doc_id")
    got = LLM_CATALOG["op8_quality_rules"](spark, FOLDER).orderBy("doc_id").collect()
    compare(got, list(zip(table["text"], table["lang"], strict=True)), Limits())
    good = read_table(FOLDER, "labels").query("quality == 1")["doc_id"]
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert np.mean([d in kept for d in good]) > 0.9
