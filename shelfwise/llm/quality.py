"""Quality rules: how far a document's characters and common words lie from those of its language.

One pass over the texts counts, per document, the base figures and two small histograms. The references are the mean
histograms of each language over all documents that pass the base rules. Distances are Jensen-Shannon distances with
base-2 logarithms, 0 for equal histograms and 1 for disjoint ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import slices, texts_of
from shelfwise.session import materialize

# The most common words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on are as with he be at by this had not but from have or one you an were all her she there would their we him been has when who will more no if out so said what up its about into than them can only other time new some could these two may then do first any my now such like our over man me even most made after also",
    "fr": "de la le et les des en un une du que qui dans est pour au par plus pas sur avec il se ne ce son sa ses mais ou comme on elle nous vous aux sont cette leur tout fait être deux même aussi",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más o pero sus le ya este si porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante",
}
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Below so many words the base rules fail; above this share of words in repeated windows too.
LEAST_WORDS, MOST_REPEATED = 10, 20

_VOCABULARY = {w: i for i, w in enumerate(sorted({w for ws in COMMON_WORDS.values() for w in ws.split()}))}
_WORD_BINS = {w.encode(): i for w, i in _VOCABULARY.items()}
_OTHER = len(_WORD_BINS)
CHAR_CLASSES = ["vowel", "consonant", "capital", "digit", "space", "line end", "stop", "symbol", "beyond ASCII", "other"]


def _char_class(byte: int) -> int:
    c = chr(byte)
    for number, members in enumerate(["aeiou", "bcdfghjklmnpqrstvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:!?'\"-()"]):
        if c in members:
            return number
    if 0x20 < byte < 0x7F:
        return 7
    return 8 if byte >= 0xC0 else 10 if byte >= 0x80 else 9  # 10: later bytes of a character, not counted


_CLASS_OF = np.array([_char_class(b) for b in range(256)])
#: Small letters stay, capitals become small, other ASCII characters separate words.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


@dataclass(frozen=True)
class Limits:
    """Distances above which a document is rejected, and the lengths from which each distance is looked at."""

    chars: float = 0.25
    words: float = 0.45
    least_chars: int = 200
    least_words: int = 50


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of ``WINDOW`` words that occur twice or more, the first time included."""
    if len(words) <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.uint64)
    with np.errstate(over="ignore"):
        codes = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        codes ^= codes >> np.uint64(29)
        n = len(words) - WINDOW + 1
        windows = sum(codes[i : n + i] * _MIX[i] for i in range(WINDOW))
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    change = np.zeros(len(words) + 1, dtype=np.int64)
    twice = np.flatnonzero(counts[place] > 1)
    change[twice] += 1
    change[twice + WINDOW] -= 1  # windows begin at different words, so no index comes twice
    return int((change.cumsum() > 0).sum())


def figures(text: str) -> tuple:
    """Base figures of a text, its length in characters and its two histograms."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at space and 0x09 to 0x0D only
    seen, duplicate = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            duplicate += line in seen
            seen.add(line)
    chars = np.bincount(_CLASS_OF[np.frombuffer(raw, dtype=np.uint8)], minlength=11)[:10]
    plain = raw.translate(_PLAIN).split()
    common = np.bincount(np.array([_WORD_BINS.get(w, _OTHER) for w in plain], dtype=np.int64), minlength=_OTHER + 1)
    white = sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = sum(text.count(c) for c in SYMBOLS)
    return len(words), len(text) - white, symbols, duplicate, repeated_words(words), len(text), chars, common


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_characters"]
HISTOGRAMS = {"chars": len(CHAR_CLASSES), "words": _OTHER + 1}


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the figures of every document; a histogram as the bins that occur and their shares."""
    counts = [T.StructField(n, T.LongType()) for n in COUNTS]
    bins = [T.StructField(f"{n}_bins", T.ArrayType(T.IntegerType())) for n in HISTOGRAMS]
    shares = [T.StructField(f"{n}_shares", T.ArrayType(T.DoubleType())) for n in HISTOGRAMS]
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang", T.StringType()), *counts, *bins, *shares])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                columns = list(zip(*map(figures, texts_of(part)), strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:6]]
                at = [[np.flatnonzero(h) for h in c] for c in columns[6:]]
                arrays += [pa.array(c, pa.list_(pa.int32())) for c in at]
                arrays += [
                    pa.array([h[i] / max(h.sum(), 1) for h, i in zip(c, i_of, strict=True)], pa.list_(pa.float64()))
                    for c, i_of in zip(columns[6:], at, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), *arrays], schema.fieldNames())

    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").mapInArrow(run, schema)


def references(sound: DataFrame) -> DataFrame:
    """Mean histograms of each language, as arrays over all bins."""

    def tagged(kind: str) -> Column:
        name = F.lit(kind).alias("kind")
        return F.zip_with(f"{kind}_bins", f"{kind}_shares", lambda at, p: F.struct(name, at.alias("bin"), p.alias("share")))

    shares = sound.select("lang", F.explode(F.concat(*map(tagged, HISTOGRAMS))).alias("x")).select("lang", "x.*")
    sums = shares.groupBy("lang", "kind", "bin").agg(F.sum("share").alias("share"))

    def dense(rows: pd.DataFrame) -> pd.DataFrame:  # one row per bin of a language
        out = {"reference_lang": [rows["lang"].iloc[0]]}
        for n, size in HISTOGRAMS.items():
            own, mean = rows[rows["kind"] == n], np.zeros(size)
            mean[own["bin"]] = own["share"]
            out[f"{n}_reference"] = [(mean / max(mean.sum(), 1e-300)).tolist()]
        return pd.DataFrame(out)

    return sums.groupBy("lang").applyInPandas(dense, "reference_lang string, chars_reference array<double>, words_reference array<double>")


def distance(bins: Column, shares: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a sparse histogram from a reference over all bins.

    Each bin that does not occur adds half its reference share; that is half of all, less what the occurring bins have.
    """

    def part(at: Column, p: Column) -> Column:
        q = F.get(reference, at)
        m = (p + q) / 2
        return (p * F.log2(p / m) + F.when(q > 0, q * F.log2(q / m)).otherwise(F.lit(0.0)) - q) / 2

    total = F.aggregate(F.zip_with(bins, shares, part), F.lit(0.5), lambda a, x: a + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def judge_quality(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Base figures, distances and verdict of every document of ``docs`` (doc_id, text, lang).

    ``base_failed``: under ten words, or more than a fifth of the words in repeated five-word windows. ``kept``: not
    failed, and neither distance above its limit; a distance is null, and not looked at, below the least length or
    where no document of the language (a null one counts as a language) passes the base rules. Null text has no words.
    Rows are judged one by one, whether doc_id is null, repeated or not; other columns are not read.
    """
    limits = limits or Limits()
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = materialize(measure(docs)).withColumn("base_failed", failed)
    reference = materialize(references(judged.where("not base_failed")))
    joined = judged.join(reference, F.col("lang").eqNullSafe(F.col("reference_lang")), "left")
    far = {
        f"{c}_distance": F.when(F.col(length) >= least, distance(*(F.col(f"{c}_{x}") for x in ("bins", "shares", "reference"))))
        for c, length, least in (("chars", "n_characters", limits.least_chars), ("words", "n_words", limits.least_words))
    }
    fits = [F.coalesce(F.col(f"{c}_distance") <= most, F.lit(True)) for c, most in (("chars", limits.chars), ("words", limits.words))]
    out = joined.withColumns(far).withColumn("kept", ~F.col("base_failed") & fits[0] & fits[1])
    return out.select("doc_id", *COUNTS[:5], "base_failed", "kept", *far)
