"""Language identification in two steps: the family first, then one-versus-one linear machines within the family.

Features are hashed byte n-grams (one to three bytes) of the small-lettered text, as square roots of their shares, so
that every text has length one. All machines are Spark's linear support vector machines (a multinomial logistic model
where there are more than two families), fitted on a bounded sample of each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh, give_back, giving_back, held_out, slices
from shelfwise.llm.learning import bounded_sample, sparse
from shelfwise.session import materialize

#: Labelled documents of one language that the machines are fitted on.
SAMPLE_PER_LANGUAGE = 3000
BITS = 13
SIZE = 1 << BITS
UNKNOWN = "und"
ROUNDS, PENALTY = 20, 1e-4
#: Share of rightly told documents that the least score of a learned language may pass over, before it is halved.
PASSED_OVER = 0.001
#: Slope that turns a margin into a score.
SLOPE = 3.0

# Families of ISO 639-1 codes; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af lb fy yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "indo-aryan": "hi ur bn pa mr gu ne si",
    "iranian": "fa ps ku tg",
    "dravidian": "ta te kn ml",
    "semitic": "ar he am mt",
    "sinitic": "zh",
    "austronesian": "id ms tl jv",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

def has_letter(text: str | None) -> bool:
    """Whether some character is of the Unicode category letter; digits, fractions and numerals of any kind are not."""
    return any(map(str.isalpha, text or ""))


def grams(text: str) -> np.ndarray:
    """Hashed buckets of all n-grams of a text."""
    u = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    shift = np.uint32(32 - BITS)
    one = u * np.uint32(0x9E3779B1)
    two = one[:-1] + u[1:] * np.uint32(0x85EBCA77) + np.uint32(0x27D4EB2F)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + u[2:] * np.uint32(0x165667B1) if len(u) > 2 else two[:0]
    mixed = np.concatenate([one, two, three])
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0x2C1B3C6D)) >> shift


def features(text: str) -> np.ndarray:
    counts = np.bincount(grams(text), minlength=SIZE).astype(np.float32)
    return np.sqrt(counts / max(counts.sum(), 1))


class Machine(NamedTuple):
    """A linear machine between ``low`` (negative margin) and ``high``."""

    low: str
    high: str
    weights: np.ndarray
    bias: float


class LanguageModel(NamedTuple):
    families: list[str]
    family_weights: np.ndarray  # one row per family; margins between two are differences
    family_bias: np.ndarray
    members: dict[str, list[str]]
    machines: dict[str, list[Machine]]
    least: float = 0.0  # what a text must score to pass for one in a learned language

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        at = [i for i, x in enumerate(texts) if has_letter(x)]
        if at and self.families:
            for i, found in zip(at, self.judge(np.stack([features(texts[i]) for i in at])), strict=True):
                out[i] = found
        return out

    def judge(self, x: np.ndarray) -> list[tuple[str, float]]:
        """Language and score for rows of features."""
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(x)
        margins = x @ self.family_weights.T + self.family_bias
        first = margins.argmax(axis=1)
        ordered = np.sort(margins, axis=1)
        gap = ordered[:, -1] - ordered[:, -2] if len(self.families) > 1 else np.full(len(x), np.inf)
        sure = 1 / (1 + np.exp(-SLOPE * gap))
        for number, family in enumerate(self.families):
            rows = np.flatnonzero(first == number)
            if not len(rows):
                continue
            names = self.members[family]
            votes, total = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
            least = np.full((len(rows), len(names)), np.inf)
            for m in self.machines[family]:
                margin = x[rows] @ m.weights + m.bias
                for name, own in ((m.low, -margin), (m.high, margin)):
                    j = names.index(name)
                    votes[:, j] += own > 0
                    total[:, j] += own
                    least[:, j] = np.minimum(least[:, j], own)
            best = np.lexsort((-np.arange(len(names)) + np.zeros_like(votes), total, votes), axis=1)[:, -1]
            within = 1 / (1 + np.exp(-SLOPE * least[np.arange(len(rows)), best]))
            for row, winner, score in zip(rows, best, within * sure[rows], strict=True):
                out[row] = (names[winner], float(score))
        return out


def _sample_features(rows: DataFrame) -> DataFrame:
    schema = "lang string, indices array<int>, shares array<double>"

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [features(x) for x in part.column("text").to_pylist()]
                at = [np.flatnonzero(x) for x in found]
                shares = [x[i].astype(float) for x, i in zip(found, at, strict=True)]
                columns = [part.column("lang"), pa.array(at, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "indices", "shares"])

    return rows.select("lang", "text").mapInArrow(run, schema)


def train(docs: DataFrame, most: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Fit on about ``most`` documents of each language (doc_id, text, lang), held-out documents left out.

    Rows without lang or without a letter in the text teach nothing; without any row the model predicts ``und``.
    """
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where("lang is not null")
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    drawn = bounded_sample(rows, "lang", most, text="text")
    # A row that is repeated counts once, or one key could fill the sample many times over.
    own, kept = F.xxhash64(F.col("doc_id").cast("string"), "text").alias("own"), F.first("text").alias("text")
    sample = materialize(_sample_features(drawn.groupBy("lang", own).agg(kept)))
    points = sample.select("lang", sparse(SIZE, F.col("indices"), F.col("shares")).alias("features")).persist()
    try:
        counts = {r["lang"]: r["count"] for r in points.groupBy("lang").count().collect()}
        members: dict[str, list[str]] = {}
        for lang in sorted(counts):
            members.setdefault(FAMILY_OF.get(lang.lower(), lang), []).append(lang)
        families = sorted(members)

        def machine(low: list[str], high: list[str]) -> tuple[np.ndarray, float]:
            both = points.where(F.col("lang").isin(low + high))
            sizes = [sum(counts[x] for x in side) for side in (low, high)]
            labelled = both.withColumn("label", F.col("lang").isin(high).cast("double"))
            weight = F.when(F.col("label") == 1, sum(sizes) / (2 * sizes[1])).otherwise(sum(sizes) / (2 * sizes[0]))
            learner = LinearSVC(maxIter=ROUNDS, regParam=PENALTY, standardization=False, weightCol="weight")
            fitted = learner.fit(labelled.withColumn("weight", weight))
            return fitted.coefficients.toArray().astype(np.float32), fitted.intercept

        if len(families) <= 1:
            weights, bias = np.zeros((len(families), SIZE), np.float32), np.zeros(len(families))
        elif len(families) == 2:
            w, b = machine(members[families[0]], members[families[1]])
            weights, bias = np.stack([-w / 2, w / 2]), np.array([-b / 2, b / 2])
        else:
            number = F.lit(None).cast("double")
            for i, family in enumerate(families):
                number = F.when(F.col("lang").isin(members[family]), F.lit(float(i))).otherwise(number)
            learner = LogisticRegression(family="multinomial", maxIter=ROUNDS, regParam=PENALTY, standardization=False)
            fitted = learner.fit(points.withColumn("label", number))
            weights, bias = fitted.coefficientMatrix.toArray().astype(np.float32), fitted.interceptVector.toArray()
        machines = {
            f: [Machine(a, b, *machine([a], [b])) for a, b in combinations(names, 2)] for f, names in members.items()
        }
    finally:
        points.unpersist()
    model = LanguageModel(families, weights, bias, members, machines)
    return model._replace(least=_least_score(sample, model))


def _least_score(sample: DataFrame, model: LanguageModel) -> float:
    """Half of what all but one in ``1 / PASSED_OVER`` sampled documents score that are told right; 0 without any."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = np.zeros((part.num_rows, SIZE), np.float32)
                for row, at, shares in zip(x, part.column("indices").to_pylist(), part.column("shares").to_pylist()):
                    row[at] = shares
                found = model.judge(x)
                right = [s for (name, s), lang in zip(found, part.column("lang").to_pylist()) if name == lang]
                yield pa.RecordBatch.from_arrays([pa.array(right, pa.float64())], ["score"])

    if not model.families:
        return 0.0
    found = sample.mapInArrow(run, "score double").agg(F.percentile("score", F.lit(PASSED_OVER))).first()[0]
    return (found or 0.0) / 2


def identify(docs: DataFrame, model: LanguageModel, predicted: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language of each text and a score from 0 to 1.

    ``und`` with score 0 where the text is null, empty or has no letter. Every row is judged by its whole text alone;
    columns named like the two new ones are replaced, all others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    result = f"{predicted} string, {score} double"

    @F.pandas_udf(result)
    def look(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for a in range(0, len(texts), 256):
            rows += shared.value.predict(texts.iloc[a : a + 256].tolist())
        give_back()
        return pd.DataFrame(rows, columns=[predicted, score])

    found = fresh(docs, "found")
    out = docs.withColumn(found, look.asNondeterministic()("text"))
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in (predicted.lower(), score.lower())]
    return out.select(*kept, F.col(found)[predicted].alias(predicted), F.col(found)[score].alias(score))


def accepted(docs: DataFrame, model: LanguageModel, least: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least`` or more (that of the model if not given), with
    the columns they came with. A text that scores less lies at the border of all languages learned."""
    predicted, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    found = identify(docs, model, predicted, score)
    return found.where((F.col(predicted) != UNKNOWN) & (F.col(score) >= (model.least if least is None else least))).drop(predicted, score)
