"""Toxicity by weak supervision: many voters, a generative model of them, and a linear classifier on its posteriors.

Voters are word lists and patterns. A fixed list of insults votes by whole words; further voters are word beginnings
found over-represented in a bounded sample of labelled toxic documents (so inflected and unseen forms count); others look
at shouting and at strings of exclamation marks, and one speaks where no voter does. Each voter either fires or says nothing.

The label model is a two-class mixture fitted to the votes of all documents by expectation maximisation; labels of the
documents that may be learned from are held fixed there and go no further. It estimates for each voter how often it
fires in either class, and for each pair how far they fire together beyond that. Voters of a correlated group share one
weight. The classifier is a logistic regression on the posteriors, which the votes alone decide, of a bounded sample,
over the votes, their number and share, and hashed words.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh, give_back, giving_back, held_out, slices, texts_of
from shelfwise.llm.learning import bounded_sample, sparse
from shelfwise.session import materialize

#: Labelled documents of each class that voters are looked for in.
SAMPLE_PER_CLASS = 8000
#: Documents of either predicted class that the classifier is fitted on.
CLASSIFIER_SAMPLE = 8000
#: Of a voter found in the sample, the fewest toxic documents it fires in and the least log of its lift.
LEAST_SUPPORT, LEAST_LIFT = 6, 3.0
#: Least log-likelihood ratio of a voter; among millions of candidates chance reaches about 14.
LEAST_STRENGTH = 24.0
#: Word beginnings of these lengths, and whole words, are candidates.
BEGINNINGS = range(4, 9)
ROUNDS = 10
#: Correlation of two voters within a class from which they count as one group.
CORRELATED = 0.5
BUCKETS = 4096
#: Sums of the label model that are added up and sent together.
SLICE = 8192
#: Words remembered while a batch is worked on.
REMEMBERED = 50_000

# Plain insults.
INSULTS = (
    "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown clowns dumb imbecile "
    "filth vermin idiota estúpido estúpida basura imbécil asqueroso idiote stupide ordure minable dégoûtant crétin "
    "dumm dummkopf abschaum müll erbärmlich wertlos widerlich trottel versager"
).split()

_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[str]:
    """Small-lettered words without digits and ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).decode("utf-8", "surrogatepass").split()


class Voters(NamedTuple):
    """Whole words and word beginnings, each a voter of its own, then the pattern voters."""

    words: dict[str, int]
    beginnings: dict[str, int]
    number: int

    PATTERNS = ("shouting", "exclamation", "silence")

    @classmethod
    def of(cls, found: list[str]) -> Voters:
        """The fixed words that no found beginning covers, and the found ones (a trailing ``*`` marks a beginning)."""
        heads = [f[:-1] for f in found if f.endswith("*")]
        whole = [f for f in found if not f.endswith("*")]
        fixed = [w for w in INSULTS if w not in whole and not any(w.startswith(h) for h in heads)]
        names = [*fixed, *whole]
        return cls({w: i for i, w in enumerate(names)}, {h: len(names) + i for i, h in enumerate(heads)}, len(names) + len(heads) + len(cls.PATTERNS))

    def word(self, word: str, sizes: set[int] | None = None) -> int:
        """The voter that a word sets off, or -1; ``sizes`` are the lengths of the beginnings, if known."""
        hit = self.words.get(word, -1)
        for size in {len(h) for h in self.beginnings} if sizes is None else sizes:
            hit = max(hit, self.beginnings.get(word[:size], -1) if len(word) >= size else -1)
        return hit


class _Words(dict):
    """Word -> bucket and voter in one number, kept as long as there is room; made anew for every batch."""

    def __init__(self, voters: Voters):
        super().__init__()
        self.voters, self.sizes = voters, {len(h) for h in voters.beginnings}

    def __missing__(self, word: str) -> int:
        code = (self.voters.word(word, self.sizes) + 1) * BUCKETS + hash_word(word)
        if len(self) < REMEMBERED:
            self[word] = code
        return code


def hash_word(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def read_text(text: str, memory: _Words) -> tuple[np.ndarray, np.ndarray, float]:
    """Counts of the voters, hashed words as roots of shares, and the share of words that set off a voter."""
    codes = np.array([memory[w] for w in words_of(text)], dtype=np.int64)
    voters = memory.voters
    fired = np.bincount(codes // BUCKETS, minlength=voters.number + 1)[1:].astype(np.int32)
    hits = int(fired.sum())
    shares = np.sqrt(np.bincount(codes % BUCKETS, minlength=BUCKETS) / max(len(codes), 1)).astype(np.float32)
    letters = sum(1 for _ in islice(filter(str.isalpha, text), 11)) if text.isupper() else 0
    fired[voters.number - 3] = letters > 10
    fired[voters.number - 2] = text.count("!!") > 2
    fired[voters.number - 1] = not fired.any()
    return fired, shares, hits / max(len(codes), 1)


def vector(fired: np.ndarray, shares: np.ndarray, share: float) -> np.ndarray:
    """What the classifier sees."""
    lexical = fired[: -len(Voters.PATTERNS)]
    extra = np.array([np.log1p(lexical.sum()), (lexical > 0).sum() > 1, min(10 * share, 2.0)], dtype=np.float32)
    return np.concatenate([(fired > 0).astype(np.float32), extra, 0.5 * shares])


# --- voters ---------------------------------------------------------------------------------------------------------


def _candidates(texts: list[str]) -> set[str]:
    out: set[str] = set()
    for word in {w for t in texts for w in words_of(t)}:
        out.add(word)
        out.update(f"{word[:n]}*" for n in BEGINNINGS if n <= len(word))
    return out


def find_voters(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_PER_CLASS) -> Voters:
    """Every word and beginning of ``LEAST_STRENGTH`` in a bounded sample of the ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text).

    Strength is the likelihood ratio of firing in toxic and other documents; of two, one within the other, the stronger
    stays. The voters are as many as the sample bears out, whose size bounds them; a document that is repeated counts once.
    """
    # At most about two samples of ids are broadcast, so that no text is shuffled.
    sample = docs.join(F.broadcast(bounded_sample(labels, "toxic", most)), "doc_id").where("text is not null")
    sample = sample.groupBy("doc_id").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                seen: dict[str, list[int]] = {}
                for text, toxic in zip(texts_of(part), part.column("toxic").to_pylist(), strict=True):
                    for c in _candidates([text]):
                        seen.setdefault(c, [0, 0])[1 if toxic else 0] += 1
                columns = [pa.array(list(seen), pa.string())]
                columns += [pa.array([v[i] for v in seen.values()], pa.int64()) for i in (1, 0)]
                yield pa.RecordBatch.from_arrays(columns, ["candidate", "in_toxic", "in_other"])

    counted = sample.select("text", "toxic").mapInArrow(count, "candidate string, in_toxic long, in_other long")
    counted = counted.groupBy("candidate").agg(F.sum("in_toxic").alias("a"), F.sum("in_other").alias("b"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return Voters.of([])
    lift = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (other + 1))
    strong = counted.where(F.col("a") >= LEAST_SUPPORT).withColumn("lift", lift).where(F.col("lift") > LEAST_LIFT)
    strength = F.col("a") * F.col("lift") + (F.lit(toxic) - F.col("a")) * F.log(
        (F.lit(toxic + 1) - F.col("a")) / (toxic + 1) / ((F.lit(other + 1) - F.col("b")) / (other + 1))
    )
    ranked = strong.where(strength > LEAST_STRENGTH).orderBy(strength.desc(), F.length("candidate").desc(), "candidate")
    chosen: list[str] = []
    for c in (r["candidate"] for r in ranked.collect()):
        stem = c.rstrip("*")
        if not any(stem.startswith(o.rstrip("*")) or o.startswith(stem) for o in chosen):
            chosen.append(c)
    return Voters.of(chosen)


# --- label model ----------------------------------------------------------------------------------------------------


class LabelModel(NamedTuple):
    """How often each voter fires in other (0) and toxic (1) documents, the share of toxic ones, and voters' groups."""

    rates: np.ndarray  # 2 x voters
    prior: float
    groups: np.ndarray  # group number of each voter
    shift: float = 0.0  # added to every logit, so that beliefs are toxic as often as labels

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        """Probability of toxicity for rows of 0/1 votes; what does not fire says nothing, a group speaks with its mean."""
        weight = np.log(self.rates[1]) - np.log(self.rates[0])
        logit = np.full(len(fired), math.log(self.prior / (1 - self.prior)) + self.shift)
        for g in np.unique(self.groups):
            own = fired[:, self.groups == g]
            n = own.sum(axis=1)
            logit += (own @ weight[self.groups == g]) / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _patterns(votes: DataFrame) -> DataFrame:
    """Distinct vote patterns with their number, by label (null: none)."""
    return materialize(votes.groupBy("fired", "toxic").agg(F.count(F.lit(1)).alias("n")))


def _moments(patterns: DataFrame, voters: int, model: LabelModel | None, *, pairs: bool) -> list[np.ndarray]:
    """Expected sums over all documents, by class: documents, those by votes alone, voters firing and, with
    ``pairs``, pairs firing."""
    width = 2 + voters + (voters * voters if pairs else 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, width))
        for rows in batches:
            for a in range(0, len(rows), 4096):
                part = rows.iloc[a : a + 4096]
                fired = np.unpackbits(np.stack([np.frombuffer(x, np.uint8) for x in part["fired"]]), axis=1)[:, :voters].astype(float)
                known = part["toxic"].to_numpy(dtype=float, na_value=np.nan)
                guess = model.posterior(fired) if model else np.zeros(len(part))
                chance = np.where(np.isnan(known), guess, known)
                sure = np.where(np.isnan(known) & (model is None), 0.0, part["n"].to_numpy(dtype=float))
                for c, share in ((0, (1 - chance) * sure), (1, chance * sure)):
                    total[c, 0] += share.sum()
                    total[c, 1] += ((guess if c else 1 - guess) * sure).sum()
                    total[c, 2 : 2 + voters] += share @ fired
                    if pairs:
                        total[c, 2 + voters :] += (fired.T @ (fired * share[:, None])).ravel()
        flat = total.ravel()
        at = range(0, len(flat), SLICE)
        yield pd.DataFrame({"at": list(at), "sums": [flat[a : a + SLICE].tobytes() for a in at]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": rows["at"].iloc[:1], "sums": [np.sum([np.frombuffer(x) for x in rows["sums"]], axis=0).tobytes()]})

    parts = patterns.select("fired", "toxic", "n").mapInPandas(run, "at long, sums binary")
    summed = parts.groupBy("at").applyInPandas(add, "at long, sums binary")
    # Eight bytes for each pair of voters and class come to the driver, as they are.
    flat = np.zeros(2 * width)
    for r in summed.collect():
        own = np.frombuffer(r["sums"])
        flat[r["at"] : r["at"] + len(own)] = own
    return list(flat.reshape(2, width))


def _rates(sums: list[np.ndarray], voters: int) -> tuple[np.ndarray, float]:
    docs = np.array([s[0] for s in sums])
    fires = np.stack([s[2 : 2 + voters] for s in sums])
    rates = (fires + 0.5 * (fires.sum(axis=0) + 1) / (docs.sum() + 2)) / (docs[:, None] + 0.5)
    return np.clip(rates, 1e-6, 1 - 1e-6), float(np.clip(docs[1] / max(docs.sum(), 1), 1e-3, 0.5))


def fit_label_model(votes: DataFrame, voters: int, rounds: int = ROUNDS) -> LabelModel:
    """Fit to ``votes`` (fired, toxic) of all documents; labelled ones begin, the others join with their posteriors."""
    patterns = _patterns(votes)
    alone = np.arange(voters)
    start = _moments(patterns, voters, None, pairs=False)
    if start[1][0] == 0:  # no label at all: lists are trusted alike
        rates = np.vstack([np.full(voters, 0.02), np.full(voters, 0.2)])
        rates[:, -1] = 0.9, 0.3
        model = LabelModel(rates, 0.1, alone)
    else:
        model = LabelModel(*_rates(start, voters), alone)
    labelled_prior = model.prior if start[1][0] else None
    for step in range(rounds):
        pairs = step == rounds // 2
        sums = _moments(patterns, voters, model, pairs=pairs)
        rates, prior = _rates(sums, voters)
        groups, shift = _groups(sums, voters) if pairs else model.groups, model.shift
        if labelled_prior:
            found = float(np.clip(sums[1][1] / (sums[0][1] + sums[1][1]), 1e-4, 1 - 1e-4))
            shift += math.log(labelled_prior / (1 - labelled_prior)) - math.log(found / (1 - found))
            prior = labelled_prior
        moved = max(np.abs(np.log(rates) - np.log(model.rates)).max(), abs(prior - model.prior))
        model = LabelModel(rates, prior, groups, shift)
        if step > rounds // 2 and moved < 0.02:
            break
    return model


def _groups(sums: list[np.ndarray], voters: int) -> np.ndarray:
    """Voters joined by a correlation above ``CORRELATED`` within either class share a number."""
    group = np.arange(voters)
    for s in sums:
        n = max(s[0], 1)
        mean, both = s[2 : 2 + voters] / n, s[2 + voters :].reshape(voters, voters) / n
        spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
        together = (both - np.outer(mean, mean)) / np.outer(spread, spread)
        often = np.minimum.outer(s[2 : 2 + voters], s[2 : 2 + voters]) >= 20
        for i, j in np.argwhere(np.triu((together > CORRELATED) & often, 1)):
            group[group == group[j]] = group[i]
    return group


# --- classifier -----------------------------------------------------------------------------------------------------


class ToxicityModel(NamedTuple):
    voters: Voters
    label_model: LabelModel
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str], memory: _Words) -> np.ndarray:
        x = np.stack([vector(*read_text(t, memory)) for t in texts])
        return 1 / (1 + np.exp(-np.clip(x.astype(np.float64) @ self.weights + self.bias, -30, 30)))


def cast_votes(docs: DataFrame, voters: Voters) -> DataFrame:
    """doc_id and the bits of the voters that fire."""
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    @F.pandas_udf("binary")
    def vote(texts: pd.Series) -> pd.Series:
        memory = _Words(shared.value)
        found = pd.Series([np.packbits(read_text(t or "", memory)[0] > 0).tobytes() for t in texts])
        del memory
        give_back()
        return found

    return docs.select("doc_id", vote("text").alias("fired"))


def train(docs: DataFrame, labels: DataFrame, most: int = CLASSIFIER_SAMPLE) -> ToxicityModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0 or 1; other values and rows without doc_id say nothing).

    Held-out documents teach nothing, neither by label nor by vote. A document labelled both ways counts as toxic.
    """
    own = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    voters = find_voters(own, known)
    votes = materialize(cast_votes(own, voters))
    labelled = votes.join(known, "doc_id", "left")
    label_model = fit_label_model(labelled.select("fired", "toxic"), voters.number)

    shared = docs.sparkSession.sparkContext.broadcast((voters, label_model))

    @F.pandas_udf("double")
    def believe(fired: pd.Series) -> pd.Series:
        voters, model = shared.value
        bits = np.unpackbits(np.stack([np.frombuffer(x, np.uint8) for x in fired]), axis=1)[:, : voters.number]
        return pd.Series(model.posterior(bits.astype(float)))

    # The votes alone decide: a given label has had its say in the rates of the voters.
    believed = materialize(votes.select("doc_id", believe("fired").alias("chance")).where("doc_id is not null"))
    believed = believed.withColumn("side", F.col("chance") >= 0.5)
    sizes = {r["side"]: r["n"] for r in believed.groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = bounded_sample(believed, "side", most).dropDuplicates(["doc_id"])

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memory = _Words(shared.value[0])
            for part in slices(batch):
                found = [vector(*read_text(t, memory)) for t in texts_of(part)]
                at = [np.flatnonzero(x) for x in found]
                columns = [part.column("side"), part.column("chance"), pa.array(at, pa.list_(pa.int32()))]
                columns.append(pa.array([x[i].astype(float) for x, i in zip(found, at, strict=True)], pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays(columns, ["side", "chance", "indices", "shares"])

    rows = own.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(*[F.first(c).alias(c) for c in ("text", "side", "chance")])
    sample = materialize(rows.mapInArrow(run, "side boolean, chance double, indices array<int>, shares array<double>"))
    width = voters.number + 3 + BUCKETS
    if not sizes.get(True) or not sizes.get(False):  # one class only: nothing to tell apart
        bias = math.log(label_model.prior / (1 - label_model.prior)) if sizes else -5.0
        return ToxicityModel(voters, label_model, np.zeros(width), min(bias, -1.0))
    # Each document stands for its share of its side, and for either class by its posterior.
    share = {side: max(1.0, n / most) for side, n in sizes.items()}
    weight = F.when(F.col("side"), share[True]).otherwise(share[False])
    points = sample.withColumn("features", sparse(width, F.col("indices"), F.col("shares"))).withColumn("share", weight)
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("chance").alias("p")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("chance")).alias("p"))))
    points = points.select("features", "share", both.alias("of")).where("of.p > 0.001")
    points = points.select("features", F.col("of.label").alias("label"), (F.col("share") * F.col("of.p")).alias("weight")).persist()
    try:
        learner = LogisticRegression(maxIter=30, regParam=3e-4, standardization=False, weightCol="weight")
        fitted = learner.fit(points)
    finally:
        points.unpersist()
    return ToxicityModel(voters, label_model, fitted.coefficients.toArray(), fitted.intercept)


def score_toxicity(docs: DataFrame, model: ToxicityModel, score: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole text; null and empty texts are scored as texts without words.

    A column of that name is replaced, all others are kept; every row is scored by its text alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def look(texts: pd.Series) -> pd.Series:
        memory = _Words(shared.value.voters)
        parts = [texts.iloc[a : a + 256] for a in range(0, len(texts), 256)]
        found = [shared.value.scores([t or "" for t in p], memory) for p in parts]
        del memory
        give_back()
        return pd.Series(np.concatenate(found) if found else [], dtype=float)

    found = fresh(docs, "found")
    out = docs.withColumn(found, look.asNondeterministic()("text"))
    kept = [f"`{c}`" for c in docs.columns if c.lower() != score.lower()]
    return out.select(*kept, F.col(found).alias(score))


def accepted(docs: DataFrame, model: ToxicityModel, below: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``below``, with the columns they came with."""
    score = fresh(docs, "toxicity")
    return score_toxicity(docs, model, score).where(F.col(score) < below).drop(score)
