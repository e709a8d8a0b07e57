"""Toxicity by non-negative positive-unlabelled learning.

Only documents confirmed toxic are examples; everything else is unlabelled text, toxic and clean mixed. With
the share ``prior`` of toxic documents, the risk of a linear classifier f under the logistic loss l is

    prior * E_P[l(f)]  +  max(0,  E_U[l(-f)] - prior * E_P[l(-f)])

where the second part estimates the risk on clean documents without having any; where its estimate turns
negative the classifier has begun to memorise, and the part is held at nothing (the non-negative correction).

A document's features are its distinct lower-cased words and their beginnings, hashed; the whole text counts.
Several classifiers are trained with numpy in Spark tasks, each without another part of the sample, and averaged.

Sampling: ``most_positive`` and ``most_unlabelled`` bound the documents that are fitted on, taken in the order
of a hash of the id. The prior is the toxic share of all labelled training rows. Training rows are those whose
``crc32(doc_id) mod 5`` is not 0.

Nulls: a null text scores as the empty one, from the intercept alone. A null ``doc_id`` is never held out nor
sampled, and is scored. Null labels are no labels; a document is confirmed if any of its label rows says so. Repeated rows
are each scored. With no confirmed example every score is the prior, 0 if nothing is labelled. Other columns
are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, first_by_hash, texts
from chronotable.sources.workspace import materialize

_WORD = re.compile(r"[^\W\d_]+")
_BITS = 18
_BEGINNING = 4
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
_PARTS = 4


def _places(text: str) -> set[tuple[str, bool]]:
    words = set(_WORD.findall(text.lower()))
    return {(w, True) for w in words} | {(w[:_BEGINNING], False) for w in words}


def _hashed(word: str, whole: bool) -> int:
    return zlib.crc32(f"{'w' if whole else 'b'}{word}".encode("utf-8", "replace")) >> (32 - _BITS)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int32()), ("positive", pa.bool_()), ("features", pa.list_(pa.int32()))])
    for batch in batches:
        found = [sorted({_hashed(*p) for p in _places(t.as_py() or "")}) for t in batch.column(2)]
        yield batch_of(schema, (batch.column(0), batch.column(1), found))


class Examples:
    """Sparse rows of ones."""

    def __init__(self, rows: list[np.ndarray]):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        self.columns = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)

    def some(self, rows: np.ndarray) -> Examples:
        return Examples([self.columns[self.ends[r] : self.ends[r + 1]] for r in rows])

    def output(self, weights: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        return np.bincount(owner, weights[self.columns], len(self.sizes))

    def gradient(self, slope: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, np.repeat(slope, self.sizes), width)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, width: int, epochs: int = 60, batches: int = 10, rate: float = 0.02, decay: float = 1e-6, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative risk, by Adam over mixed batches."""
    random = np.random.default_rng(seed)
    p, u = Examples(positive), Examples(unlabelled)
    weights = np.zeros(width + 1)
    weights[-1] = np.log(prior / (1 - prior))
    mean, square, step = np.zeros(width + 1), np.zeros(width + 1), 0
    for _ in range(epochs):
        p_parts = np.array_split(random.permutation(len(positive)), batches)
        u_parts = np.array_split(random.permutation(len(unlabelled)), batches)
        for p_rows, u_rows in zip(p_parts, u_parts, strict=True):
            if not len(p_rows) or not len(u_rows):
                continue
            p_some, u_some = p.some(p_rows), u.some(u_rows)
            p_out = p_some.output(weights[:-1]) + weights[-1]
            u_out = u_some.output(weights[:-1]) + weights[-1]
            clean_risk = np.logaddexp(0, u_out).mean() - prior * np.logaddexp(0, p_out).mean()
            # Slopes of the mean losses by output: l(f) on P, l(-f) on U and on P.
            on_p, away_u, away_p = (_sigmoid(p_out) - 1) / len(p_rows), _sigmoid(u_out) / len(u_rows), _sigmoid(p_out) / len(p_rows)
            counts = 1.0 if clean_risk >= 0 else 0.0
            p_slope = prior * on_p - counts * prior * away_p
            u_slope = counts * away_u
            gradient = np.empty(width + 1)
            gradient[:-1] = p_some.gradient(p_slope, width) + u_some.gradient(u_slope, width) + decay * weights[:-1]
            gradient[-1] = p_slope.sum() + u_slope.sum()
            step += 1
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient**2 - square)
            weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def _trainer(prior: float, least: float) -> Callable:
    """Fits one classifier on all parts of the sample but one, on features that mark confirmed examples.

    A feature is used if it is so much more frequent in them than in unlabelled text that chance does not explain it
    (``least`` standard errors). Others would only add noise that grows with the length of a text.
    """

    def train(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        rows = [np.asarray(x, np.int64) for x in sample["features"]]
        marks = sample["positive"].to_numpy(bool)
        in_p, in_u = (
            np.bincount(np.concatenate([np.empty(0, np.int64), *[r for r, m in zip(rows, marks, strict=True) if m == side]]), minlength=1 << _BITS)
            for side in (True, False)
        )
        n_p, n_u = max(marks.sum(), 1), max((~marks).sum(), 1)
        share = np.maximum(in_p + in_u, 1) / (n_p + n_u)
        errors = (in_p / n_p - in_u / n_u) / np.sqrt(share * (1 / n_p + 1 / n_u))
        used = np.flatnonzero((errors >= least) & (in_p >= 3))
        dense = np.full(1 << _BITS, -1)
        dense[used] = np.arange(len(used))
        rows = [(d := dense[r])[d >= 0] for r in rows]
        positive = [r for r, m in zip(rows, marks, strict=True) if m]
        unlabelled = [r for r, m in zip(rows, marks, strict=True) if not m]
        if not positive or not unlabelled:
            return pd.DataFrame({"feature": [-1], "weight": [float(np.log(prior / (1 - prior)))]})
        weights, intercept = fit(positive, unlabelled, prior, len(used), seed=int(key[0]))
        return pd.DataFrame({"feature": [-1, *used], "weight": [intercept, *weights]})

    return train


def train_toxicity(documents: DataFrame, labels: DataFrame, most_positive: int = 6_000, most_unlabelled: int = 18_000, least: float = 6.0, raised: float = 1.1) -> tuple[np.ndarray, float]:
    """Weights of all hashed features and the intercept, at most ``2 ** 18`` numbers.

    The prior is ``raised`` by a tenth: too low a prior makes the risk take the rest of the toxic texts among
    the unlabelled for clean ones, which costs more recall than the same error upwards costs precision.
    """
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic")).where(~held_out & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known)
    counted = known.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("toxic")).first()
    if not counted.n or not counted.toxic:
        return np.zeros(1 << _BITS), -40.0
    prior = min(max(raised * counted.toxic / counted.n, 1e-4), 0.9)
    # Only ids are ordered and bounded; texts are fetched for the chosen few.
    chosen = first_by_hash(known.where("toxic = 1").select("doc_id"), most_positive).withColumn("positive", F.lit(True))
    ids = documents.select(F.col("doc_id").cast("long")).where(~held_out).distinct()
    other = first_by_hash(ids, most_unlabelled).withColumn("positive", F.lit(False))
    sample = F.broadcast(materialize(chosen.unionByName(other)))  # at most most_positive + most_unlabelled ids
    rows = texts(documents).withColumn("doc_id", F.col("doc_id").cast("long")).join(sample, "doc_id")
    part = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(_PARTS)).cast("int")
    found = rows.select(part.alias("part"), "positive", "text").mapInArrow(_features, "part int, positive boolean, features array<int>")
    sparse = materialize(found.groupBy("positive", "features").agg(F.min("part").alias("part")))  # copies count once
    members = sparse.withColumn("member", F.explode(F.array(*[F.lit(k) for k in range(_PARTS)]))).where("member <> part")
    weights = members.groupBy("member").applyInPandas(_trainer(prior, least), "feature int, weight double")
    # Each member hands out one intercept, as feature -1; a sample may be too small to fit them all.
    summed = weights.groupBy("feature").agg(F.sum("weight").alias("weight"), F.count("*").alias("members")).toArrow()
    features, sums, members = (summed.column(i).to_numpy() for i in range(3))
    inside = features >= 0
    fitted = int(members[~inside].sum())
    if not fitted:
        return np.zeros(1 << _BITS), float(np.log(prior / (1 - prior)))
    vector = np.zeros(1 << _BITS)
    vector[features[inside]] = sums[inside] / fitted
    return vector, float(sums[~inside].sum() / fitted)


class Scorer:
    """Score of a text; ``limit`` bounds the remembered words."""

    def __init__(self, weights: np.ndarray, intercept: float, limit: int = 300_000):
        self.weights, self.intercept, self.limit = weights, intercept, limit
        self.known: dict[tuple[str, bool], int] = {}

    def score(self, text: str) -> float:
        if len(self.known) > self.limit:
            self.known.clear()
        features = set()
        for place in _places(text):
            feature = self.known.get(place)
            if feature is None:
                feature = self.known[place] = _hashed(*place)
            features.add(feature)
        total = self.weights[list(features)].sum() if features else 0.0
        return float(_sigmoid(np.float64(total + self.intercept)))


def _scoring(weights: np.ndarray, intercept: float) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights, intercept)
        for batch in batches:
            scores = [scorer.score(t.as_py() or "") for t in batch.column(2)]
            yield batch_of(_SCHEMA, (batch.column(0), batch.column(1), scores, [int(s >= 0.5) for s in scores]))

    return score


def score_toxicity(documents: DataFrame, weights: np.ndarray, intercept: float) -> DataFrame:
    """``score`` and ``predicted`` of every whole text."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    rows = texts(documents).select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(_scoring(weights.astype(np.float32), intercept), "doc_id long, held_out boolean, score double, predicted int")
