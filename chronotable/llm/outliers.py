"""Quality rules by robust multivariate outliers.

Counts of every whole text become a vector of transformed statistics. For each language and source the minimum
covariance determinant estimate is approached by concentration steps that Spark carries out as grouped sums:
keep the half of a group's rows that lies nearest, take its mean and covariance (raised by the consistency factor of the half), and measure again, until
no determinant falls any more. There are three starts, all around the medians: with no correlations, with those of squashed values
and with those of directions; of their ends each group keeps the one of the least determinant. One reweighted estimate follows. A row is rejected if its squared Mahalanobis
distance passes the cut. A step moves one row of sums per group and task, so a group may hold any share of all rows.

A half without any symbol or repeated line has no variance, and a single symbol would be infinitely far. So the
chance variance of counts in texts as long as those of the half is added, which is small where texts are long, and
``RIDGE``, which keeps the inverse sound. Groups of fewer than ``least`` rows are pooled with the
other small ones of their language, and those pools with one another; a last pool below ``least`` rows is kept.

Nulls: a null text has no words and fails the base rule. Null languages and sources are groups like others.
Repeated rows count as often as they occur, each with its own verdict; a null ``doc_id`` stays. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of
from chronotable.sources.workspace import materialize

_WHITE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?;:\"'()[]{}=+~^_@\\/`"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_WHITE_TEXT = _WHITE.decode()
_WINDOW = 8

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_upper")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), *((c, pa.int64()) for c in _COUNTS)])

# Chance variance of each of `statistics`: which of `chances`, and how many are counted at once (a window and its repetition).
_CHANCE = (("e_words", 1), ("e_words", 1), ("e_lines", 1), ("e_words", 2 * _WINDOW), ("e_words", 1), ("e_chars", 1))
_E = ["e_words", "e_lines", "e_chars"]
RIDGE = 0.03  # a standard deviation
_P = len(_CHANCE)
_Z = [f"z{i}" for i in range(_P)]
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight that occur twice or more."""
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    if len(number) == len(words):
        return 0
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    key = np.zeros(n, np.uint64)
    for j in range(_WINDOW):
        key = key * np.uint64(0x100000001B3) + mixed[j : j + n]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    # Equal keys are compared word by word.
    windows = np.lib.stride_tricks.sliding_window_view(ids, _WINDOW)
    left, right = order[:-1][same], order[1:][same]
    equal = (windows[left] == windows[right]).all(axis=1)
    edges = np.zeros(len(words) + 1, np.int64)
    hit = np.unique(np.concatenate([left[equal], right[equal]]))
    edges[hit] += 1
    np.subtract.at(edges, hit + _WINDOW, 1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def count_text(text: str) -> tuple[int, ...]:
    data = text.encode("utf-8", "replace")
    words = data.split()

    def count(wanted: bytes) -> int:
        return len(data) - len(data.translate(None, wanted))

    lines = [line for line in text.split("\n") if line.strip(_WHITE_TEXT)]
    return (
        len(words),
        len(text) - count(_WHITE),
        count(_SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        count(_MARKS),
        count(_UPPER),
    )


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [count_text(t.as_py() or "") for t in batch.column(3)]
        yield batch_of(_SCHEMA, (*(batch.column(i) for i in range(3)), *(zip(*counts, strict=True) if counts else [()] * len(_COUNTS))))


def text_counts(documents: DataFrame) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string"))
    columns = ", ".join(f"{c} long" for c in _COUNTS)
    return rows.mapInArrow(_counting, f"doc_id long, lang string, source string, {columns}")


def statistics() -> list[Column]:
    """Transformed to be roughly even around their middle; small texts are drawn to it."""
    n, chars, symbols, dup, repeat, lines, marks, upper = (F.col(c) for c in _COUNTS)
    return [
        F.log((chars + 100) / (n + 20)),
        F.sqrt(symbols / (n + 20)),
        F.sqrt(dup / (lines + 5)),
        F.sqrt(repeat / (n + 20)),
        F.sqrt(marks / (n + 20)),
        F.sqrt(upper / (chars + 100)),
    ]


def chances() -> list[Column]:
    """Variances of the root of a share by chance alone: a quarter of one over the size, as for a Poisson count."""
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    return [0.25 / (n + 20), 0.25 / (lines + 5), 0.25 / (chars + 100)]


def _grouped(rows: DataFrame, least: int) -> DataFrame:
    """With ``g``: the group whose estimate holds for a row, null if there is none."""

    def sized(counts: DataFrame) -> DataFrame:
        return counts.groupBy("g").agg(F.sum("n").alias("n"))

    counts = materialize(rows.groupBy("lang", "source").agg(F.count("*").alias("n")))

    def key(*parts: str) -> Column:
        return F.to_json(F.array(*[F.col(p) if p in ("lang", "source") else F.lit(p) for p in parts]))

    own = counts.withColumn("g", F.when(F.col("n") >= least, key("lang", "source")).otherwise(key("lang")))
    pools = sized(own).select(F.col("g"), F.col("n").alias("pool"))
    pooled = own.join(pools, "g").withColumn("g", F.when(F.col("pool") >= least, F.col("g")).otherwise(F.lit("[]")))
    last = sized(pooled).select(F.col("g"), F.col("n").alias("last"))
    named = pooled.join(last, "g").select("lang", "source", F.when(F.col("last") >= least, F.col("g")).alias("g"))
    named = materialize(named).select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "g")
    match = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return rows.join(_small(named), match, "left").drop("_lang", "_source")


def _small(table: DataFrame, most: int = 20_000) -> DataFrame:
    """A hint to send the table to all tasks if it has at most ``most`` rows of some 300 bytes; otherwise Spark joins by key."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def _distance() -> Column:
    terms = [F.col(f"v{i}_{j}") * (F.col(f"z{i}") - F.col(f"m{i}")) * (F.col(f"z{j}") - F.col(f"m{j}")) * (1 if i == j else 2) for i, j in _PAIRS]
    return reduce(Column.__add__, terms)


_SCATTER = pa.schema([("g", pa.string()), *((f"m{i}", pa.float64()) for i in range(_P)), *((f"v{i}_{j}", pa.float64()) for i, j in _PAIRS), ("log_det", pa.float64())])
_PARAMETERS = "g string, " + ", ".join([*(f"m{i} double" for i in range(_P)), *(f"v{i}_{j} double" for i, j in _PAIRS)]) + ", log_det double"


def _estimating(factor: float) -> Callable:
    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Mean, inverse covariance and its determinant from the sums of each group; the scatter is raised by ``factor``."""
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                n = row["n"]
                mean = np.array([row[f"s{i}"] for i in range(_P)]) / n
                chance = np.array([times * row[e] for e, times in _CHANCE]) / n
                second = np.zeros((_P, _P))
                for i, j in _PAIRS:
                    second[i, j] = second[j, i] = row[f"s{i}_{j}"] / n
                out.append((row["g"], *_described(mean, factor * (second - np.outer(mean, mean)) + np.diag(chance + RIDGE**2))))
            yield batch_of(_SCATTER, list(zip(*out, strict=True)) or ([],) * len(_SCATTER))

    return estimate


def _described(mean: np.ndarray, covariance: np.ndarray) -> tuple[float, ...]:
    inverse = np.linalg.inv(covariance)
    return (*mean.tolist(), *(float(inverse[i, j]) for i, j in _PAIRS), float(np.linalg.slogdet(covariance)[1]))


def _from_sums(rows: DataFrame, factor: float) -> DataFrame:
    sums = rows.groupBy("g").agg(F.count("*").alias("n"), *[F.sum(e).alias(e) for e in _E], *[F.sum(z).alias(f"s{i}") for i, z in enumerate(_Z)], *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"s{i}_{j}") for i, j in _PAIRS])
    return materialize(sums.mapInArrow(_estimating(factor), _PARAMETERS))


def _beginning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A start's scatter: the correlations of transformed statistics between the median deviations."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            spread = np.sqrt([row[f"d{i}"] ** 2 + _CHANCE[i][1] * row[_CHANCE[i][0]] + RIDGE**2 for i in range(_P)])
            second = np.zeros((_P, _P))
            for i, j in _PAIRS:
                second[i, j] = second[j, i] = row[f"c{i}_{j}"] / row["n"]
            scale = np.sqrt(np.maximum(np.diag(second), 1e-12))
            # A tenth of the way to no correlation keeps the matrix well away from a singular one.
            correlation = 0.9 * second / np.outer(scale, scale)
            np.fill_diagonal(correlation, 1.0)
            out.append((row["g"], *_described(np.array([row[f"m{i}"] for i in range(_P)]), correlation * np.outer(spread, spread))))
        yield batch_of(_SCATTER, list(zip(*out, strict=True)) or ([],) * len(_SCATTER))


def _starts(rows: DataFrame) -> list[DataFrame]:
    """Three starts around the medians: without correlations, with those of squashed values, and with those of directions."""
    middle = materialize(rows.groupBy("g").agg(*[F.percentile_approx(z, 0.5, 1000).alias(f"m{i}") for i, z in enumerate(_Z)], *[F.avg(e).alias(e) for e in _E]))
    apart = rows.join(_small(middle.drop(*_E)), "g").groupBy("g").agg(*[F.percentile_approx(F.abs(F.col(z) - F.col(f"m{i}")), 0.5, 1000).alias(f"d{i}") for i, z in enumerate(_Z)])
    apart = apart.select("g", *[(1.4826 * F.col(f"d{i}")).alias(f"d{i}") for i in range(_P)])
    known = materialize(middle.join(apart, "g"))
    standard = rows.drop(*_E).join(_small(known.drop(*_E)), "g").select("g", *[((F.col(f"z{i}") - F.col(f"m{i}")) / (F.col(f"d{i}") + RIDGE)).alias(f"u{i}") for i in range(_P)])
    length = F.sqrt(reduce(Column.__add__, [F.col(f"u{i}") * F.col(f"u{i}") for i in range(_P)])) + 1e-9
    alone = [F.lit(1.0) if i == j else F.lit(0.0) for i, j in _PAIRS]
    squashed = [F.tanh(F.col(f"u{i}")) * F.tanh(F.col(f"u{j}")) for i, j in _PAIRS]
    directed = [F.col(f"u{i}") * F.col(f"u{j}") / (length * length) for i, j in _PAIRS]
    out = []
    for products in (alone, squashed, directed):
        sums = standard.groupBy("g").agg(F.count("*").alias("n"), *[F.sum(x).alias(f"c{i}_{j}") for x, (i, j) in zip(products, _PAIRS, strict=True)])
        out.append(materialize(sums.join(_small(known), "g").mapInArrow(_beginning, _PARAMETERS)))
    return out


def _nearest(rows: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """The given share of each group's rows that lie nearest, and the middle distance of all."""
    measured = rows.join(_small(estimates), "g").select("g", *_Z, *_E, _distance().alias("d"))
    quantile = F.percentile_approx("d", [share, 0.5], 1000)
    cuts = materialize(measured.groupBy("g").agg(quantile.alias("q")).select("g", F.col("q")[0].alias("near"), F.col("q")[1].alias("middle")))
    return measured.join(_small(cuts), "g")


def concentrate(rows: DataFrame, start: DataFrame, steps: int, share: float, enough: float = 1e-3) -> DataFrame:
    """Concentration steps from a start until no group's determinant falls by more than ``enough``, ``steps`` at most.

    A group keeps the estimate of its least determinant: of approximate quantiles a step may give a larger one.
    """
    estimates, best = start, None
    for _ in range(steps):
        near = _nearest(rows, estimates, share)
        estimates = _from_sums(near.where(F.col("d") <= F.col("near")), consistency(share))
        fallen = None
        if best is not None:
            was = best.select("g", F.col("log_det").alias("was"))
            fallen = estimates.join(_small(was), "g").agg(F.max(F.col("was") - F.col("log_det"))).first()[0]
        best = estimates if best is None else _least([best, estimates])
        if fallen is not None and fallen <= enough:
            break
    return best


def _least(candidates: list[DataFrame]) -> DataFrame:
    """Of several estimates of a group the one of the least determinant."""
    every = reduce(DataFrame.unionByName, candidates)
    whole = F.struct(*[F.col(n) for n in every.columns])
    return materialize(every.groupBy("g").agg(F.min_by(whole, "log_det").alias("e")).select("e.*"))


def fit_groups(rows: DataFrame, steps: int, share: float) -> DataFrame:
    """Minimum covariance determinant of each group: the best of several starts, then one step on all rows within the 97.5 % bound."""
    best = _least([concentrate(rows, start, steps, share) for start in _starts(rows)])
    near = _nearest(rows, best, share)
    within = F.greatest(F.col("near"), F.lit(_chi2(1.96)))
    return _from_sums(near.where(F.col("d") <= within), consistency(NormalDist().cdf(1.96)))


def _chi2(z: float, p: int = _P) -> float:
    """The quantile of the chi-squared distribution at a normal deviate, by the cube-root rule."""
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


def consistency(share: float, p: int = _P) -> float:
    """What the scatter of the nearest share of normal rows must be multiplied by to be that of all; for an even number of dimensions."""
    half = _chi2(NormalDist().inv_cdf(share), p) / 2
    terms = [half**k / math.factorial(k) for k in range((p + 2) // 2)]
    return share / (1 - math.exp(-half) * sum(terms))


def judge_quality(documents: DataFrame, least: int = 60, steps: int = 8, share: float = 0.5, deviate: float = 3.09) -> DataFrame:
    """Counts, the base rule and the verdict of every document.

    ``deviate`` sets the cut as a normal deviate: squared distances beyond that quantile of the chi-squared
    distribution are rejected; the default is its 99.9 % quantile.
    """
    counted = text_counts(documents).select("*", *[s.alias(z) for s, z in zip([*statistics(), *chances()], [*_Z, *_E], strict=True)])
    counted = materialize(counted)
    rows = materialize(_grouped(counted, least))
    estimates = fit_groups(rows.where("g IS NOT NULL").select("g", *_Z, *_E), steps, share)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    far = F.coalesce(_distance() > _chi2(deviate), F.lit(False))
    judged = rows.join(_small(estimates), "g", "left")
    return judged.select(
        "doc_id",
        *_COUNTS[:5],
        failed.alias("base_failed"),
        (~failed & ~far).alias("kept"),
        _distance().alias("distance"),
        "lang",
        "source",
    )
