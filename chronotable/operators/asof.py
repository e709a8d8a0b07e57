"""Facts with the version of their key that was valid at their time: an interval join without comparing all pairs.

Keys with few versions are joined by key alone, each fact and each version shuffled once: a fact is tested against at most ``beside`` versions.

Only keys with more versions go through buckets of time. Every version is put into buckets of one width, by its own length: in two of them at
most, or nine if it is shorter than eight seconds. Every fact looks into the one bucket of each width that versions have, at most some twenty, as a
number and a time without its other columns. So the join is on equal key, width and bucket, which Spark shuffles and, for a hot key, splits by time
and by size; an exact test follows. A version that touches a bucket fills an eighth of it or more, so few pairs fail the test.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotable.functions.columns import col, pick, quoted, require_columns
from chronotable.operators.columns import VALID_FROM, VALID_TO
from chronotable.operators.ranges import whole_seconds
from chronotable.sources.workspace import materialize

_LEVEL, _BUCKET, _FACT, _CROWDED = "__level", "__bucket", "__fact", "__crowded"
_STEP = 3  # widths grow by factors of eight
# Versions of a key that each of its facts is tested against; with more the key goes through buckets.
BESIDE = 64


def _equal_as_they_are(one: T.DataType, other: T.DataType) -> bool:
    """Whether values are equal across both types only if they are within each; a text and a number are not: '1' and '01' are both 1."""
    return one == other or (isinstance(one, T.IntegralType) and isinstance(other, T.IntegralType))


def _span_buckets(held: DataFrame, valid_from: str, valid_to: str, clock: T.DataType) -> DataFrame:
    """Versions once for each of their buckets."""
    # The millisecond after the end may lie in the next second.
    spans = held.withColumns({"__low": whole_seconds(col(valid_from).cast(clock), clock), "__high": whole_seconds(col(valid_to).cast(clock), clock) + 1})
    size = F.ceil(F.log2((F.col("__high") - F.col("__low") + 1).cast("double")) / _STEP).cast("int")
    # Many short versions may begin within one second, so theirs are the narrowest buckets.
    spans = spans.withColumn(_LEVEL, F.when(size > 1, size * _STEP).otherwise(0))
    shifted = "shiftright({}, " + _LEVEL + ")"
    buckets = F.expr(f"sequence({shifted.format('__low')}, {shifted.format('__high')})")
    return spans.withColumn(_BUCKET, F.explode(buckets)).drop("__low", "__high")


def _crowded_keys(held: DataFrame, names: Sequence[str], beside: int) -> DataFrame:
    """Keys with more than ``beside`` versions, written so that Spark knows how few they are."""
    keys = [col(n).alias(f"__crowded_{i}") for i, n in enumerate(names)]
    counted = held.groupBy(*keys).agg(F.count(F.lit(1)).alias("__versions"))
    return materialize(counted.where(F.col("__versions") > beside).drop("__versions"))


def _numbered(facts: DataFrame) -> DataFrame:
    """Facts written with their numbers: files may be split in another way each time they are read."""
    return materialize(facts.withColumn(_FACT, F.monotonically_increasing_id()))


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str | tuple[str, str]],
    at: str,
    prefix: str = "version_",
    how: str = "left",
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    beside: int = BESIDE,
) -> DataFrame:
    """Facts beside the version of their key with ``valid_from`` <= ``at`` < the millisecond after ``valid_to``.

    ``keys`` are names, or pairs of a fact's and a version's name. Version columns come with a prefix. A fact without a version is kept with nulls, unless ``how`` is ``inner``; so is one with a
    null key or time. Versions with a null bound, or that end before they begin, hold nothing. Overlapping versions give a row each.
    Keys with more than ``beside`` versions are joined by buckets of time, all others by key alone; the number does not show in the result.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in keys]
    require_columns(facts, [at, *[f for f, _ in pairs]], "fact columns")
    require_columns(versions, [valid_from, valid_to, *[v for _, v in pairs]], "version columns")
    clash = [n for n in facts.columns if n.startswith(prefix)]
    if clash:
        raise ValueError(f"fact columns begin with {prefix}: {clash}")
    types = [versions.schema[valid_from].dataType, versions.schema[valid_to].dataType, facts.schema[at].dataType]
    zoned = any(isinstance(t, T.TimestampType) for t in types)
    clock = T.TimestampType() if zoned else T.TimestampNTZType()
    kept = [*facts.columns, *[prefix + n for n in versions.columns]]
    same = reduce(and_, [col(f) == col(prefix + v) for f, v in pairs])
    moment, after = col(at).cast(clock), col(prefix + valid_to).cast(clock) + F.expr("INTERVAL '0.001' SECOND")
    valid = (moment >= col(prefix + valid_from).cast(clock)) & (moment < after)
    held = versions.where(reduce(and_, [col(v).isNotNull() for _, v in pairs], col(valid_from) <= col(valid_to)))

    def named(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(*[col(n).alias(prefix + n) for n in versions.columns], *more)

    def beside_each_other(some: DataFrame, rows: DataFrame) -> DataFrame:
        return pick(some.join(named(rows), same & valid, how), kept)

    def by_buckets(numbered: DataFrame, rows: DataFrame) -> DataFrame:
        spans = _span_buckets(rows, valid_from, valid_to, clock)
        levels = sorted(row[0] for row in spans.select(_LEVEL).distinct().collect())  # at most 22 numbers
        seen = pick(numbered.where(col(at).isNotNull()), list(dict.fromkeys([*[f for f, _ in pairs], at, _FACT])))
        seen = seen.withColumn(_LEVEL, F.explode(F.lit(levels).cast("array<int>"))).withColumn("__at", whole_seconds(moment, clock))
        seen = seen.withColumn(_BUCKET, F.expr(f"shiftright(__at, {_LEVEL})")).drop("__at")
        within = [F.col(f"f.{n}") == F.col(f"v.{n}") for n in (_LEVEL, _BUCKET)]
        met = seen.alias("f").join(named(spans, _LEVEL, _BUCKET).alias("v"), reduce(and_, within, same)).where(valid)
        met = met.select(F.col(f"f.{_FACT}").alias("__met"), *[quoted(prefix + n) for n in versions.columns])
        return pick(numbered.join(met, F.col(_FACT) == F.col("__met"), how), kept)

    alike = all(_equal_as_they_are(facts.schema[f].dataType, versions.schema[v].dataType) for f, v in pairs)
    if not alike:
        return by_buckets(_numbered(facts), held)
    crowded = _crowded_keys(held, [v for _, v in pairs], beside)
    if crowded.isEmpty():
        return beside_each_other(facts, held)

    def marked(rows: DataFrame, names: Sequence[str]) -> DataFrame:
        hit = reduce(and_, [col(n) == F.col(f"__crowded_{i}") for i, n in enumerate(names)])
        return rows.join(crowded, hit, "left").withColumn(_CROWDED, F.col("__crowded_0").isNotNull())

    # Both are written, so that the joins after it come straight out of a shuffle and hot keys can be split.
    numbered = _numbered(marked(facts, [f for f, _ in pairs]))
    theirs = materialize(marked(held, [v for _, v in pairs]))
    few = beside_each_other(numbered.where(~F.col(_CROWDED)), theirs.where(~F.col(_CROWDED)))
    return few.unionByName(by_buckets(numbered.where(_CROWDED), theirs.where(_CROWDED)))
