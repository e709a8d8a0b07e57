"""Versions of keys from points in time: where a value begins, where it ends, and which repeats say nothing new.

``cut_versions`` is one pass over each key (gaps and islands). A key with more than ``hot_rows`` points is not sorted in one
task: its points are dealt out to blocks of time by approximate quantiles, each block is cut on its own, and
what crosses from block to block is settled on one summary row per block (its first and last fingerprint and
where its first change is).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotable.functions.columns import col, pick
from chronotable.functions.timestamps import one_milli_before, open_end
from chronotable.operators.columns import ROW_KEY, ROW_MD5, VALID_FROM, VALID_TO
from chronotable.operators.dedup import HOT_ROWS, frequent_keys

STARTS = "__starts"
_NEXT, _BLOCK, _BEFORE = "__next", "__block", "__before"
_MOST_BLOCKS = 200
_NO_MOMENT = "a point needs a valid_from"


def point_key() -> Column:
    """One text for a key and a moment; a null moment fails the query."""
    moment = F.coalesce(col(VALID_FROM).cast("string"), F.raise_error(_NO_MOMENT).cast("string"))
    return F.concat(col(ROW_KEY), F.lit(" "), moment)


def assert_moments(points: DataFrame) -> None:
    """Fail if a point has no moment, in a job of its own that reads one column.

    Where several stages meet the null at once, Spark reports how many failed, as an error of another kind.
    """
    points.agg(F.count(F.when(col(VALID_FROM).isNull(), F.raise_error(_NO_MOMENT)))).collect()


def _print() -> Column:
    return F.lower(col(ROW_MD5))


def _cut(points: DataFrame, by: Sequence[Column], before: Column | None = None, after: Column | None = None) -> DataFrame:
    """Points with ``STARTS`` and the begin of the next version, within groups; ``before`` and ``after`` are what lies around a group."""
    ordered = Window.partitionBy(*by).orderBy(VALID_FROM)
    earlier = F.lag(_print()).over(ordered)
    if before is not None:
        earlier = F.coalesce(earlier, before)
    started = points.withColumn(STARTS, ~_print().eqNullSafe(earlier) | earlier.isNull())
    begin = F.when(F.col(STARTS), col(VALID_FROM))
    following = F.first(begin, ignorenulls=True).over(ordered.rowsBetween(1, Window.unboundedFollowing))
    return started.withColumn(_NEXT, following if after is None else F.coalesce(following, after))


def _blocked(points: DataFrame, hot: DataFrame, blocks: int) -> DataFrame:
    """Points of hot keys with a block that grows with time."""
    shares = [i / blocks for i in range(1, blocks)]
    timed = points.join(hot, ROW_KEY, "left_semi")
    # Sketches of quantiles are merged on the map side; there are fewer than 10,000 hot keys.
    cuts = timed.groupBy(col(ROW_KEY).alias("__hot")).agg(F.percentile_approx(VALID_FROM, shares, 10_000).alias("__cuts"))
    placed = timed.join(F.broadcast(cuts), col(ROW_KEY) == F.col("__hot"))
    block = F.size(F.filter("__cuts", lambda cut: cut < F.col(VALID_FROM)))
    return placed.withColumn(_BLOCK, block).drop("__hot", "__cuts")


def _cut_hot(points: DataFrame, hot: DataFrame, blocks: int) -> DataFrame:
    placed = _blocked(points, hot, blocks)
    by = [col(ROW_KEY), F.col(_BLOCK)]
    # The exchange by both keeps Spark from using one by the key alone.
    placed = placed.repartition(*by)
    inside = Window.partitionBy(*by).orderBy(VALID_FROM)
    changed = F.when(~_print().eqNullSafe(F.lag(_print()).over(inside)) & (F.row_number().over(inside) > 1), col(VALID_FROM))
    facts = placed.select(*by, VALID_FROM, _print().alias("__print"), changed.alias("__changed")).groupBy(*by).agg(
        F.min_by("__print", VALID_FROM).alias("__first"),
        F.min(VALID_FROM).alias("__from"),
        F.max_by("__print", VALID_FROM).alias("__last"),
        F.min("__changed").alias("__change"),
    )
    # At most `blocks` rows of each of the hot keys.
    along = Window.partitionBy(ROW_KEY).orderBy(_BLOCK)
    before = F.lag("__last").over(along)
    begins = F.when(before.isNull() | ~F.col("__first").eqNullSafe(before), F.col("__from")).otherwise(F.col("__change"))
    known = facts.withColumn(_BEFORE, before).withColumn("__begins", begins)
    after = F.first("__begins", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing))
    around = known.select(col(ROW_KEY).alias("__k"), F.col(_BLOCK).alias("__b"), _BEFORE, after.alias("__after"))
    joined = placed.join(around, (col(ROW_KEY) == F.col("__k")) & (F.col(_BLOCK) == F.col("__b")))
    return _cut(joined, by, F.col(_BEFORE), F.col("__after"))


def cut_versions(points: DataFrame, hot_rows: int = HOT_ROWS, blocks: int | None = None) -> DataFrame:
    """Points, at most one of a key and moment, with ``STARTS`` and the ``valid_to`` that follows.

    A point starts a version unless the one before it has the same fingerprint. A version ends one millisecond before the next one
    begins, and never before its own begin; the last one of a key is open. Neither ``hot_rows`` nor
    ``blocks`` (by default one for each shuffle partition) shows in the result.
    """
    blocks = min(blocks or int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), _MOST_BLOCKS)
    hot = frequent_keys(points, ROW_KEY, hot_rows)
    cold = _cut(points.join(hot, ROW_KEY, "left_anti"), [col(ROW_KEY)])
    names = [*points.columns, STARTS, _NEXT]
    cut = pick(cold, names).unionByName(pick(_cut_hot(points, hot, max(blocks, 2)), names))
    bound = points.schema[VALID_TO].dataType
    ended = one_milli_before(F.col(_NEXT), points.schema[VALID_FROM].dataType).cast(bound)
    end = F.when(F.col(_NEXT).isNull(), open_end(bound).cast(bound)).otherwise(F.greatest(ended, col(VALID_FROM).cast(bound)))
    return pick(cut.withColumn(VALID_TO, end), [*points.columns, STARTS])
