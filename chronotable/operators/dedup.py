"""In-batch de-duplication: one row per key is kept, every other one is set aside.

Both halves must stand a key that holds a large part of the batch:

* The kept half is ``row_number() = 1``. Spark turns that filter into a group limit that runs
  before the shuffle, so each map task sends at most one row per key.
* The other half cannot be limited. Keys with more than ``hot_rows`` rows, and more than a ten-thousandth of
  the batch, are counted out first (usually there are none, and adaptive execution then drops their branch).
  There can be ten thousand such keys at most, whatever the size of the batch, so they are broadcast. Their rows are
  ranked in two steps: per (key, salt), where the salt is the input partition a row was read from,
  and once more among the first rows of each salt. No task sees more of such a key than a salt's
  share. The salt does not depend on row content, so exact copies spread as well, and it is the
  same when a lost task runs again.

The order is total (the chosen columns, then all the others), so rows that tie are exact copies
and the two halves always add up to the batch, even when they run as separate jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotable.functions.columns import col, pick, quoted, require_columns
from chronotable.operators.columns import ROW_KEY, STATUS
from chronotable.operators.rejects import reject_rows
from chronotable.operators.status import Status, status_lit

_SALT = "__salt"
_RANK = "__rank"

# Rows of one key that a task sorts without being held up by them, unless a dimension says otherwise.
HOT_ROWS = 100_000
_MOST_HOT_KEYS = 10_000


def _has_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType):
        return True
    if isinstance(data_type, T.ArrayType):
        return _has_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_has_map(f.dataType) for f in data_type.fields)
    return False


def total_order(df: DataFrame, order_by: Sequence[str | Column] = ()) -> list[Column | str]:
    """``order_by`` first, then every column of the frame; maps are ordered by their JSON text."""
    named = {o for o in order_by if isinstance(o, str)}
    require_columns(df, sorted(named), "order columns")
    first = [quoted(o) if isinstance(o, str) else o for o in order_by]
    rest = [
        F.to_json(col(f.name)) if _has_map(f.dataType) else quoted(f.name)
        for f in df.schema.fields
        if f.name not in named
    ]
    return first + rest


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def deduplicate(
    df: DataFrame, order_by: Sequence[str | Column] = (), key: str = ROW_KEY
) -> DataFrame:
    """The first row of each key."""
    by_key = Window.partitionBy(col(key)).orderBy(*total_order(df, order_by))
    return df.withColumn(_RANK, F.row_number().over(by_key)).where(F.col(_RANK) == 1).drop(_RANK)


def frequent_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and more than 1 / 10,000 of all, to be broadcast.

    By the second condition there are fewer than 10,000 of them. All rows are the sum of the counts, so the table is read once for both.
    """
    counted = df.groupBy(col(key)).count()
    rows = counted.agg(F.sum("count")).scalar()
    hot = (F.col("count") > hot_rows) & (F.col("count") * _MOST_HOT_KEYS > rows)
    return F.broadcast(counted.where(hot).select(quoted(key)))


def _ranked(
    df: DataFrame,
    order_by: Sequence[str | Column],
    key: str,
    hot_rows: int,
    salts: int | None,
) -> DataFrame:
    """Every row with a rank that is 1 for the row to keep of its key and higher for the others."""
    salts = salts or _shuffle_partitions(df)
    order = total_order(df, order_by)
    hot = frequent_keys(df, key, hot_rows)
    per_key = Window.partitionBy(col(key)).orderBy(*order)
    rank_in_key = F.row_number().over(per_key)

    cold_rows = df.join(hot, key, "left_anti").withColumn(_RANK, rank_in_key)

    salted = df.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(salts)))
    per_salt = Window.partitionBy(col(key), F.col(_SALT)).orderBy(*order)
    hot_rows_ranked = (
        salted.join(hot, key, "left_semi")
        # The explicit shuffle keeps Spark from reusing a partitioning by the bare key.
        .repartition(col(key), F.col(_SALT))
        .withColumn(_RANK, F.row_number().over(per_salt))
    )
    later_in_salt = hot_rows_ranked.where(F.col(_RANK) > 1)
    # At most one row per key and salt is left for the second step.
    first_in_salt = hot_rows_ranked.where(F.col(_RANK) == 1).withColumn(_RANK, rank_in_key)

    names = [*df.columns, _RANK]
    parts = [pick(rows, names) for rows in (cold_rows, later_in_salt, first_in_salt)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def duplicates(
    df: DataFrame,
    order_by: Sequence[str | Column] = (),
    key: str = ROW_KEY,
    hot_rows: int = HOT_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """All rows but the first of each key.

    A key with more than ``hot_rows`` rows is spread over ``salts`` groups, by default as many as
    there are shuffle partitions. Neither number shows in the result.
    """
    ranked = _ranked(df, order_by, key, hot_rows, salts)
    return ranked.where(F.col(_RANK) > 1).drop(_RANK)


def mark_duplicates(
    df: DataFrame,
    order_by: Sequence[str | Column] = (),
    key: str = ROW_KEY,
    hot_rows: int = HOT_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """Every row with its status: ``NA`` for the one kept per key, else a batch duplicate."""
    ranked = _ranked(df, order_by, key, hot_rows, salts)
    status = F.when(F.col(_RANK) == 1, status_lit(Status.NA)).otherwise(
        status_lit(Status.DUPLICATE_IN_MICRO_BATCH)
    )
    return ranked.withColumn(STATUS, status).drop(_RANK)


def duplicate_rejects(
    df: DataFrame,
    order_by: Sequence[str | Column] = (),
    key: str = ROW_KEY,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The duplicates as reject rows."""
    rest = duplicates(df, order_by, key, hot_rows)
    return reject_rows(rest.withColumn(STATUS, status_lit(Status.DUPLICATE_IN_MICRO_BATCH)))


def deduplicate_and_reject(
    df: DataFrame, order_by: Sequence[str | Column] = (), key: str = ROW_KEY
) -> tuple[DataFrame, DataFrame]:
    """The kept rows and the reject rows."""
    return deduplicate(df, order_by, key), duplicate_rejects(df, order_by, key)


def sort_by_key(df: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """Global sort by key.

    The other columns and the partition a row came from follow the key, so that the range
    boundaries can cut through a hot key and through a large group of exact copies.
    """
    rest = total_order(df, [key])
    return (
        df.withColumn(_SALT, F.spark_partition_id())
        .sort(*rest, _SALT)
        .drop(_SALT)
    )
