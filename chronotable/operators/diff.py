"""What two tables differ in, shuffling only the buckets that do.

Rows are dealt to buckets by their keys. Each bucket has a fingerprint that does not depend on the order of its rows: their number and two sums of row
hashes, which map tasks add up before anything is shuffled. Only rows of buckets with different fingerprints are then compared.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotable.functions.columns import col, pick, quoted, require_columns

BUCKET, N_LEFT, N_RIGHT = "bucket", "n_left", "n_right"
_PRINT = ("n_rows", "sum_1", "sum_2")


def _hashed(df: DataFrame, names: Sequence[str], seed: int) -> Column:
    """A hash of values and of where the nulls are, which hashes as such pass over."""
    fields = [df.schema[n] for n in names]
    nested = (T.ArrayType, T.StructType)
    values = [F.to_json(col(f.name), {"ignoreNullFields": "false"}) if isinstance(f.dataType, nested) else col(f.name) for f in fields]
    return F.xxhash64(F.lit(seed), F.array(*[col(n).isNull() for n in names]), *values)


def bucket_of(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """Number of a row's bucket, from 0."""
    return F.pmod(_hashed(df, keys, 0), F.lit(buckets)).cast("int")


def bucket_prints(df: DataFrame, keys: Sequence[str], buckets: int = 4096, bucket: str | None = None) -> DataFrame:
    """(bucket, n_rows, sum_1, sum_2) of each bucket that has rows; fit to be stored beside a table.

    ``bucket`` names a column that holds the numbers already, such as the one that a table is partitioned by; it is no part of a row's content.
    """
    content = sorted(n for n in df.columns if n != bucket)
    require_columns(df, keys, "key columns")
    number = bucket_of(df, keys, buckets) if bucket is None else col(bucket)
    hashes = [_hashed(df, content, seed).cast("decimal(20,0)") for seed in (1, 2)]
    rows = df.select(number.alias(BUCKET), hashes[0].alias("__1"), hashes[1].alias("__2"))
    return rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("__1").alias("sum_1"), F.sum("__2").alias("sum_2"))


def differing_buckets(left: DataFrame, right: DataFrame) -> list[int]:
    """Numbers of the buckets whose fingerprints differ; there are no more than buckets."""
    sides = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    sums = [F.sum(F.col(n) * F.col("side")).alias(n) for n in _PRINT]
    uneven = functools.reduce(Column.__or__, [F.col(n) != 0 for n in _PRINT])
    return sorted(r[0] for r in sides.groupBy(BUCKET).agg(*sums).where(uneven).select(BUCKET).collect())


def table_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    buckets: int = 4096,
    bucket: str | None = None,
    prints: tuple[DataFrame | None, DataFrame | None] = (None, None),
) -> DataFrame:
    """Rows that one table has more often than the other, once each, with ``n_left`` and ``n_right``.

    Both need the same columns and types, in any order. Nulls equal nulls; repeated rows count. A changed row shows as its old and its new
    content. ``prints`` are stored fingerprints of the tables as they are, which save the scan that makes them; with tables partitioned
    by the column ``bucket``, partitions whose fingerprints agree are then not read. Different bags of rows have equal fingerprints by chance only, some 2^-128.
    """
    types = [{f.name: f.dataType for f in df.schema.fields} for df in (left, right)]
    if types[0] != types[1]:
        raise ValueError(f"the tables have different columns: {left.dtypes} and {right.dtypes}")
    maps = [n for n, t in types[0].items() if "map<" in t.simpleString() or isinstance(t, T.VariantType)]
    clash = [n for n in left.columns if n in (N_LEFT, N_RIGHT)]
    if maps or clash:
        raise ValueError(f"columns that cannot be compared or have a reserved name: {maps + clash}")
    require_columns(left, [*keys, *([] if bucket is None else [bucket])], "key columns")
    made = [bucket_prints(df, keys, buckets, bucket) if p is None else p for df, p in zip((left, right), prints, strict=True)]
    numbers = differing_buckets(*made)
    names = [n for n in left.columns if n != bucket]
    number = bucket_of(left, keys, buckets) if bucket is None else col(bucket)
    sides = [pick(df.where(number.isin(numbers)), names) for df in (left, right)]
    counted = [s.withColumns({N_LEFT: F.lit(1 - i), N_RIGHT: F.lit(i)}) for i, s in enumerate(sides)]
    bags = counted[0].unionByName(counted[1]).groupBy(*[quoted(n) for n in names])
    return bags.agg(F.sum(N_LEFT).alias(N_LEFT), F.sum(N_RIGHT).alias(N_RIGHT)).where(F.col(N_LEFT) != F.col(N_RIGHT))
