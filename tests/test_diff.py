"""Differences of two tables against bags of rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronotable.operators.diff import BUCKET, bucket_of, bucket_prints, differing_buckets, table_diff

SCHEMA = "id int, name string, `a.b` double, tags array<string>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(row):
    return tuple(tuple(v) if isinstance(v, list) else v for v in row)


def expected(left, right):
    a, b = Counter(map(plain, left)), Counter(map(plain, right))
    return {row: (a[row], b[row]) for row in a | b if a[row] != b[row]}


def found(diff):
    return {plain(r[:-2]): tuple(r[-2:]) for r in diff.collect()}


def some_rows(rng, n):
    pick = [None, "x", "y", ""]
    return [
        (rng.choice([None, *range(8)]), rng.choice(pick), rng.choice([None, 0.5, 2.0]), rng.choice([None, [], ["x", None], [None, "x"]]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_against_bags(spark, seed):
    rng = random.Random(seed)
    left = some_rows(rng, 60)
    right = [r for r in left if rng.random() > 0.1] + some_rows(rng, 4) + left[:2]
    rng.shuffle(right)
    got = table_diff(frame(spark, left), frame(spark, right).select("tags", "`a.b`", "name", "id"), ["id", "name"], buckets=1 + 40 * (seed % 2))
    assert got.columns == ["id", "name", "a.b", "tags", "n_left", "n_right"]
    assert found(got) == expected(left, right) != {}


def test_equal_tables_and_empty_ones(spark):
    rows = some_rows(random.Random(9), 30)
    left = frame(spark, rows)
    assert table_diff(left, frame(spark, rows[::-1]).repartition(5), ["id"]).count() == 0
    none = frame(spark, [])
    assert table_diff(none, none, ["id"]).count() == 0
    assert found(table_diff(none, left, ["id"])) == expected([], rows)


def test_rows_that_hash_alike_without_their_nulls(spark):
    """Swapped nulls, in columns and in lists, change a fingerprint."""
    pairs = [((1, "x", None, None), (1, "x", None, [])), ((1, None, 0.5, ["x", None]), (1, None, 0.5, [None, "x"]))]
    for a, b in pairs:
        assert found(table_diff(frame(spark, [a]), frame(spark, [b]), ["id"])) == expected([a], [b])
    texts = [spark.createDataFrame([r], "id int, x string, y string") for r in ((1, "v", None), (1, None, "v"))]
    assert table_diff(*texts, ["id"]).count() == 2


def test_only_differing_buckets_are_read(spark, tmp_path):
    """Tables partitioned by bucket, with their fingerprints stored beside them."""
    old = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    new = old.withColumn("text", F.when(F.col("id") == 7, "changed").otherwise(F.col("text")))
    tables, prints = [], []
    for name, df in (("old", old), ("new", new)):
        df.withColumn(BUCKET, bucket_of(df, ["id"], 32)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
        bucket_prints(tables[-1], ["id"], bucket=BUCKET).write.parquet(str(tmp_path / f"{name}_prints"))
        prints.append(spark.read.parquet(str(tmp_path / f"{name}_prints")))
    (number,) = differing_buckets(*prints)
    done = table_diff(*tables, ["id"], bucket=BUCKET, prints=tuple(prints))
    assert found(done) == {(7, "changed"): (0, 1), (7, old.where("id = 7").first().text): (1, 0)}
    # A partition that agrees is not opened: without its files the answer is the same.
    for name in ("old", "new"):
        for file in (tmp_path / name / f"bucket={(number + 1) % 32}").glob("*.parquet"):
            file.write_bytes(b"no table")
    assert done.count() == 2
    made = table_diff(tables[0], tables[0], ["id"], bucket=BUCKET, prints=(prints[0], prints[0]))
    assert made.count() == 0


def test_what_cannot_be_compared(spark):
    left = spark.createDataFrame([(1, "a")], "id int, x string")
    for right in (left.withColumn("x", F.lit(1)), left.withColumn("y", F.lit(1)), left.drop("x")):
        with pytest.raises(ValueError):
            table_diff(left, right, ["id"])
    for bad in (left.withColumn("m", F.create_map("x", "id")), left.withColumn("n_left", F.lit(1))):
        with pytest.raises(ValueError):
            table_diff(bad, bad, ["id"])
    with pytest.raises(ValueError):
        table_diff(left, left, ["no"])
