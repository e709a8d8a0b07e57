"""A key with a third of all rows is split by adaptive execution in every join it takes part in."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronotable.operators.classify import restrict_existing
from chronotable.operators.dedup import deduplicate, duplicates
from chronotable.operators.merge import Merge
from chronotable.operators.relocate import join_on_basename
from chronotable.plans.scd2 import classified_batch
from chronotable.plans.spec import Dimension

ROWS = 60_000
SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(autouse=True)
def small_partitions(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name in SETTINGS:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """Keys 1, 1, 1, ... for a third of the rows; the others have a few rows each."""
    path = str(tmp_path_factory.mktemp("skew") / "rows")
    number = F.col("id")
    spark.range(ROWS, numPartitions=6).select(
        F.when(number % 3 == 0, 1).otherwise(2 + F.pmod(F.xxhash64("id"), F.lit(9000))).alias("k"),
        F.timestamp_seconds(number).alias("ts"),
        F.sha2(number.cast("string"), 256).alias("note"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """One row per key, some of them new."""
    path = str(tmp_path_factory.mktemp("skew") / "few")
    spark.range(1, 12_000).select(
        F.col("id").alias("k"), F.lit("new").alias("note"), F.current_timestamp().alias("ts")
    ).write.parquet(path)
    return spark.read.parquet(path)


def is_split(df):
    run = df.select("*")
    run.write.format("noop").mode("overwrite").save()
    rows = run.collect()
    plan = run._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    return "skew=true" in plan, rows


DIMENSION = Dimension(["k"], "ts")
AS_IS = Dimension(["k"], "ts", dedup=False)


def test_duplicates(spark, rows):
    enriched = DIMENSION.enrich(rows)
    rest = duplicates(enriched, ["ts"], hot_rows=1000)
    found = rest.collect()
    assert len(found) == ROWS - deduplicate(enriched, ["ts"]).count()
    assert Counter(r.k for r in found)[1] == ROWS // 3 - 1
    # No partition holds the hot key whole, and only keys that are hot are salted.
    share = rest.where("k = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(share) >= 4
    assert max(r["count"] for r in share) < ROWS // 3 * 0.6


def test_without_hot_keys_their_branch_is_dropped(rows):
    rest = duplicates(DIMENSION.enrich(rows.where("k > 1")), ["ts"])
    rest.collect()
    final = rest._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    assert "__salt" not in final
    assert len([x for x in final.splitlines() if "Exchange hashpartitioning" in x]) == 1


def test_merge_into_a_hot_target(rows, few):
    start = Merge(rows).using(few).on_keys(["k"])
    split, found = is_split(start.when_matched().update_expr({"note": "source.note"}).result())
    assert split
    assert Counter(r.note for r in found)["new"] == ROWS
    split, found = is_split(start.when_matched().delete().result())
    assert split
    assert found == []


def test_insert_from_a_hot_source(rows, few):
    start = Merge(few.where("k > 1")).using(rows).on_keys(["k"])
    split, found = is_split(start.when_not_matched().insert_all().result())
    assert split
    assert Counter(r.k for r in found)[1] == ROWS // 3


def test_batch_that_is_not_deduplicated(rows, few):
    existing = AS_IS.open_rows(AS_IS.enrich(few))
    split, found = is_split(classified_batch(existing, AS_IS.enrich(rows), AS_IS))
    assert split
    assert len(found) == 2 * ROWS


def test_hot_batch_key_is_combined_before_the_semi_join(rows, few):
    existing = AS_IS.enrich(few)
    touched = restrict_existing(existing, AS_IS.enrich(rows))
    assert touched.count() == rows.select("k").distinct().count()


def test_base_name_that_many_files_share(rows):
    files = rows.select(F.concat_ws("/", F.lit("a"), "k").alias("path"), "note")
    lists = rows.select(F.concat_ws("/", F.lit("b"), "k").alias("list"), "ts")
    split, found = is_split(join_on_basename(files, "path", lists, "list", "ts"))
    assert split
    assert len(found) == ROWS
