import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronotable.operators.columns import enrich
from chronotable.operators.dedup import (
    deduplicate,
    deduplicate_and_reject,
    duplicates,
    mark_duplicates,
    sort_by_key,
)


def make(seed, count=600):
    """A third of the rows share one key, half of those are exact copies; some nulls."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        if i % 3 == 0:
            rows.append((0, 5, "copy") if i % 6 == 0 else (0, rng.randrange(50), "hot"))
        else:
            rows.append((rng.randrange(1, 150), rng.choice([None, 1, 2, 3]), rng.choice("ab")))
    rng.shuffle(rows)
    return rows


def brute_force(rows, newest_first=False):
    def order(row):
        ts = (row[1] is not None, row[1] or 0)
        if newest_first:
            ts = (row[1] is None, -(row[1] or 0))
        return (ts, row[0], row[2])

    kept, rest, seen = [], [], set()
    for row in sorted(rows, key=order):
        (rest if row[0] in seen else kept).append(row)
        seen.add(row[0])
    return Counter(kept), Counter(rest)


def frame(spark, rows, partitions):
    df = spark.createDataFrame(rows, "id int, ts int, note string").repartition(partitions)
    return enrich(df, ["id"], ["id", "ts"])


def bag(df):
    return Counter(tuple(r) for r in df.select("id", "ts", "note").collect())


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("shuffle_partitions", [1, 8])
def test_against_brute_force(spark, partitions, shuffle_partitions):
    rows = make(partitions)
    spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions)
    try:
        enriched = frame(spark, rows, partitions)
        kept, rest = brute_force(rows)
        assert bag(deduplicate(enriched, ["ts"])) == kept
        assert bag(duplicates(enriched, ["ts"])) == rest
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


@pytest.mark.parametrize("hot_rows", [1, 5, 100, 10_000])
@pytest.mark.parametrize("salts", [1, 3, None])
def test_hot_keys_and_salts_do_not_show(spark, hot_rows, salts):
    rows = make(99)
    kept, rest = brute_force(rows)
    enriched = frame(spark, rows, 5)
    assert bag(duplicates(enriched, ["ts"], hot_rows=hot_rows, salts=salts)) == rest
    marked = mark_duplicates(enriched, ["ts"], hot_rows=hot_rows, salts=salts)
    assert bag(marked.where("status = 0")) == kept
    assert bag(marked.where("status = 1")) == rest


def test_chosen_order(spark):
    rows = make(3)
    enriched = frame(spark, rows, 4)
    kept, rest = brute_force(rows, newest_first=True)
    assert bag(deduplicate(enriched, [F.desc("ts"), "id"])) == kept
    assert bag(duplicates(enriched, [F.desc("ts"), "id"])) == rest


def test_marks_and_rejects_add_up(spark):
    rows = make(4)
    enriched = frame(spark, rows, 4)
    kept, rest = brute_force(rows)
    marked = mark_duplicates(enriched, ["ts"])
    assert bag(marked.where("status = 0")) == kept
    assert bag(marked.where("status = 1")) == rest
    kept_rows, rejects = deduplicate_and_reject(enriched, ["ts"])
    assert kept_rows.columns == enriched.columns
    assert kept_rows.count() + rejects.count() == len(rows)
    assert {r.reason for r in rejects.collect()} == {"DUPLICATE_IN_MICRO_BATCH"}


def test_same_key_other_payload_is_a_duplicate(spark):
    enriched = frame(spark, [(1, 1, "a"), (1, 2, "b")], 1)
    assert bag(duplicates(enriched, ["ts"])) == Counter([(1, 2, "b")])


def test_maps_can_be_ordered(spark):
    rows = spark.sql("SELECT 1 AS id, map('a', x) AS m FROM VALUES (2), (1) AS t(x)")
    enriched = enrich(rows, ["id"], ["id"])
    assert [r.m for r in deduplicate(enriched).collect()] == [{"a": 1}]
    assert [r.m for r in duplicates(enriched).collect()] == [{"a": 2}]


def test_unknown_order_column(spark):
    with pytest.raises(ValueError, match="order columns"):
        deduplicate(frame(spark, [(1, 1, "a")], 1), ["tss"])


def test_sort(spark):
    rows = make(5)
    sorted_rows = sort_by_key(frame(spark, rows, 4)).collect()
    keys = [r.row_key for r in sorted_rows]
    assert keys == sorted(keys)
    assert Counter((r.id, r.ts, r.note) for r in sorted_rows) == Counter(rows)
