"""Merges into named tables: two writers, partitions that are touched and those that are not."""

import datetime
import uuid
from collections import Counter

import pytest

from chronotable.plans.spec import Dimension
from chronotable.plans.stored import history_into, merge_into, merge_on, scd1_into
from chronotable.sources.tables import abandon_change, append, changing, contents, create_table_like, remove_replaced, replace_rows

SCHEMA = "id long, part string, value string"
ROWS = [(1, "a", "x"), (2, "a", "y"), (3, "b", "z"), (4, None, "w"), (5, "c/d=e", "v")]


@pytest.fixture
def make(spark, tmp_path):
    def table(partition_by=(), rows=ROWS, schema=SCHEMA, transform=None):
        name = f"stored_{uuid.uuid4().hex}"
        df = spark.createDataFrame(rows, schema)
        create_table_like(df, name, partition_by, str(tmp_path), transform)
        append(df, name)
        return name

    return table


def bag(frame):
    return Counter(map(tuple, frame.collect()))


def upsert(spark, name, rows):
    merge = merge_on(spark, name).using(spark.createDataFrame(rows, SCHEMA)).on_keys(["id"])
    return merge.when_matched("source.value = 'gone'").delete().when_matched().update_all().when_not_matched().insert_all()


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_of_two_writers_one_fails(spark, make, partition_by):
    """Both were prepared on the same rows; nothing of either is lost without an error."""
    name = make(partition_by)
    first, second = upsert(spark, name, [(10, "a", "first")]), upsert(spark, name, [(11, "a", "second")])
    merge_into(first, name)
    with pytest.raises(RuntimeError, match="has changed"):
        merge_into(second, name)
    assert bag(spark.table(name).select("id", "part", "value")) == Counter([*ROWS, (10, "a", "first")])
    merge_into(upsert(spark, name, [(11, "a", "second")]), name)
    assert spark.table(name).count() == len(ROWS) + 2


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_rows_appended_meanwhile_are_not_lost(spark, make, partition_by):
    name = make(partition_by)
    merge = upsert(spark, name, [(1, "a", "new")])
    append(spark.createDataFrame([(20, "b", "appended")], SCHEMA), name)
    with pytest.raises(RuntimeError, match="has changed"):
        merge_into(merge, name)
    assert spark.table(name).where("id = 20").count() == 1


def test_a_writer_at_work_keeps_others_out(spark, make):
    name = make(["part"])
    merge = upsert(spark, name, [(1, "a", "new")])
    with changing(spark, name, contents(spark, name)):
        with pytest.raises(RuntimeError, match="another writer"):
            merge_into(merge, name)
    merge_into(merge, name)
    assert spark.table(name).where("value = 'new'").count() == 1


def test_a_writer_that_died_can_be_forgotten(spark, make):
    name = make()
    dead = changing(spark, name, contents(spark, name))
    dead.__enter__()
    with pytest.raises(RuntimeError, match="abandon_change"):
        merge_into(upsert(spark, name, [(1, "a", "new")]), name)
    abandon_change(spark, name)
    merge_into(upsert(spark, name, [(1, "a", "new")]), name)


def files(spark, name):
    return set(spark.table(name).inputFiles())


def of(found, part):
    return {f for f in found if f"part={part}/" in f}


def test_only_touched_partitions_are_written(spark, make):
    name = make(["part"])
    before = files(spark, name)
    merge_into(upsert(spark, name, [(3, "b", "new"), (4, "f", "moved from null"), (9, "g", "inserted")]), name)
    after = files(spark, name)
    assert of(before, "a") == of(after, "a") and of(before, "a")
    assert {f for f in before if "d%3De" in f} <= after
    assert not of(before, "b") & of(after, "b")
    expected = [(1, "a", "x"), (2, "a", "y"), (3, "b", "new"), (4, "f", "moved from null"), (5, "c/d=e", "v"), (9, "g", "inserted")]
    assert bag(spark.table(name).select("id", "part", "value")) == Counter(expected)
    # What the merge left empty is gone, also from the catalog.
    assert not {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect() if "__HIVE_DEFAULT" in r.partition}


def test_partitions_that_are_not_touched_are_not_read(spark, make, tmp_path):
    """A broken file in another partition does no harm."""
    name = make(["part"])
    [broken] = of(files(spark, name), "a")
    open(broken.removeprefix("file:").removeprefix("//"), "wb").write(b"not parquet")
    merge_into(upsert_on(spark, name, [(3, "b", "new")]), name)
    assert bag(spark.table(name).where("part = 'b'").select("id", "value")) == Counter([(3, "new")])


def upsert_on(spark, name, rows):
    """Matched on the partition as well, so that the others need not be looked at."""
    merge = merge_on(spark, name).using(spark.createDataFrame(rows, SCHEMA)).on("target.part = 'b' AND target.id = source.id")
    return merge.when_matched().update_all()


def test_a_merge_into_a_partition_that_has_rows_keeps_them(spark, make):
    name = make(["part"])
    merge = merge_on(spark, name).using(spark.createDataFrame([(1, "zz", "ignored"), (30, "a", "added"), (31, None, "n")], SCHEMA)).on_keys(["id"])
    merge_into(merge.when_not_matched().insert_all(), name)
    assert bag(spark.table(name).select("id", "part", "value")) == Counter([*ROWS, (30, "a", "added"), (31, None, "n")])


def test_deleting_a_whole_partition(spark, make):
    name = make(["part"])
    merge_into(upsert(spark, name, [(1, "a", "gone"), (2, "a", "gone"), (4, "", "gone"), (5, "", "gone")]), name)
    assert bag(spark.table(name).select("id", "part", "value")) == Counter([(3, "b", "z")])
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 1


def test_day_partitions_follow_the_rows(spark, make):
    """Partition columns that the table derives need not be in the source and move with the rows."""

    def ts(day):
        return datetime.datetime(2024, 1, day, 12)

    schema = "id long, at timestamp_ntz, value string"
    name = make(["at"], [(1, ts(1), "x"), (2, ts(1), "y"), (3, ts(2), "z")], schema, "day")
    source = spark.createDataFrame([(1, ts(3), "moved"), (4, ts(2), "new")], schema)
    merge_into(merge_on(spark, name).using(source).on_keys(["id"]).when_matched().update_all().when_not_matched().insert_all(), name)
    assert bag(spark.table(name).selectExpr("id", "value", "day(at_day)")) == Counter([(1, "moved", 3), (2, "y", 1), (3, "z", 2), (4, "new", 2)])
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 3


def test_type_1_into_a_partitioned_table(spark, make):
    dimension = Dimension(["id"], "at")
    schema = "id long, at timestamp_ntz, value string"
    first = spark.createDataFrame([(i, datetime.datetime(2024, 1, 1), "x") for i in range(4)], schema)
    name = f"stored_{uuid.uuid4().hex}"
    open_rows = dimension.open_rows(dimension.enrich(first))
    create_table_like(open_rows, name, ["value"])
    append(open_rows, name)
    batch = spark.createDataFrame([(1, datetime.datetime(2024, 2, 1), "y"), (9, datetime.datetime(2024, 2, 1), "x")], schema)
    scd1_into(name, batch, dimension)
    assert bag(spark.table(name).select("id", "value")) == Counter([(0, "x"), (1, "y"), (2, "x"), (3, "x"), (9, "x")])


def test_an_empty_source_changes_nothing(spark, make):
    name = make(["part"])
    before = files(spark, name)
    merge_into(upsert(spark, name, []), name)
    assert files(spark, name) == before


def test_replaced_folders_are_kept_until_removed(spark, make):
    name = make()
    old = spark.table(name)
    for i in range(3):
        merge_into(upsert(spark, name, [(1, "a", f"v{i}")]), name)
    assert old.where("id = 1").first().value == "x"
    assert remove_replaced(spark, name) == 2
    assert spark.table(name).where("id = 1").first().value == "v2"
    assert remove_replaced(spark, name) == 0


def test_history_is_kept_from_a_lost_update(spark, make, monkeypatch):
    from pyspark.sql import functions as F

    name = make((), [(1, "x", "Y", None)], "id long, value string, active_ind string, end_dt timestamp_ntz")
    landing = spark.createDataFrame([(1, "y")], "id long, value string")
    as_of = F.lit("2024-06-01").cast("timestamp_ntz")
    history_into(name, landing, "id", as_of)
    assert bag(spark.table(name).select("value", "active_ind")) == Counter([("x", "N"), ("y", "Y")])
    seen = contents(spark, name)
    append(spark.createDataFrame([(7, "z", "Y", None)], spark.table(name).schema), name)
    with pytest.raises(RuntimeError, match="has changed"):
        replace_rows(spark.table(name).limit(0), name, seen)
    assert spark.table(name).count() == 3


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_ranges_into_a_named_table(spark, make, partition_by):
    name = make(partition_by)
    spans = spark.createDataFrame([(2, 3), (5, 5), (20, 30)], "low long, high long")
    start = merge_on(spark, name).using(spans).on_range("id", "low", "high")
    changed = start.when_matched("target.id = 5").delete().when_matched().update({"value": "'in'"})
    merge_into(changed.when_not_matched().insert({"id": "source.high", "part": "'b'"}), name)
    kept = [(1, "a", "x"), (2, "a", "in"), (3, "b", "in"), (4, None, "w"), (30, "b", None)]
    assert bag(spark.table(name).select("id", "part", "value")) == Counter(kept)
    again = merge_on(spark, name).using(spans).on_range("id", "low", "high")
    merge_into(again.when_not_matched().insert({"id": "source.low", "part": "'a'"}), name)
    assert bag(spark.table(name).select("id", "part", "value")) == Counter([*kept, (5, "a", None)])
