import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronotable.operators.merge import Clause, Merge, upsert

SCHEMA = "id int, name string, amount int"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (3, "c", 30), (None, "n", 0)], SCHEMA
    )


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame(
        [(2, "B", 21), (3, "C", 31), (4, "D", 41), (None, "N", 1)], SCHEMA
    )


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def merges(target, source):
    """The same match given as keys, as text and as a column."""
    start = Merge(target).using(source)
    return [
        start.on_keys(["id"]),
        start.on_keys(["id"], source_unique=True),
        start.on("target.id = source.id"),
        start.on(F.col("target.id") == F.col("source.id")),
    ]


def test_upsert_by_every_kind_of_condition(target, source):
    expected = Counter(
        [
            (1, "a", 10), (None, "n", 0), (2, "B", 21), (3, "C", 31), (4, "D", 41), (None, "N", 1)
        ]
    )
    for merge in merges(target, source):
        done = merge.when_matched().update_all().when_not_matched().insert_all().result()
        assert bag(done) == expected
        assert done.columns == target.columns
    assert bag(upsert(target, source, ["id"])) == expected
    assert bag(upsert(target, source, ["id"], source_unique=True)) == expected


def test_first_clause_wins(target, source):
    for merge in merges(target, source):
        done = (
            merge.when_matched("target.amount > 25")
            .delete()
            .when_matched()
            .update({"NAME": F.concat("target.name", "source.name")})
            .when_not_matched("source.id IS NULL")
            .insert_expr({"name": "'unknown'"})
            .when_not_matched("source.amount > 40")
            .insert({"id": F.col("source.id"), "amount": F.col("source.amount") + 1})
            .result()
        )
        assert bag(done) == Counter(
            [(1, "a", 10), (None, "n", 0), (2, "bB", 20), (None, "unknown", None), (4, None, 42)]
        )


def test_condition_that_is_null_does_not_fire(target, source):
    for merge in merges(target, source):
        done = merge.when_matched(F.lit(None).cast("boolean")).delete().result()
        assert bag(done) == bag(target)


def test_only_the_clauses_given(target, source):
    for merge in merges(target, source):
        assert bag(merge.result()) == bag(target)
        kept = merge.when_matched().delete().result()
        assert bag(kept) == Counter([(1, "a", 10), (None, "n", 0)])
        added = merge.when_not_matched("source.id = 4").insert_all().result()
        assert bag(added) == bag(target) + Counter([(4, "D", 41)])


def test_builder_is_immutable(target, source):
    start = Merge(target).using(source).on_keys(["id"])
    start.when_matched().delete()
    assert start.matched == ()


def test_old_values_keep_their_digits(spark):
    big = 2**60 + 1
    held = spark.createDataFrame([(1, big, [1]), (2, 5, [2])], "id int, n bigint, tags array<int>")
    new = spark.createDataFrame([(2, 7.9, ["3"])], "id int, n double, tags array<string>")
    start = Merge(held).using(new).on_keys(["id"])
    for done in (
        start.when_matched().update_all(),
        start.when_matched().update({n: F.col(f"source.{n}") for n in held.columns}),
    ):
        assert done.result().schema.simpleString() == held.schema.simpleString()
        found = sorted(tuple(r) for r in done.result().collect())
        assert found == [(1, big, [1]), (2, 7, [3])]


def test_statement_in_one_call(target, source):
    done = Merge(
        target,
        source=source,
        condition="target.id = source.id",
        matched=(Clause("delete", "target.id = 2"), Clause("update")),
        not_matched=(Clause("insert", "source.id = 4"),),
    ).result()
    assert bag(done) == Counter([(1, "a", 10), (None, "n", 0), (3, "C", 31), (4, "D", 41)])


def test_missing_parts(target, source):
    with pytest.raises(ValueError, match="needs a source"):
        Merge(target).on_keys(["id"]).when_matched().delete().result()
    with pytest.raises(ValueError, match="match condition"):
        Merge(target).using(source).when_matched().delete().result()
    start = Merge(target).using(source).on_keys(["id"])
    with pytest.raises(ValueError, match="no columns"):
        start.when_matched().update_expr({"nope": "1"}).result()
    with pytest.raises(ValueError, match="target keys"):
        Merge(target).using(source).on_keys(["nope"]).result()
    with pytest.raises(ValueError, match="source has no columns \\['amount'\\]"):
        Merge(target).using(source.drop("amount")).on_keys(["id"]).when_matched().update_all(
        ).result()


def test_extra_source_columns_and_letter_case(target, source):
    wide = source.toDF("ID", "Name", "AMOUNT").withColumn("extra", F.lit(1))
    done = (
        Merge(target, "i")
        .using(wide, "d")
        .on_keys([("id", "ID")])
        .when_matched()
        .update_all()
        .when_not_matched("d.extra = 0")
        .insert_all()
        .result()
    )
    assert bag(done) == Counter([(1, "a", 10), (None, "n", 0), (2, "B", 21), (3, "C", 31)])


def test_competing_source_rows(spark, target, source):
    twice = source.unionByName(spark.createDataFrame([(2, "other", 22)], SCHEMA))
    for merge in [m for m in merges(target, twice) if not m.source_unique]:
        with pytest.raises(PySparkException, match="more than one source row"):
            merge.when_matched().update_all().result().collect()
        with pytest.raises(PySparkException, match="more than one source row"):
            merge.when_matched("target.id = 99").delete().result().collect()
        # A lone unconditional delete has nothing to choose between.
        assert bag(merge.when_matched().delete().result()) == Counter(
            [(1, "a", 10), (None, "n", 0)]
        )


def test_repeated_source_rows_without_a_target_are_all_inserted(spark, target):
    new = spark.createDataFrame([(7, "x", 1), (7, "x", 1), (7, "y", 2)], SCHEMA)
    for merge in [m for m in merges(target, new) if not m.source_unique]:
        done = merge.when_matched().update_all().when_not_matched().insert_all().result()
        assert bag(done) == bag(target) + bag(new)


def test_repeated_target_rows_are_all_changed(spark, source):
    doubled = spark.createDataFrame([(2, "b", 20), (2, "b", 20), (2, "z", 5)], SCHEMA)
    for merge in merges(doubled, source):
        done = merge.when_matched().update_expr({"amount": "source.amount"}).result()
        assert bag(done) == Counter({(2, "b", 21): 2, (2, "z", 21): 1})


def test_condition_beyond_equality(target, source):
    done = (
        Merge(target)
        .using(source)
        .on("target.id = source.id AND source.amount > target.amount * 1.04")
        .when_matched()
        .update_all()
        .when_not_matched()
        .insert_expr({"id": "-source.id", "name": "source.name"})
        .result()
    )
    assert bag(done) == Counter(
        [
            (1, "a", 10), (2, "B", 21), (3, "c", 30), (None, "n", 0),
            (-3, "C", None), (-4, "D", None), (None, "N", None),
        ]
    )


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)

    def some(count):
        return [
            (rng.choice([None, *range(30)]), rng.choice("xyz"), rng.randrange(100))
            for _ in range(count)
        ]

    old = some(40)
    new = list({r[0]: r for r in some(40)}.values()) + [(None, "q", 1)]
    by_key = {r[0]: r for r in new if r[0] is not None}
    held = {r[0] for r in old}
    expected = Counter()
    for row in old:
        match = by_key.get(row[0])
        if match is None:
            expected[row] += 1
        elif row[2] > 70:
            continue
        elif match[1] == "x":
            expected[match] += 1
        else:
            expected[(row[0], row[1], row[2] + match[2])] += 1
    for row in new:
        if (row[0] is None or row[0] not in held) and row[2] < 50:
            expected[row] += 1

    frames = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    for merge in merges(*frames):
        done = (
            merge.when_matched("target.amount > 70")
            .delete()
            .when_matched("source.name = 'x'")
            .update_all()
            .when_matched()
            .update_expr({"amount": "target.amount + source.amount"})
            .when_not_matched("source.amount < 50")
            .insert_all()
            .result()
        )
        assert bag(done) == expected


def test_a_condition_beside_the_keys(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, v int")
    source = spark.createDataFrame([(1, 11), (2, 5), (4, 40)], "id int, v int")
    start = Merge(target).using(source).on_keys(["id"], condition="source.v > target.v")
    done = start.when_matched().update_all().when_not_matched().insert_all().result()
    assert sorted(map(tuple, done.collect())) == [(1, 11), (2, 5), (2, 20), (3, 30), (4, 40)]
    assert sorted(map(tuple, start.when_matched().delete().result().collect())) == [(2, 20), (3, 30)]
    # A key that repeats in the source competes only where both rows meet the condition.
    more = source.unionByName(spark.createDataFrame([(1, 3)], "id int, v int"))
    again = Merge(target).using(more).on_keys(["id"], condition="source.v > target.v").when_matched().update_all()
    assert sorted(map(tuple, again.result().collect())) == [(1, 11), (2, 20), (3, 30)]
    twice = source.unionByName(spark.createDataFrame([(1, 12)], "id int, v int"))
    with pytest.raises(PySparkException, match="more than one source row"):
        Merge(target).using(twice).on_keys(["id"], condition="source.v > target.v").when_matched().update_all().result().collect()


def test_comparing_every_pair_must_be_asked_for(spark):
    target = spark.createDataFrame([(1, 10)], "id int, v int")
    start = Merge(target).using(target.withColumn("v", F.col("v") + 1))
    with pytest.raises(ValueError, match="all_pairs"):
        start.on("source.v > target.v").when_matched().update_all().result()
    with pytest.raises(ValueError, match="all_pairs"):
        start.on("source.v > target.v").when_not_matched().insert_all().result()
    done = start.on("source.v > target.v", all_pairs=True).when_matched().update_all().result()
    assert done.collect() == [(1, 11)]
