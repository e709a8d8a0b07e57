"""Merges on ranges against every pair."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from chronotable.operators.merge import TOO_MANY, Merge
from chronotable.operators.ranges import join_in_range


def pairs(points, spans):
    return sorted((p, s) for p, at in points for s, low, high in spans if None not in (at, low, high) and low <= at <= high)


def found(spark, points, spans, kind):
    left = spark.createDataFrame(points, f"p long, at {kind}")
    right = spark.createDataFrame(spans, f"s long, low {kind}, high {kind}")
    return join_in_range(left, right, "at", "low", "high", ("l", "r"))


KINDS = {
    "int": lambda n: n,
    "bigint": lambda n: n * 2**58,
    "double": lambda n: n / 7,
    "decimal(12,3)": lambda n: Decimal(n) / 8,
    "date": lambda n: date(2000, 1, 1) + timedelta(days=n),
    "timestamp": lambda n: datetime(2000, 1, 1) + timedelta(milliseconds=700 * n),
    "timestamp_ntz": lambda n: datetime(1960, 1, 1) + timedelta(milliseconds=700 * n),
}


@pytest.mark.parametrize("kind", KINDS)
def test_pairs_of_every_type(spark, kind):
    rng, make = random.Random(kind), KINDS[kind]
    most = 30 if kind == "bigint" else 3_000
    points = [(i, None if i == 0 else make(rng.randint(-most, most))) for i in range(150)]
    spans = [(0, None, make(1)), (1, make(1), None), (2, make(5), make(-5)), (3, make(-most), make(most))]
    for i in range(4, 80):
        low = rng.randint(-most, most)
        spans.append((i, make(low), make(min(most, low + rng.choice([0, 1, 8, 9, most // 10, most])))))
    joined = found(spark, points, spans, kind)
    assert sorted((r.p, r.s) for r in joined.select("p", "s").collect()) == pairs(points, spans)
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nan_and_infinite_ends(spark):
    nan, inf = float("nan"), float("inf")
    joined = found(spark, [(0, nan), (1, inf), (2, -1e300), (3, 0.5)], [(0, -inf, inf), (1, nan, nan), (2, 0.0, nan), (3, 0.5, 0.5)], "double")
    assert sorted((r.p, r.s) for r in joined.select("p", "s").collect()) == [(1, 0), (2, 0), (3, 0), (3, 3)]


def test_types_that_do_not_compare(spark):
    left, right = spark.createDataFrame([("a",)], "at string"), spark.createDataFrame([(1, 2)], "low int, high int")
    with pytest.raises(ValueError):
        join_in_range(left, right, "at", "low", "high", ("l", "r"))


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([(i, "a" if i % 2 else "b", "old") for i in range(10)] + [(None, "a", "old")], "id int, kind string, note string")


def test_merge(spark, orders):
    spans = spark.createDataFrame([(1, 3, "a"), (5, 5, "a"), (20, 30, "b"), (4, 2, "b"), (None, 9, "a")], "low int, high int, kind string")
    start = Merge(orders, "t").using(spans, "s").on_range("id", "low", "high", keys=["kind"])
    done = start.when_matched("t.id = 5").delete().when_matched().update({"note": "concat(s.low, '-', s.high)"}).when_not_matched().insert({"id": "s.high", "note": "'new'"})
    got = sorted(map(tuple, done.result().collect()), key=str)
    expected = [(i, "a" if i % 2 else "b", "1-3" if i in (1, 3) else "old") for i in range(10) if i != 5]
    expected += [(None, "a", "old"), (30, None, "new"), (2, None, "new"), (9, None, "new")]
    assert got == sorted(expected, key=str)
    assert done.result().columns == orders.columns
    assert sorted(r.id for r in done.touched().collect()) == [1, 3, 5]
    only = start.when_not_matched("s.low > 10").insert({"id": "s.low"}).result()
    assert only.count() == 12


def test_the_point_may_be_the_sources(spark):
    target = spark.createDataFrame([("x", 0, 9), ("y", 10, 19), ("z", 20, 29)], "name string, low int, high int")
    source = spark.createDataFrame([(3, 1), (12, 2), (50, 3)], "at int, add int")
    done = Merge(target, "t").using(source, "s").on_range("at", "low", "high", point_in="source").when_matched().update({"high": "t.high + s.add"})
    assert sorted(map(tuple, done.result().collect())) == [("x", 0, 10), ("y", 10, 21), ("z", 20, 29)]
    with pytest.raises(ValueError):
        Merge(target).using(source).on_range("at", "low", "high", point_in="both")


def test_a_row_in_two_spans_is_an_error_but_for_a_lone_delete(spark, orders):
    spans = spark.createDataFrame([(1, 3), (3, 4)], "low int, high int")
    start = Merge(orders).using(spans).on_range("id", "low", "high", condition="target.id <> 1")
    with pytest.raises(PySparkException, match=TOO_MANY):
        start.when_matched().update({"note": "'x'"}).result().collect()
    assert sorted(r.id for r in start.when_matched().delete().result().where("id IS NOT NULL").collect()) == [0, 1, 5, 6, 7, 8, 9]


def test_empty_sides(spark, orders):
    spans = spark.createDataFrame([(1, 3)], "low int, high int")
    for target, source, rows in ((orders.limit(0), spans, 1), (orders, spans.limit(0), 11)):
        done = Merge(target).using(source).on_range("id", "low", "high").when_matched().delete().when_not_matched().insert({"id": "source.low"})
        assert done.result().count() == rows
