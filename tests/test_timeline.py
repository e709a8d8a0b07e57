"""Histories whatever the order of the rows, chains of versions in one batch, and facts as of their time."""

import datetime
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronotable.operators.asof import as_of_join
from chronotable.operators.timeline import STARTS, cut_versions
from chronotable.plans.scd2 import scd2_fold
from chronotable.plans.spec import Dimension
from chronotable.plans.timeline import chain_run, history_fold, history_run

SCHEMA = "id long, at timestamp_ntz, value string, note long"
DIMENSION = Dimension(["id"], "at", ignore=["note"])
START = datetime.datetime(2024, 1, 1)
OPEN = datetime.datetime(9999, 12, 31)
MILLI = datetime.timedelta(milliseconds=1)


def at(micros):
    return START + datetime.timedelta(microseconds=micros)


def before(moment):
    return moment.replace(microsecond=moment.microsecond // 1000 * 1000) - MILLI


def brute(rows):
    """Versions, confirmations and refused rows of a set of rows."""
    first, refused = {}, []
    for row in sorted(rows, key=lambda r: (r[1], r[0], r[2], r[3])):
        if (row[0], row[1]) in first:
            refused.append(row)
        else:
            first[row[0], row[1]] = row
    versions, confirmed = [], []
    for key in {r[0] for r in rows}:
        own = sorted((r for r in first.values() if r[0] == key), key=lambda r: r[1])
        starts = [r for i, r in enumerate(own) if i == 0 or own[i - 1][2] != r[2]]
        confirmed += [r for r in own if r not in starts]
        for row, following in zip(starts, [*starts[1:], None], strict=True):
            versions.append((*row, max(before(following[1]), row[1]) if following else OPEN))
    return Counter(versions), Counter(confirmed), len(refused)


def bag(frame, *names):
    return Counter(map(tuple, frame.select(*names).collect()))


COLUMNS = ("id", "at", "value", "note")


def outcome(history):
    assert history.open.where("valid_to <> TIMESTAMP_NTZ'9999-12-31'").isEmpty()
    assert history.closed.where("valid_to = TIMESTAMP_NTZ'9999-12-31' OR valid_to < valid_from").isEmpty()
    return bag(history.versions, *COLUMNS, "valid_to"), bag(history.confirmed, *COLUMNS), history.rejects.count()


rows_of = st.lists(
    st.tuples(st.integers(1, 2), st.sampled_from([0, 400, 900, 1_500, 10_000, 86_400_000_000]).map(at), st.sampled_from("ab"), st.integers(0, 1)),
    min_size=1,
    max_size=9,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_of, st.randoms(use_true_random=False))
def test_the_order_of_the_batches_does_not_matter(spark, rows, random):
    shuffled = list(rows)
    random.shuffle(shuffled)
    cut = random.randint(0, len(rows))
    batches = [spark.createDataFrame(part, SCHEMA) for part in (shuffled[:cut], shuffled[cut:]) if part]
    history = history_fold(batches, DIMENSION)
    assert outcome(history) == brute(rows)
    rejected = bag(history.rejects, "reason", "rowData")
    assert rejected == bag(history_run(None, spark.createDataFrame(rows, SCHEMA), DIMENSION).rejects, "reason", "rowData")


def test_a_late_row_splits_the_version_it_falls_in(spark):
    def run(rows):
        return history_fold([spark.createDataFrame([row], SCHEMA) for row in rows], DIMENSION)

    a1, a3, b2 = (1, at(0), "a", 0), (1, at(20_000), "a", 0), (1, at(10_000), "b", 0)
    assert bag(run([a1, a3]).versions, "at", "value", "valid_to") == Counter([(at(0), "a", OPEN)])
    expected = Counter([(at(0), "a", at(9_000)), (at(10_000), "b", at(19_000)), (at(20_000), "a", OPEN)])
    assert bag(run([a1, a3, b2]).versions, "at", "value", "valid_to") == expected
    # A row between two equal neighbours that says the same melts with them.
    assert bag(run([a1, a3, (1, at(5_000), "a", 0)]).versions, "at", "value", "valid_to") == Counter([(at(0), "a", OPEN)])


def test_keys_that_a_batch_does_not_touch_stay(spark):
    first = spark.createDataFrame([(i, at(0), "a", 0) for i in range(5)], SCHEMA)
    history = history_fold([first, spark.createDataFrame([(2, at(5_000), "b", 0)], SCHEMA), first.limit(0)], DIMENSION)
    assert history.open.count() == 5 and history.closed.count() == 1 and history.rejects.count() == 0


def test_a_null_moment_is_an_error(spark):
    with pytest.raises(PySparkException, match="needs a valid_from"):
        history_run(None, spark.createDataFrame([(1, None, "a", 0)], SCHEMA), DIMENSION).open.collect()


def points(spark, n=4_000):
    """One key with all points but a few, in long and short runs of equal values."""
    rows = [(1 if i % 50 else 2 + i % 3, at(i * 7_000), "ab"[(i // 900 + (i > 3_000 and i % 7 == 0)) % 2], i) for i in range(n)]
    return DIMENSION.open_rows(DIMENSION.enrich(spark.createDataFrame(rows, SCHEMA).repartition(5)))


@pytest.mark.parametrize("blocks", [2, 3, 16, 150])
def test_blocks_do_not_show(spark, blocks):
    rows = points(spark)
    names = [*COLUMNS, "valid_to", STARTS]
    assert bag(cut_versions(rows, hot_rows=100, blocks=blocks), *names) == bag(cut_versions(rows), *names)


def test_a_hot_key_is_cut_in_blocks_of_its_points(spark):
    """No task sorts the key alone: the largest block has a small part of its points."""
    from chronotable.operators.dedup import frequent_keys
    from chronotable.operators.timeline import _BLOCK, _blocked

    rows = points(spark)
    placed = _blocked(rows, frequent_keys(rows, "row_key", 100), 16)
    sizes = [r["count"] for r in placed.groupBy("row_key", _BLOCK).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 4_000 / 8
    plan = cut_versions(rows, hot_rows=100, blocks=16)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_chain_is_the_fold_row_by_row(spark):
    rows = [(k, at(1_000_000 * i + k), "aabbbacca"[(i * (k + 1)) % 9], i) for k in range(3) for i in range(6)]
    late = [(0, at(-5), "zzz", 0), (1, at(1_000_001), rows[7][2], 9)]
    strict = Dimension(["id"], "at", ignore=["note"], late="reject")
    steps = [[r for r in rows if r[3] == i] for i in range(6)]
    folded = scd2_fold([spark.createDataFrame(s, SCHEMA) for s in [*steps[:3], late, *steps[3:]]], strict)
    chained = chain_run(None, spark.createDataFrame([r for s in steps[:3] for r in s], SCHEMA), strict)
    chained = chain_run(chained, spark.createDataFrame([r for s in steps[3:] for r in s] + late, SCHEMA), strict)
    names = [*COLUMNS, "valid_from", "valid_to"]
    assert bag(chained.open, *names) == bag(folded.open, *names)
    assert bag(chained.closed, *names) == bag(folded.closed, *names)
    assert bag(chained.rejects, "reason", "rowData") == bag(folded.rejects, "reason", "rowData")


def test_chains_of_copies_and_of_nothing(spark):
    rows = [(1, at(0), "a", 0)] * 3 + [(1, at(0), "b", 0), (1, at(9_000), "a", 1)]
    state = chain_run(None, spark.createDataFrame(rows, SCHEMA), DIMENSION)
    assert bag(state.rejects, "reason") == Counter({("DUPLICATE_IN_MICRO_BATCH",): 3, ("DUPLICATE_RECORD_OPEN",): 1})
    assert state.open.count() == 1 and state.closed.count() == 0
    empty = chain_run(state, spark.createDataFrame([], SCHEMA), DIMENSION)
    assert bag(empty.open, *COLUMNS) == bag(state.open, *COLUMNS)
    assert empty.rejects.count() == state.rejects.count()
    quiet = Dimension(["id"], "at", ignore=["note"], reject_open_duplicates=False)
    assert chain_run(None, spark.createDataFrame(rows, SCHEMA), quiet).rejects.count() == 3


# Facts as of their time

VERSIONS = "k long, part string, valid_from timestamp_ntz, valid_to timestamp_ntz, value string"
DAY = 86_400_000_000


def facts_and_versions():
    versions = [(k, "p", at(DAY * i * (k + 1)), at(DAY * (i + 1) * (k + 1)) - MILLI, f"v{i}") for k in range(3) for i in range(4)]
    versions += [(7, "p", at(0), OPEN, "open"), (8, "p", at(5), at(5), "one moment"), (9, "p", None, OPEN, "no begin"), (9, "p", at(9), at(3), "inverted"), (None, "p", at(0), OPEN, "no key")]
    versions += [(10, "p", at(i * 1_000), at((i + 1) * 1_000) - MILLI, f"m{i}") for i in range(30)]
    facts = [(k, "p", at(t)) for k in (0, 1, 2, 7, 8, 9, 10, 11, None) for t in (-1, 0, 5, 999, 1_004, 2_500, 29_999, DAY - 1, DAY, 3 * DAY, 50 * DAY, 4_000 * DAY)]
    return facts + [(7, "p", None), (7, "other", at(3)), *facts[:5]], versions


def matched(facts, versions):
    out = []
    for k, part, when in facts:
        hits = [v for v in versions if None not in (k, when, v[2]) and v[0] == k and v[1] == part and v[2] <= v[3] and v[2] <= when < v[3] + MILLI]
        out += [(k, part, when, v[4]) for v in hits] or [(k, part, when, None)]
    return Counter(out)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_facts_meet_the_version_of_their_time(spark, how):
    facts, versions = facts_and_versions()
    left = spark.createDataFrame(facts, "k long, part string, seen timestamp_ntz")
    right = spark.createDataFrame(versions, VERSIONS)
    joined = as_of_join(left, right, ["k", ("part", "part")], "seen", how=how)
    expected = matched(facts, versions)
    if how == "inner":
        expected = Counter({row: n for row, n in expected.items() if row[3] is not None})
    assert bag(joined, "k", "part", "seen", "version_value") == expected


def test_clocks_with_and_without_a_zone(spark):
    facts, versions = facts_and_versions()
    left = spark.createDataFrame(facts, "k long, part string, seen timestamp_ntz").withColumn("seen", F.col("seen").cast("timestamp"))
    right = spark.createDataFrame(versions, VERSIONS)
    zoned = right.withColumns({n: F.col(n).cast("timestamp") for n in ("valid_from", "valid_to")})
    for side in (right, zoned):
        joined = as_of_join(left, side, ["k", "part"], "seen").withColumn("seen", F.col("seen").cast("timestamp_ntz"))
        assert bag(joined, "k", "part", "seen", "version_value") == matched(facts, versions)


def test_empty_sides(spark):
    facts, versions = facts_and_versions()
    left, right = spark.createDataFrame(facts, "k long, part string, seen timestamp_ntz"), spark.createDataFrame(versions, VERSIONS)
    assert as_of_join(left.limit(0), right, ["k"], "seen").count() == 0
    assert as_of_join(left, right.limit(0), ["k"], "seen").where("version_value IS NULL").count() == len(facts)
    with pytest.raises(ValueError, match="begin with"):
        as_of_join(left.withColumn("version_x", F.lit(1)), right, ["k"], "seen")


def test_a_hot_key_is_split_and_no_pairs_are_compared(spark):
    """Half of the facts have one key; the join has equalities alone, and adaptive execution splits the key."""
    facts = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), (F.lit(START) + F.make_dt_interval(secs=F.col("id") % 5_000)).alias("seen"), F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    # Open to the end, so all facts of a key look into one bucket of its width.
    versions = spark.range(400).select((F.col("id") % 400).alias("k"), F.lit(START).alias("valid_from"), F.lit(OPEN).alias("valid_to"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before_ = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = as_of_join(facts, versions, ["k"], "seen", how="inner")
        assert joined.count() > 90_000
        plan = joined._jdf.queryExecution().executedPlan()
        joined.collect()
        text = plan.toString()
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "skew=true" in text
    finally:
        for k, v in before_.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("beside", [0, 1, 4])
def test_how_many_versions_are_few_does_not_show(spark, how, beside):
    """Keys with more versions than that go through buckets, the others not; overlaps and copies of versions give a row each."""
    facts, versions = facts_and_versions()
    versions += [(1, "p", at(0), at(3 * DAY), "overlap"), (1, "p", at(0), at(3 * DAY), "overlap"), (7, "p", at(0), OPEN, "open too"), (0, "p", at(-3_000 * DAY), OPEN, "long")]
    left = spark.createDataFrame(facts, "k long, part string, seen timestamp_ntz").withColumn("k.k", F.col("k"))
    right = spark.createDataFrame(versions, VERSIONS)
    expected = Counter({row: n for row, n in matched(facts, versions).items() if how == "left" or row[3] is not None})
    for key in ("long", "int", "string"):
        side = right.withColumn("k", F.col("k").cast(key))
        joined = as_of_join(left, side, [("k.k", "k"), "part"], "seen", how=how, beside=beside)
        assert joined.columns == ["k", "part", "seen", "k.k", *[f"version_{n}" for n in right.columns]]
        assert bag(joined, "k", "part", "seen", "version_value") == expected


def test_texts_that_are_one_number_are_one_key(spark):
    left = spark.createDataFrame([(1, at(5)), (2, at(5))], "k long, seen timestamp_ntz")
    right = spark.createDataFrame([("1", at(0), OPEN, "a"), ("1", at(0), at(9_000), "b"), ("01", at(0), OPEN, "c")], "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, value string")
    for beside in (0, 1, 64):
        joined = as_of_join(left, right, ["k"], "seen", beside=beside)
        assert bag(joined, "k", "version_value") == Counter([(1, "a"), (1, "b"), (1, "c"), (2, None)])


@pytest.mark.parametrize("how", ["left", "inner"])
def test_facts_and_versions_of_keys_with_few_versions_are_shuffled_once(spark, how):
    """Whatever lengths the versions have: no row is repeated for buckets, and what a caller leaves out is not moved."""
    facts = spark.range(2_000).select((F.col("id") % 100).alias("k"), (F.lit(START) + F.make_dt_interval(days=F.col("id") % 900)).alias("seen"))
    begin = F.lit(START) + F.make_dt_interval(days=F.pow(F.lit(3), F.floor(F.col("id") / 100)).cast("int"))
    end = F.lit(START) + F.make_dt_interval(days=F.pow(F.lit(3), F.floor(F.col("id") / 100) + 1).cast("int"))
    versions = spark.range(600).select((F.col("id") % 100).alias("k"), begin.alias("valid_from"), (end - F.expr("INTERVAL '0.001' SECOND")).alias("valid_to"), F.lit("much").alias("payload"), F.col("id").alias("n"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = as_of_join(facts, versions, ["k"], "seen", how=how).select("k", "seen", "version_n")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 2 and "Generate" not in text and "payload" not in text
        # Of the first 900 days all but the first of each round lie in a version.
        assert joined.where("version_n IS NOT NULL").count() == facts.where(F.col("seen") >= F.lit(START) + F.expr("INTERVAL '1' DAY")).where(F.col("seen") < F.lit(START) + F.expr("INTERVAL '729' DAY")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_version_lies_in_two_buckets_or_is_short(spark):
    from pyspark.sql import types as T

    from chronotable.operators.asof import _span_buckets

    rows = [(i, at(977_777 * i), at(977_777 * i + 10**j)) for i in range(0, 9_000, 500) for j in range(3, 16)]
    spans = _span_buckets(spark.createDataFrame(rows, "k long, valid_from timestamp_ntz, valid_to timestamp_ntz"), "valid_from", "valid_to", T.TimestampNTZType())
    copies = spans.groupBy("valid_from", "valid_to").count()
    assert copies.where("count > 2 AND valid_to - valid_from >= INTERVAL '7' SECOND").isEmpty()
    assert copies.where("count > 9").isEmpty()


def test_a_hot_key_with_many_versions_goes_through_buckets(spark):
    """Half of the facts and most versions have one key; nothing joins by that key alone."""
    facts = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), (F.lit(START) + F.make_dt_interval(secs=F.col("id") % 5_000)).alias("seen"))
    begin = F.lit(START) + F.make_dt_interval(secs=F.col("id") * 10)
    versions = spark.range(500).select(F.lit(0).cast("long").alias("k"), begin.alias("valid_from"), (begin + F.expr("INTERVAL '9.999' SECOND")).alias("valid_to"))
    versions = versions.unionByName(versions.limit(1).withColumn("k", F.lit(1).cast("long")))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = as_of_join(facts, versions, ["k"], "seen")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text and "__bucket" in text
        assert joined.count() == 20_000 and joined.where("version_valid_from IS NOT NULL AND k = 0").count() == 10_000
        assert joined.where("k = 0 AND NOT seen BETWEEN version_valid_from AND version_valid_to").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_history_writes_no_texts_of_points(spark, monkeypatch):
    from chronotable.plans import timeline

    written = []
    keep = timeline.materialize
    monkeypatch.setattr(timeline, "materialize", lambda rows: written.append(rows.columns) or keep(rows))
    history = history_run(None, spark.createDataFrame([(1, at(0), "a", 0)], SCHEMA), DIMENSION)
    assert history.open.count() == 1 and written and not any("__point" in names for names in written)


@pytest.mark.parametrize("run", [history_run, chain_run])
def test_a_null_moment_is_found_before_several_stages_meet_it(spark, run, monkeypatch):
    from chronotable.plans import timeline

    def late(*_):
        raise AssertionError("the null came as far as a join of stages")

    monkeypatch.setattr(timeline, "materialize", late)
    with pytest.raises(PySparkException, match="needs a valid_from"):
        run(None, spark.createDataFrame([(1, at(0), "a", 0), (1, None, "a", 0)], SCHEMA).repartition(4), DIMENSION)
