import datetime
import hashlib
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronotable.operators.classify import (
    classify_changes,
    classify_restricted,
    closed_rows,
    known_keys,
    new_keys,
    open_delta,
    open_duplicates,
    restrict_existing,
)
from chronotable.operators.status import Status
from chronotable.plans.scd1 import scd1_upsert
from chronotable.plans.scd2 import State, incoming_rows, scd2_changes, scd2_fold, scd2_run
from chronotable.plans.spec import Dimension

SCHEMA = "id string, name string, update_ts timestamp, address string, tax string"
DIMENSION = Dimension(keys=["id", "name"], valid_from="update_ts")
END = datetime.datetime(9999, 12, 31)


def day(year, month=1, date=1):
    return datetime.datetime(year, month, date)


def before(moment):
    return moment - datetime.timedelta(milliseconds=1)


# Three batches that meet every outcome: an in-batch copy, an unchanged row, a change at the very
# time the open row began (its interval ends before it starts), a later change, and new keys.
BATCHES = [
    [
        ("1", "Nora", day(2021), "12 Hill Rd", "T1"),
        ("2", "Omar", day(2021), "9 Lake St", "T2"),
    ],
    [
        ("1", "Nora", day(2021), "12 Hill Rd", "T1"),
        ("1", "Nora", day(2021), "12 Hill Rd", "T1"),
        ("2", "Omar", day(2021), "9 Lake St", "T2b"),
        ("3", "Pia", day(2022, 1, 5), "9 Lake St", "T3"),
        ("4", "Quin", day(2021), "9 Lake St", "T4"),
    ],
    [
        ("3", "Pia", day(2022, 1, 5), "9 Lake St", "T3"),
        ("4", "Quin", day(2021, 3, 1), "9 Lake St", "T4b"),
        ("5", "Rolf", day(2021), "9 Lake St", "T4"),
    ],
]

OPEN = {
    ("1", "Nora", "T1", day(2021), END),
    ("2", "Omar", "T2b", day(2021), END),
    ("3", "Pia", "T3", day(2022, 1, 5), END),
    ("4", "Quin", "T4b", day(2021, 3, 1), END),
    ("5", "Rolf", "T4", day(2021), END),
}
CLOSED = {
    ("2", "Omar", "T2", day(2021), before(day(2021))),
    ("4", "Quin", "T4", day(2021), before(day(2021, 3, 1))),
}
REASONS = Counter({"DUPLICATE_IN_MICRO_BATCH": 1, "DUPLICATE_RECORD_OPEN": 2})


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def versions(df):
    rows = [(r.id, r.name, r.tax, r.valid_from, r.valid_to) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def reasons(df):
    return Counter(r.reason for r in df.collect())


@pytest.fixture(scope="module")
def batches(spark):
    return [spark.createDataFrame(rows, SCHEMA) for rows in BATCHES]


@pytest.fixture(scope="module")
def after(batches):
    return scd2_fold(batches, DIMENSION)


def test_three_batches(after):
    assert versions(after.open) == OPEN
    assert versions(after.closed) == CLOSED
    assert reasons(after.rejects) == REASONS


def test_columns_and_fingerprints(after):
    assert after.open.columns == [
        "id", "name", "update_ts", "address", "tax",
        "row_md5", "row_key", "valid_from", "valid_to", "delete_indicator",
    ]
    assert after.closed.columns == after.open.columns
    row = after.open.where("id = '2'").first()
    assert row.row_key == md5("2Omar")
    assert row.row_md5 == md5("9 Lake StT2b")
    assert row.delete_indicator == "NA"


def test_reject_text(after):
    key, payload = md5("1Nora"), md5("12 Hill RdT1")
    raw = f"1,Nora,2021-01-01 00:00:00.0,12 Hill Rd,T1,{payload},{key}"
    bounds = "2021-01-01 00:00:00.0,9999-12-31 00:00:00.0,NA"
    found = {tuple(r) for r in after.rejects.where("rowData LIKE '[1,%'").collect()}
    assert found == {
        ("DUPLICATE_IN_MICRO_BATCH", f"[{raw},1]"),
        ("DUPLICATE_RECORD_OPEN", f"[{raw},{bounds},3]"),
    }


def test_replay_changes_nothing_but_rejects(after, batches):
    again = scd2_run(after, batches[2], DIMENSION)
    assert versions(again.open) == OPEN
    assert versions(again.closed) == CLOSED
    assert reasons(again.rejects) == REASONS + Counter({"DUPLICATE_RECORD_OPEN": 3})


def test_open_duplicates_can_go_unreported(after, batches):
    quiet = Dimension(["id", "name"], "update_ts", reject_open_duplicates=False)
    assert scd2_changes(after.open, batches[1], quiet).rejects.count() == 1


def test_type_one_keeps_no_history(after, batches):
    replaced = scd1_upsert(after.open, batches[1], DIMENSION)
    taxes = {(r.id, r.tax, r.valid_from) for r in replaced.collect()}
    assert taxes == {
        ("1", "T1", day(2021)),
        ("2", "T2b", day(2021)),
        ("3", "T3", day(2022, 1, 5)),
        ("4", "T4", day(2021)),
        ("5", "T4", day(2021)),
    }


def test_without_dedup(spark, after):
    as_is = Dimension(["id", "name"], "update_ts", dedup=False)
    rows = spark.createDataFrame([("8", "Tess", day(2024), "x", "y")] * 2, SCHEMA)
    ran = scd2_run(after, rows, as_is)
    assert ran.open.where("id = '8'").count() == 2
    # Two different changes of one open row cannot both be applied.
    clash = [("2", "Omar", day(2024), "x", "y"), ("2", "Omar", day(2024), "x", "z")]
    with pytest.raises(PySparkException, match="more than one source row"):
        scd2_run(after, spark.createDataFrame(clash, SCHEMA), as_is).open.collect()


def test_changed_row_needs_a_valid_from(spark, after):
    rows = spark.createDataFrame([("2", "Omar", None, "x", "y")], SCHEMA)
    with pytest.raises(PySparkException, match="needs a valid_from"):
        scd2_run(after, rows, DIMENSION).open.collect()
    # Nothing ends when the key is new, so nothing is missing.
    fresh = spark.createDataFrame([("77", "Uma", None, "x", "y")], SCHEMA)
    assert scd2_run(after, fresh, DIMENSION).open.where("id = '77'").count() == 1


def test_two_open_rows_of_one_key_are_an_error(after, batches):
    doubled = State(after.open.unionByName(after.open), after.closed, after.rejects)
    with pytest.raises(ValueError, match="the open table: more than one row"):
        scd2_run(doubled, batches[2], DIMENSION)


def test_batches_that_do_not_fit(spark, batches):
    with pytest.raises(ValueError, match="reserved"):
        scd2_run(None, batches[0].withColumn("valid_to", F.lit(1)), DIMENSION)
    with pytest.raises(ValueError, match="dimension columns"):
        scd2_run(None, batches[0].drop("update_ts"), DIMENSION)
    with pytest.raises(ValueError, match="nothing to fold"):
        scd2_fold([], DIMENSION)


def test_updated_and_closed_rows_both_carry_the_new_end(after, batches):
    incoming = incoming_rows(DIMENSION.enrich(batches[2]), DIMENSION)
    start = scd2_fold(batches[:2], DIMENSION).open
    rows = classify_changes(incoming, start).where("left_id = '4'").collect()
    assert {r.status for r in rows} == {Status.UPDATED, Status.CLOSED}
    assert {r.right_valid_to for r in rows} == {before(day(2021, 3, 1))}
    assert {r.left_valid_to for r in rows} == {END}


# Invariants on generated batches


def generated(spark, seed, partitions):
    rng = random.Random(seed)
    rows = [
        (
            str(rng.choice([1, 1, rng.randrange(60)])),
            "n",
            day(2020 + seed, 1, rng.randrange(1, 9)),
            rng.choice("ab"),
            rng.choice(["x", None]),
        )
        for _ in range(300)
    ]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_invariants(spark):
    state = scd2_run(None, generated(spark, 0, 3), DIMENSION)
    for seed in (1, 2):
        batch = generated(spark, seed, 3)
        incoming = incoming_rows(DIMENSION.enrich(batch), DIMENSION)
        outcome = classify_changes(incoming, state.open)
        counts = Counter(r.status for r in outcome.select("status").collect())
        kept = incoming.count()

        assert counts[Status.CLOSED] == counts[Status.UPDATED] > 0
        ways = counts[Status.INSERT], counts[Status.UPDATED], counts[Status.DUPLICATE_RECORD_OPEN]
        assert sum(ways) == kept
        assert bag(classify_restricted(incoming, state.open)) == bag(outcome)
        assert new_keys(incoming, state.open).count() == counts[Status.INSERT]
        assert known_keys(incoming, state.open).count() == kept - counts[Status.INSERT]
        assert closed_rows(outcome).count() == counts[Status.CLOSED]
        assert open_delta(outcome).count() == counts[Status.INSERT] + counts[Status.UPDATED]
        assert open_duplicates(outcome).count() == counts[Status.DUPLICATE_RECORD_OPEN]
        touched = restrict_existing(state.open, DIMENSION.enrich(batch))
        assert touched.count() == kept - counts[Status.INSERT]

        rejected = scd2_changes(state.open, batch, DIMENSION).rejects.count()
        assert rejected == batch.count() - kept + counts[Status.DUPLICATE_RECORD_OPEN]
        state = scd2_run(State(state.open, state.closed, state.rejects), batch, DIMENSION)
        assert state.open.count() == state.open.select("row_key").distinct().count()


def test_partitioning_does_not_matter(spark):
    results = []
    for partitions, shuffles in [(1, 1), (6, 8)]:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        batches = [generated(spark, seed, partitions) for seed in (0, 1)]
        after = scd2_fold(batches, DIMENSION)
        results.append([bag(after.open), bag(after.closed), bag(after.rejects)])
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert results[0] == results[1]
