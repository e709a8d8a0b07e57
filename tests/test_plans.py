"""What the physical plans must and must not contain."""

import re

import pytest

from chronotable.operators.dedup import deduplicate, duplicates
from chronotable.operators.merge import Merge, upsert
from chronotable.plans.scd2 import classified_batch, scd2_run
from chronotable.workloads import QUERIES
from chronotable.workloads.recipes import order_batches, order_dimension

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan that ran, of which only the last version is shown."""
    run = df.select("*")
    run.collect()
    return plan(run).split("\n+- == Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search("Python|Pandas|MapPartitions|ArrowEval", text)
    assert not re.search("CartesianProduct|NestedLoopJoin", text)


def enriched(spark):
    return order_dimension().enrich(order_batches(spark, SF)[1])


def test_kept_rows_are_limited_before_the_shuffle(spark):
    text = plan(deduplicate(enriched(spark), ["o_orderdate"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text)


def test_hot_duplicates_are_ranked_per_salt(spark):
    text = plan(duplicates(enriched(spark), ["o_orderdate"]))
    assert re.search(r"Exchange hashpartitioning\(row_key#\d+, __salt#\d+, 8\)", text)
    # The only broadcast is that of the counted keys, which read no more than the key columns.
    broadcasts = re.findall(r"BroadcastExchange.*\n(?:.*\n)??.*Filter \(\(count#\d+L > 100000\)", text)
    assert len(broadcasts) == text.count("BroadcastExchange") > 0
    assert re.search(r"FileScan parquet \[o_custkey#\d+L?(,o_orderdate#\d+)?\]", text)


def test_classification_shuffles_each_side_once(spark, no_broadcast):
    dimension = order_dimension()
    early, late = order_batches(spark, SF)
    existing = dimension.open_rows(deduplicate(dimension.enrich(early), dimension.ordering))
    classified = classified_batch(existing, dimension.enrich(late), dimension)
    classified.collect()
    final = plan(classified).split("\n+- == Initial Plan ==")[0]
    shuffles = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
    assert len([s for s in shuffles if "Reused" not in s]) == 2


def test_a_small_batch_does_not_move_the_open_table(spark):
    dimension = order_dimension()
    early, late = order_batches(spark, SF)
    existing = dimension.open_rows(dimension.enrich(early))
    delta = existing.limit(5)
    done = upsert(existing, delta, ["row_key"], source_unique=True)
    text = plan(done)
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text
    merged = Merge(existing).using(delta).on_keys(["row_key"], source_unique=True)
    assert "Exchange hashpartitioning" not in plan(merged.when_matched().update_all().result())


def test_filters_and_columns_reach_the_scan(spark):
    early = order_batches(spark, SF)[0].select("o_custkey")
    text = plan(early)
    assert re.search(r"PushedFilters: \[.*LessThan\(o_orderdate", text)
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>", text)


def test_null_key_history_is_one_join(spark, no_broadcast):
    text = final_plan(QUERIES["scd2_null_key_merge"](spark, SF))
    # The other join is the check for two open versions, in a subquery on keys alone.
    assert len(re.findall("SortMergeJoin.*, LeftOuter", text)) == 1


def test_a_run_reads_its_batch_once(spark):
    """Rows kept and rows refused both come from the marked batch that was written."""
    dimension = order_dimension()
    early, late = order_batches(spark, SF)
    state = scd2_run(scd2_run(None, early, dimension), late, dimension)
    assert "orders.parquet" not in plan(state.rejects) + plan(state.open) + plan(state.closed)


def test_merge_looks_at_the_target_for_competitors_only_if_a_source_key_repeats(spark, no_broadcast):
    target = spark.range(100).selectExpr("id", "id AS v")
    unique = Merge(target).using(target.where("id > 50")).on_keys(["id"]).when_matched().update_all().result()
    text = final_plan(unique)
    assert "Subquery" not in text
    assert text.count("SortMergeJoin") == 1
    twice = target.unionByName(target)
    contested = Merge(target).using(twice).on_keys(["id"]).when_matched().update_all().result()
    assert "Subquery" in plan(contested)
