"""Merges and runs that change a named table.

The built-in tables of the catalog know no MERGE command. The next rows of a table without partitions are written beside the old ones and the
catalog switches the table over. Of a partitioned table only the partitions that the merge touches are read
and written again. Either way a change holds only if the table still is what it was when the
change was made up; of two writers one fails.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession

from chronotable.operators.columns import ROW_KEY
from chronotable.operators.merge import Merge
from chronotable.plans.history import merge_history
from chronotable.plans.scd1 import scd1_upsert
from chronotable.plans.scd2 import incoming_rows
from chronotable.plans.spec import Dimension
from chronotable.sources.tables import (
    contents,
    day_column,
    derived_days,
    partition_columns,
    partition_key,
    replace_partitions,
    replace_rows,
    rows_in_partitions,
    with_days,
)
from chronotable.sources.workspace import scratch


def _plain(rows: DataFrame, days: list[str]) -> DataFrame:
    """Without the days that a table derives, which follow from the other columns."""
    return rows.drop(*[day_column(n) for n in days])


def merge_on(spark: SparkSession, table: str, alias: str = "target") -> Merge:
    """A merge whose target is a named table, as it is now."""
    seen = contents(spark, table)
    return Merge(_plain(spark.table(table), derived_days(spark, table)), alias, seen=seen)


def merge_into(merge: Merge, table: str) -> DataFrame:
    """Carry out a merge on the table that it was made from; returns the table.

    An error, and no change, if the table has been changed since ``merge_on``.
    """
    spark = merge.target.sparkSession
    seen = merge.seen or contents(spark, table)
    if not partition_columns(spark, table):
        return replace_rows(merge.result(), table, seen)
    return _into_partitions(merge, table, seen)


def _into_partitions(merge: Merge, table: str, seen: str) -> DataFrame:
    spark = merge.target.sparkSession
    days = derived_days(spark, table)
    key = partition_key(partition_columns(spark, table)).alias("key")
    with scratch(spark) as save:
        # The numbers of partitions that are touched come to the driver, never rows.
        old: list[str] = []
        if merge.matched:
            whole = replace(merge, target=spark.table(table))
            old = [r.key for r in whole.touched().select(key).distinct().collect()]
        held = _plain(rows_in_partitions(spark, table, old), days)
        rows = save(with_days(_merged_here(merge, held), days))
        # Rows that go to other partitions join the rows that those have.
        beside = [r.key for r in rows.select(key).distinct().collect() if r.key not in set(old)]
        if beside:
            rows = save(rows.unionByName(rows_in_partitions(spark, table, beside)))
        return replace_partitions(rows, table, old, seen)


def _merged_here(merge: Merge, held: DataFrame) -> DataFrame:
    """The merge with the touched partitions for a target.

    A source row that matches a row of the table matches one of these; so none is inserted that is there already.
    A merge that only inserts touches no row and looks for matches in the whole table.
    """
    if merge.matched:
        return replace(merge, target=held).result()
    return merge._inserted()


def scd1_into(table: str, batch: DataFrame, dimension: Dimension) -> DataFrame:
    """``scd1_upsert`` on a table of open rows."""
    spark = batch.sparkSession
    if not partition_columns(spark, table):
        seen = contents(spark, table)
        return replace_rows(scd1_upsert(spark.table(table), batch, dimension), table, seen)
    incoming = incoming_rows(dimension.enrich(batch), dimension)
    merge = merge_on(spark, table).using(incoming).on_keys([ROW_KEY], source_unique=dimension.dedup)
    return merge_into(merge.when_matched().update_all().when_not_matched().insert_all(), table)


def history_into(table: str, landing: DataFrame, key: str, as_of: Column) -> DataFrame:
    """``merge_history`` on a table of versions."""
    spark = landing.sparkSession
    seen = contents(spark, table)
    return replace_rows(merge_history(spark.table(table), landing, key, as_of), table, seen)
