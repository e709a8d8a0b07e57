"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronotable.functions.columns import col
from chronotable.workloads import columns, dimension, merges, paths, tables

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (columns, tables, dimension, merges, paths)

_ONE = ("valid_to",)
_BOTH = ("left_valid_to", "right_valid_to")

# Columns that hold the open end, year 9999. Registered queries show them as text, because clients
# that count nanoseconds cannot hold such a timestamp. The operators themselves keep timestamps.
_OPEN_ENDS = {
    "add_validity": _ONE,
    "prefix_round_trip": _ONE,
    "restrict_existing": _ONE,
    "left_join_prefixed": _BOTH,
    "new_keys": _BOTH,
    "known_keys": _BOTH,
    "unchanged_rows": _BOTH,
    "classify_changes": _BOTH,
    "classify_restricted": _BOTH,
    "union_classified": _BOTH,
    "split_by_status": _BOTH,
    "open_delta": _ONE,
    "scd2_open": _ONE,
    "scd2_two_batches_open": _ONE,
    "scd2_events_open": _ONE,
    "scd2_late_insert": _ONE,
    "scd2_chain": _ONE,
    "store_open": _ONE,
    "stream_open": _ONE,
    "scd1_upsert": _ONE,
    "scd1_into_table": _ONE,
    "merge_upsert_row_key": _ONE,
    "merge_upsert_unique": _ONE,
}


def _shown(name: str, query: Query) -> Query:
    ends = _OPEN_ENDS.get(name)
    if ends is None:
        return query

    def with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(spark, sf_dir).withColumns({n: col(n).cast("string") for n in ends})

    return with_text


def _shown_sql(name: str, sql: str) -> str:
    ends = _OPEN_ENDS.get(name)
    if ends is None:
        return sql
    texts = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in ends)
    return f"SELECT * REPLACE ({texts}) FROM ({sql})"


QUERIES = {n: _shown(n, query) for module in _MODULES for n, query in module.QUERIES.items()}
SQL = {n: _shown_sql(n, sql) for module in _MODULES for n, sql in module.SQL.items()}
