"""Queries over the projection, fingerprint and check operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotable.functions import (
    concat_values,
    md5_of,
    one_milli_before,
    row_key,
    row_md5,
)
from chronotable.operators.checks import assert_non_null
from chronotable.operators.columns import (
    add_validity,
    prefix_columns,
    select_prefix,
    strip_prefix,
)
from chronotable.sources.readers import normalize
from chronotable.workloads.recipes import (
    PARTY,
    PARTY_SCD_SQL,
    party_batch,
    party_incoming,
    read,
    sql_md5,
    sql_milli_before,
    sql_timestamp,
    validity_sql,
)


def lowercase_cast(spark: SparkSession, sf: str) -> DataFrame:
    customer = read(spark, sf, "customer")
    shouted = customer.toDF(*[n.upper() for n in customer.columns])
    return normalize(shouted, {"c_nationkey": "string"})


def enrich_scd(spark: SparkSession, sf: str) -> DataFrame:
    return PARTY.enrich(party_batch(spark, sf))


def lineitem_row_md5(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return rows.select(*keys, row_md5(rows, [*keys, "not_there"]).alias("row_md5"))


def order_row_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "orders")
    # The order of the key list does not matter: the frame's order is used.
    key = row_key(rows, ["o_orderdate", "o_custkey"])
    return rows.select("o_orderkey", key.alias("row_key"))


def hash_all_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "documents")
    return rows.select("doc_id", md5_of(rows).alias("row_md5"))


def add_validity_columns(spark: SparkSession, sf: str) -> DataFrame:
    return add_validity(read(spark, sf, "orders"), "o_orderdate")


def prefixed(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_columns(read(spark, sf, "part"), "left_")


def selected(spark: SparkSession, sf: str) -> DataFrame:
    return select_prefix(read(spark, sf, "orders"), "o_order")


def selected_plus(spark: SparkSession, sf: str) -> DataFrame:
    return select_prefix(read(spark, sf, "orders"), "o_order", "o_custkey")


def stripped(spark: SparkSession, sf: str) -> DataFrame:
    return strip_prefix(read(spark, sf, "supplier"), "s_")


def non_null(spark: SparkSession, sf: str) -> DataFrame:
    return assert_non_null(read(spark, sf, "lineitem"))


def render_values(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "events").select(
        "event_id",
        "ts",
        F.nullif(F.col("event_type"), F.lit("view")).alias("kind"),
        "props",
        (F.col("user_id") > 10).alias("late_user"),
        F.to_date("ts").alias("day"),
        "value",
        F.col("value").cast("decimal(18,4)").alias("exact"),
    )
    text = concat_values(rows, rows.columns, sep="|")
    return rows.select("event_id", text.alias("row_text"))


def close_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "events")
    ended = one_milli_before(F.col("ts"), rows.schema["ts"].dataType)
    return rows.select("event_id", ended.alias("valid_to"))


def left_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Prefix on, prefix off: the way a row takes through the classify join."""
    there = prefix_columns(party_incoming(spark, sf), "left_")
    return strip_prefix(select_prefix(there, "left_"), "left_")


QUERIES = {
    "lowercase_cast": lowercase_cast,
    "enrich_scd": enrich_scd,
    "row_md5": lineitem_row_md5,
    "row_key": order_row_key,
    "hash_all_columns": hash_all_columns,
    "add_validity": add_validity_columns,
    "prefix_columns": prefixed,
    "select_prefix": selected,
    "select_prefix_plus": selected_plus,
    "strip_prefix": stripped,
    "prefix_round_trip": left_columns,
    "assert_non_null": non_null,
    "render_values": render_values,
    "close_timestamp": close_timestamp,
}

_PART = "p_partkey p_name p_brand p_type p_size p_retailprice".split()

SQL = {
    "lowercase_cast": """
        SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal,
               c_mktsegment
        FROM customer""",
    "enrich_scd": f"WITH {PARTY_SCD_SQL} SELECT * FROM batch",
    "row_md5": f"""
        SELECT l_orderkey, l_linenumber,
               md5(CAST(l_partkey AS VARCHAR) || CAST(l_suppkey AS VARCHAR)
                   || CAST(l_quantity AS VARCHAR) || CAST(l_extendedprice AS VARCHAR)
                   || CAST(l_discount AS VARCHAR) || CAST(l_tax AS VARCHAR) || l_returnflag
                   || l_linestatus || {sql_timestamp('l_shipdate')}) AS row_md5
        FROM lineitem""",
    "row_key": f"""
        SELECT o_orderkey,
               md5(CAST(o_custkey AS VARCHAR) || {sql_timestamp('o_orderdate')}) AS row_key
        FROM orders""",
    "hash_all_columns": f"""
        SELECT doc_id, {sql_md5('doc_id', 'text', 'lang', 'source', 'n_chars')} AS row_md5
        FROM documents""",
    "add_validity": f"""
        SELECT *, {validity_sql('o_orderdate')}
        FROM orders""",
    "prefix_columns": f"SELECT {', '.join(f'{c} AS left_{c}' for c in _PART)} FROM part",
    "select_prefix": """
        SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders""",
    "select_prefix_plus": """
        SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority, o_custkey FROM orders""",
    "strip_prefix": """
        SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey,
               s_acctbal AS acctbal
        FROM supplier""",
    "prefix_round_trip": f"WITH {PARTY_SCD_SQL} SELECT * FROM changes",
    "assert_non_null": "SELECT * FROM lineitem",
    "render_values": f"""
        SELECT event_id,
               CAST(event_id AS VARCHAR) || '|' || {sql_timestamp('ts')} || '|'
               || coalesce(nullif(event_type, 'view'), 'null') || '|' || props || '|'
               || CASE WHEN user_id > 10 THEN 'true' ELSE 'false' END || '|'
               || CAST(CAST(ts AS DATE) AS VARCHAR) || '|' || CAST(value AS VARCHAR) || '|'
               || CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) AS row_text
        FROM events""",
    "close_timestamp": f"""
        SELECT event_id, {sql_milli_before('ts')} AS valid_to FROM events""",
}
