"""Dimensions and batches made from the given tables, in Spark and in SQL.

``party`` is one dimension of all customers and suppliers: the base holds every customer, the next
batch every customer again (with a new segment in some nations), every supplier as a new member,
and exact copies of one segment's rows. ``events`` is the latest event of every user, fed in three
date ranges that cover the table. ``orders`` is the latest order of every customer, fed in two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotable.plans.spec import Dimension


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# Parties

BASE_TS, BATCH_TS = "2024-01-01 00:00:00", "2024-02-01 00:00:00.123456"
PARTY = Dimension(keys=["kind", "party_id"], valid_from="update_ts")
PARTY_COLUMNS = "kind, party_id, name, nation, segment, balance, update_ts"


def _party(
    df: DataFrame, kind: str, prefix: str, key: str, segment: Column, ts: str
) -> DataFrame:
    return df.select(
        F.lit(kind).alias("kind"),
        F.col(key).alias("party_id"),
        F.col(f"{prefix}_name").alias("name"),
        F.col(f"{prefix}_nationkey").alias("nation"),
        segment.alias("segment"),
        F.col(f"{prefix}_acctbal").alias("balance"),
        _ts(ts).alias("update_ts"),
    )


def party_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    return _party(customer, "C", "c", "c_custkey", F.col("c_mktsegment"), BASE_TS)


def party_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer and every supplier, once."""
    segment = F.when(F.col("c_nationkey") < 5, "CHANGED").otherwise(F.col("c_mktsegment"))
    customer, supplier = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    return _party(customer, "C", "c", "c_custkey", segment, BATCH_TS).unionByName(
        _party(supplier, "S", "s", "s_suppkey", F.lit("SUPPLIER"), BATCH_TS)
    )


def party_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes, and exact copies of some of them."""
    changes = party_changes(spark, sf_dir)
    return changes.unionByName(changes.where(F.col("segment") == "MACHINERY"))


def party_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base as open rows."""
    return PARTY.open_rows(PARTY.enrich(party_base(spark, sf_dir)))


def party_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes as they would be opened."""
    return PARTY.open_rows(PARTY.enrich(party_changes(spark, sf_dir)))


def sql_md5(*columns: str) -> str:
    """MD5 over columns, in order; timestamps must come through ``sql_timestamp``."""
    texts = [f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in columns]
    return f"md5({' || '.join(texts)})"


def sql_timestamp(column: str) -> str:
    """Timestamp text with at least one digit after the point."""
    text = f"CAST({column} AS VARCHAR)"
    return f"(CASE WHEN contains({text}, '.') THEN {text} ELSE {text} || '.0' END)"


def sql_milli_before(column: str) -> str:
    """The millisecond before; ``epoch_ms`` would not do, as it rounds instead of truncating."""
    return f"date_trunc('milliseconds', {column}) - INTERVAL 1 MILLISECOND"


PARTY_SQL = f"""
base_raw AS (
  SELECT 'C' AS kind, c_custkey AS party_id, c_name AS name, c_nationkey AS nation,
         c_mktsegment AS segment, c_acctbal AS balance, TIMESTAMP '{BASE_TS}' AS update_ts
  FROM customer),
changes_raw AS (
  SELECT 'C' AS kind, c_custkey AS party_id, c_name AS name, c_nationkey AS nation,
         CASE WHEN c_nationkey < 5 THEN 'CHANGED' ELSE c_mktsegment END AS segment,
         c_acctbal AS balance, TIMESTAMP '{BATCH_TS}' AS update_ts
  FROM customer
  UNION ALL
  SELECT 'S', s_suppkey, s_name, s_nationkey, 'SUPPLIER', s_acctbal, TIMESTAMP '{BATCH_TS}'
  FROM supplier),
batch_raw AS (
  SELECT * FROM changes_raw
  UNION ALL SELECT * FROM changes_raw WHERE segment = 'MACHINERY')
"""


def _party_fingerprints(source: str) -> str:
    return f"""SELECT *, {sql_md5('name', 'nation', 'segment', 'balance')} AS row_md5,
  {sql_md5('kind', 'party_id')} AS row_key FROM {source}"""


def validity_sql(column: str) -> str:
    return f"""{column} AS valid_from, TIMESTAMP '9999-12-31 00:00:00' AS valid_to,
  'NA' AS delete_indicator"""


PARTY_SCD_SQL = f"""{PARTY_SQL},
base_open AS (
  SELECT *, {validity_sql('update_ts')} FROM ({_party_fingerprints('base_raw')})),
batch AS ({_party_fingerprints('batch_raw')}),
changes AS (
  SELECT *, {validity_sql('update_ts')} FROM ({_party_fingerprints('changes_raw')})),
marked AS (
  SELECT *, row_number() OVER (
    PARTITION BY row_key
    ORDER BY update_ts, kind, party_id, name, nation, segment, balance, row_md5) AS rn
  FROM batch),
incoming AS (
  SELECT * EXCLUDE (rn), {validity_sql('update_ts')} FROM marked WHERE rn = 1)
"""


# Latest event of every user

EVENTS = Dimension(keys=["user_id"], valid_from="ts", ignore=["event_id"])
EVENT_CUTS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events")


def event_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows, (first, second) = events(spark, sf_dir), EVENT_CUTS
    ts = F.col("ts")
    return [
        rows.where(ts < _ts(first)),
        rows.where((ts >= _ts(first)) & (ts < _ts(second))),
        rows.where(ts >= _ts(second)),
    ]


_EVENT_CTE = f"""
enriched AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         {sql_md5('event_type', 'value', 'props')} AS row_md5, {sql_md5('user_id')} AS row_key,
         CASE WHEN ts < TIMESTAMP '{EVENT_CUTS[0]}' THEN 1
              WHEN ts < TIMESTAMP '{EVENT_CUTS[1]}' THEN 2 ELSE 3 END AS batch_no
  FROM events),
marked AS (
  SELECT *, row_number() OVER (
    PARTITION BY batch_no, row_key ORDER BY ts, event_id, user_id, event_type, value, props) AS rn
  FROM enriched),
kept AS (SELECT *, {validity_sql('ts')} FROM marked WHERE rn = 1),
"""


def _event_step(n: int, before: str) -> str:
    """CTEs that take batch ``n`` to the open rows after it, and what it closed and refused."""
    names = "event_id, ts, user_id, event_type, value, props, row_md5, row_key"
    ends = "valid_from, valid_to, delete_indicator"
    both = f"kept k JOIN {before} o USING (row_key)"
    old = ", ".join(f"o.{c.strip()}" for c in names.split(",") if c.strip() != "row_key")
    return f"""
closed{n} AS (
  SELECT {old}, row_key, o.valid_from, {sql_milli_before('k.valid_from')} AS valid_to,
         o.delete_indicator
  FROM {both} WHERE k.batch_no = {n} AND k.row_md5 <> o.row_md5),
same{n} AS (
  SELECT k.* FROM {both} WHERE k.batch_no = {n} AND k.row_md5 = o.row_md5),
open{n} AS (
  SELECT {names}, {ends} FROM kept
  WHERE batch_no = {n} AND row_key NOT IN (SELECT row_key FROM same{n})
  UNION ALL
  SELECT {names}, {ends} FROM {before}
  WHERE row_key NOT IN (SELECT row_key FROM kept WHERE batch_no = {n})
     OR row_key IN (SELECT row_key FROM same{n}))"""


LATE_EVENTS_SQL = f"""{_EVENT_CTE}
paired AS (
  SELECT k.*, o.row_key AS known, o.row_md5 = k.row_md5 AS same
  FROM (SELECT * FROM kept WHERE batch_no = 1) k
  LEFT JOIN (SELECT * FROM kept WHERE batch_no = 2) o ON k.row_key = o.row_key)"""


EVENTS_SQL = (
    _EVENT_CTE
    + "open0 AS (SELECT * EXCLUDE (batch_no, rn) FROM kept WHERE false),"
    + ",".join(_event_step(n, f"open{n - 1}") for n in (1, 2, 3))
)


# Orders of every customer: the newest of a batch counts

ORDER_CUT = "1996-01-01 00:00:00"


def order_dimension() -> Dimension:
    return Dimension(
        keys=["o_custkey"],
        valid_from="o_orderdate",
        ignore=["o_orderkey"],
        order_by=[F.desc("o_orderdate"), "o_orderkey"],
    )


def order_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = read(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < _ts(ORDER_CUT)
    return [rows.where(early), rows.where(~early)]


ORDERS_SQL = f"""
enriched AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         {sql_md5('o_orderstatus', 'o_totalprice', 'o_orderpriority')} AS row_md5,
         {sql_md5('o_custkey')} AS row_key,
         CASE WHEN o_orderdate < TIMESTAMP '{ORDER_CUT}' THEN 1 ELSE 2 END AS batch_no
  FROM orders),
marked AS (
  SELECT *, row_number() OVER (
    PARTITION BY batch_no, row_key ORDER BY o_orderdate DESC, o_orderkey) AS rn
  FROM enriched),
kept AS (
  SELECT * EXCLUDE (rn), {validity_sql('o_orderdate')} FROM marked WHERE rn = 1),
compared AS (
  SELECT k.*, o.row_key AS known, o.row_md5 = k.row_md5 AS same
  FROM (SELECT * FROM kept WHERE batch_no = 2) k
  LEFT JOIN (SELECT * FROM kept WHERE batch_no = 1) o ON k.row_key = o.row_key)
"""


# Versions from all observations, whatever their order


def _timeline(keys: str, payload: str, moment: str, columns: str, table: str) -> str:
    """CTEs: one row of each key and moment, which of them start a version, and the versions."""
    return f"""
observed AS (
  SELECT {columns}, {sql_md5(*[c.strip() for c in payload.split(',')])} AS row_md5, {sql_md5(keys)} AS row_key FROM {table}),
moments AS (
  SELECT *, row_number() OVER (PARTITION BY row_key, {moment} ORDER BY {columns}) AS place FROM observed),
points AS (
  SELECT * EXCLUDE (place),
         lag(row_md5) OVER (PARTITION BY row_key ORDER BY {moment}) IS DISTINCT FROM row_md5 AS starts
  FROM moments WHERE place = 1),
versions AS (
  SELECT * EXCLUDE (starts), {moment} AS valid_from, 'NA' AS delete_indicator,
         lead({moment}) OVER (PARTITION BY row_key ORDER BY {moment}) AS following,
         CASE WHEN following IS NULL THEN TIMESTAMP '9999-12-31 00:00:00' ELSE greatest({sql_milli_before('following')}, {moment}) END AS valid_to
  FROM points WHERE starts)"""


# What a user did last: values and details do not count, so many events say nothing new.
STEPS = Dimension(keys=["user_id"], valid_from="ts", ignore=["event_id", "value", "props"])
TIMELINE_SQL = _timeline("user_id", "event_type", "ts", "event_id, ts, user_id, event_type, value, props", "events")

ORDER_HISTORY = Dimension(keys=["o_custkey"], valid_from="o_orderdate", ignore=["o_orderkey"])
ORDER_TIMELINE_SQL = _timeline(
    "o_custkey", "o_orderstatus, o_totalprice, o_orderpriority", "o_orderdate", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority", "orders"
)
