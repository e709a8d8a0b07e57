"""Queries over the MERGE operator: every customer against every customer and supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotable.operators.merge import Clause, Merge, upsert
from chronotable.workloads.recipes import (
    PARTY_COLUMNS,
    PARTY_SCD_SQL,
    PARTY_SQL,
    party_base,
    party_changes,
    party_incoming,
    party_open,
    read,
)

_KEYS = ["kind", "party_id"]


def _merge(spark: SparkSession, sf: str) -> Merge:
    return Merge(party_base(spark, sf)).using(party_changes(spark, sf)).on_keys(_KEYS)


def string_condition(spark: SparkSession, sf: str) -> DataFrame:
    return (
        Merge(party_base(spark, sf), "t")
        .using(party_changes(spark, sf), "d")
        .on("t.kind = d.KIND AND t.party_id = d.party_id")
        .when_matched()
        .update_all()
        .when_not_matched()
        .insert_all()
        .result()
    )


def column_condition(spark: SparkSession, sf: str) -> DataFrame:
    """A condition that is more than equal keys: only rows that moved segment match."""
    same = (F.col("target.kind") == F.col("source.kind")) & (
        F.col("target.party_id") == F.col("source.party_id")
    )
    moved = F.col("target.segment") != F.col("source.segment")
    return (
        Merge(party_base(spark, sf))
        .using(party_changes(spark, sf))
        .on(same & moved)
        .when_matched()
        .update({"segment": F.col("source.segment")})
        .when_not_matched(F.col("source.kind") == "S")
        .insert_all()
        .result()
    )


def conditional_update(spark: SparkSession, sf: str) -> DataFrame:
    changed = "target.segment <> source.segment"
    return _merge(spark, sf).when_matched(changed).update_all().result()


def conditional_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf).when_not_matched(F.col("source.nation") < 12).insert_all().result()


def update_all(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _merge(spark, sf).when_matched().update_all().when_not_matched().insert_all().result()
    )


def update_map(spark: SparkSession, sf: str) -> DataFrame:
    values = {"segment": F.col("source.segment"), "UPDATE_TS": F.col("source.update_ts")}
    return _merge(spark, sf).when_matched().update(values).result()


def update_expr(spark: SparkSession, sf: str) -> DataFrame:
    values = {"name": "concat(target.name, '/', source.segment)", "nation": "target.nation + 100"}
    return _merge(spark, sf).when_matched().update_expr(values).result()


def delete(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with an urgent order are removed; a customer may have any number of them."""
    urgent = read(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return (
        Merge(party_base(spark, sf))
        .using(urgent)
        .on_keys([("party_id", "o_custkey")])
        .when_matched()
        .delete()
        .result()
    )


def conditional_delete(spark: SparkSession, sf: str) -> DataFrame:
    gone = F.col("source.segment") == "CHANGED"
    return _merge(spark, sf).when_matched(gone).delete().result()


def insert_all(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf).when_not_matched().insert_all().result()


def insert_map(spark: SparkSession, sf: str) -> DataFrame:
    values = {
        "kind": F.col("source.kind"),
        "party_id": F.col("source.party_id"),
        "name": F.upper(F.col("source.name")),
    }
    return _merge(spark, sf).when_not_matched().insert(values).result()


def insert_expr(spark: SparkSession, sf: str) -> DataFrame:
    values = {
        "kind": "source.kind",
        "party_id": "source.party_id",
        "segment": "lower(source.segment)",
        "update_ts": "source.update_ts",
    }
    return _merge(spark, sf).when_not_matched().insert_expr(values).result()


def first_clause_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Clauses that overlap on purpose, on both sides."""
    return (
        _merge(spark, sf)
        .when_matched("target.nation = 0")
        .update_expr({"segment": "'FIRST'"})
        .when_matched("target.nation < 3")
        .delete()
        .when_matched("target.nation < 5")
        .update_expr({"segment": "source.segment"})
        .when_not_matched("source.nation < 6")
        .insert_expr(
            {"kind": "source.kind", "party_id": "source.party_id", "segment": "'LOW'"}
        )
        .when_not_matched("source.nation < 12")
        .insert_all()
        .result()
    )


def delete_update_insert(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _merge(spark, sf)
        .when_matched("target.nation = 0")
        .delete()
        .when_matched()
        .update_expr({"segment": "source.segment"})
        .when_not_matched()
        .insert_all()
        .result()
    )


def upsert_row_key(spark: SparkSession, sf: str) -> DataFrame:
    return upsert(party_open(spark, sf), party_incoming(spark, sf))


def upsert_unique(spark: SparkSession, sf: str) -> DataFrame:
    return upsert(party_open(spark, sf), party_incoming(spark, sf), source_unique=True)


def one_call(spark: SparkSession, sf: str) -> DataFrame:
    """A whole statement in one call: target, source, condition and the clauses."""
    return Merge(
        party_base(spark, sf),
        source=party_changes(spark, sf),
        condition="target.kind = source.kind AND target.party_id = source.party_id",
        matched=(
            Clause("delete", "target.nation BETWEEN 10 AND 11"),
            Clause("update", "source.segment = 'CHANGED'", {"segment": "source.segment", "name": F.upper(F.col("target.name"))}),
            Clause("update"),
        ),
        not_matched=(Clause("insert", "source.nation < 6", {"kind": "source.kind", "party_id": "source.party_id", "name": "source.name"}), Clause("insert", "source.nation < 12")),
    ).result()


def range_condition(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against spans of order numbers, one for each customer; some spans hold no order."""
    spans = read(spark, sf, "customer").select(
        (F.col("c_custkey") * 8).alias("low_key"),
        (F.col("c_custkey") * 8 + F.col("c_custkey") % 11 - 4).alias("high_key"),
        "c_custkey",
        "c_nationkey",
    )
    return (
        Merge(read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o")
        .using(spans, "s")
        .on_range("o_orderkey", "low_key", "high_key")
        .when_matched("s.c_nationkey % 5 = 0")
        .delete()
        .when_matched()
        .update_expr({"o_custkey": "s.c_custkey", "o_orderstatus": "'M'"})
        .when_not_matched()
        .insert_expr({"o_orderkey": "-s.low_key", "o_custkey": "s.c_custkey", "o_orderstatus": "'N'"})
        .result()
    )


QUERIES = {
    "merge_range_cond": range_condition,
    "merge_string_cond": string_condition,
    "merge_column_cond": column_condition,
    "merge_conditional_update": conditional_update,
    "merge_conditional_insert": conditional_insert,
    "merge_update_all": update_all,
    "merge_update_map": update_map,
    "merge_update_expr": update_expr,
    "merge_delete": delete,
    "merge_conditional_delete": conditional_delete,
    "merge_insert_all": insert_all,
    "merge_insert_map": insert_map,
    "merge_insert_expr": insert_expr,
    "merge_first_clause_wins": first_clause_wins,
    "merge_delete_update_insert": delete_update_insert,
    "merge_upsert_row_key": upsert_row_key,
    "merge_upsert_unique": upsert_unique,
    "merge_one_call": one_call,
}

# Target rows b with their source row c, if any; and the source rows without a target row.
_B = "base_raw b LEFT JOIN changes_raw c ON b.kind = c.kind AND b.party_id = c.party_id"
_FRESH = """changes_raw c WHERE NOT EXISTS (
  SELECT 1 FROM base_raw b WHERE b.kind = c.kind AND b.party_id = c.party_id)"""
_SAME = ", ".join(f"b.{n.strip()}" for n in PARTY_COLUMNS.split(","))
_NEW = ", ".join(f"c.{n.strip()}" for n in PARTY_COLUMNS.split(","))
_UPSERT = f"""WITH {PARTY_SQL}
SELECT {_NEW} FROM base_raw b JOIN changes_raw c ON b.kind = c.kind AND b.party_id = c.party_id
UNION ALL
SELECT {_SAME} FROM {_B} WHERE c.kind IS NULL
UNION ALL
SELECT {_NEW} FROM {_FRESH}"""

_UPSERT_OPEN = f"""WITH {PARTY_SCD_SQL}
SELECT * FROM changes
UNION ALL
SELECT * FROM base_open WHERE row_key NOT IN (SELECT row_key FROM changes)"""

SQL = {
    "merge_string_cond": _UPSERT,
    "merge_column_cond": f"""WITH {PARTY_SQL}
SELECT b.kind, b.party_id, b.name, b.nation,
       CASE WHEN b.segment <> c.segment THEN c.segment ELSE b.segment END AS segment, b.balance, b.update_ts
FROM {_B}
UNION ALL
SELECT {_NEW} FROM {_FRESH} AND c.kind = 'S'""",
    "merge_conditional_update": f"""WITH {PARTY_SQL}
SELECT {_NEW} FROM {_B} WHERE b.segment <> c.segment
UNION ALL
SELECT {_SAME} FROM {_B} WHERE c.segment IS NULL OR b.segment = c.segment""",
    "merge_conditional_insert": f"""WITH {PARTY_SQL}
SELECT {_SAME} FROM base_raw b
UNION ALL
SELECT {_NEW} FROM {_FRESH} AND c.nation < 12""",
    "merge_update_all": _UPSERT,
    "merge_update_map": f"""WITH {PARTY_SQL}
SELECT b.kind, b.party_id, b.name, b.nation, coalesce(c.segment, b.segment) AS segment,
       b.balance, coalesce(c.update_ts, b.update_ts) AS update_ts
FROM {_B}""",
    "merge_update_expr": f"""WITH {PARTY_SQL}
SELECT b.kind, b.party_id,
       CASE WHEN c.kind IS NULL THEN b.name ELSE b.name || '/' || c.segment END AS name,
       CASE WHEN c.kind IS NULL THEN b.nation ELSE b.nation + 100 END AS nation,
       b.segment, b.balance, b.update_ts
FROM {_B}""",
    "merge_delete": f"""WITH {PARTY_SQL}
SELECT {_SAME} FROM base_raw b
WHERE NOT EXISTS (
  SELECT 1 FROM orders o
  WHERE o.o_custkey = b.party_id AND o.o_orderpriority = '1-URGENT')""",
    "merge_conditional_delete": f"""WITH {PARTY_SQL}
SELECT {_SAME} FROM {_B} WHERE c.segment IS NULL OR c.segment <> 'CHANGED'""",
    "merge_insert_all": f"""WITH {PARTY_SQL}
SELECT {_SAME} FROM base_raw b UNION ALL SELECT {_NEW} FROM {_FRESH}""",
    "merge_insert_map": f"""WITH {PARTY_SQL}
SELECT {_SAME} FROM base_raw b
UNION ALL
SELECT c.kind, c.party_id, upper(c.name), NULL, NULL, NULL, NULL FROM {_FRESH}""",
    "merge_insert_expr": f"""WITH {PARTY_SQL}
SELECT {_SAME} FROM base_raw b
UNION ALL
SELECT c.kind, c.party_id, NULL, NULL, lower(c.segment), NULL, c.update_ts FROM {_FRESH}""",
    "merge_first_clause_wins": f"""WITH {PARTY_SQL}
SELECT b.kind, b.party_id, b.name, b.nation,
       CASE WHEN c.kind IS NULL THEN b.segment WHEN b.nation = 0 THEN 'FIRST'
            WHEN b.nation < 5 THEN c.segment ELSE b.segment END AS segment,
       b.balance, b.update_ts
FROM {_B} WHERE c.kind IS NULL OR NOT (b.nation BETWEEN 1 AND 2)
UNION ALL
SELECT c.kind, c.party_id, NULL, NULL, 'LOW', NULL, NULL FROM {_FRESH} AND c.nation < 6
UNION ALL
SELECT {_NEW} FROM {_FRESH} AND c.nation >= 6 AND c.nation < 12""",
    "merge_delete_update_insert": f"""WITH {PARTY_SQL}
SELECT b.kind, b.party_id, b.name, b.nation, coalesce(c.segment, b.segment) AS segment,
       b.balance, b.update_ts
FROM {_B} WHERE c.kind IS NULL OR b.nation <> 0
UNION ALL
SELECT {_NEW} FROM {_FRESH}""",
    "merge_upsert_row_key": _UPSERT_OPEN,
    "merge_upsert_unique": _UPSERT_OPEN,
    "merge_one_call": f"""WITH {PARTY_SQL}
SELECT b.kind, b.party_id, upper(b.name) AS name, b.nation, c.segment, b.balance, b.update_ts
FROM {_B} WHERE c.segment = 'CHANGED' AND b.nation NOT BETWEEN 10 AND 11
UNION ALL
SELECT {_NEW} FROM {_B} WHERE c.segment <> 'CHANGED' AND b.nation NOT BETWEEN 10 AND 11
UNION ALL
SELECT c.kind, c.party_id, c.name, NULL, NULL, NULL, NULL FROM {_FRESH} AND c.nation < 6
UNION ALL
SELECT {_NEW} FROM {_FRESH} AND c.nation >= 6 AND c.nation < 12""",
    "merge_range_cond": """
        WITH spans AS (SELECT c_custkey * 8 AS low_key, c_custkey * 8 + c_custkey % 11 - 4 AS high_key, c_custkey, c_nationkey FROM customer)
        SELECT o_orderkey, coalesce(c_custkey, o_custkey) AS o_custkey, CASE WHEN c_custkey IS NULL THEN o_orderstatus ELSE 'M' END AS o_orderstatus
        FROM orders LEFT JOIN spans ON o_orderkey BETWEEN low_key AND high_key
        WHERE c_nationkey IS NULL OR c_nationkey % 5 <> 0
        UNION ALL
        SELECT -low_key, c_custkey, 'N' FROM spans
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey BETWEEN low_key AND high_key)""",
}
