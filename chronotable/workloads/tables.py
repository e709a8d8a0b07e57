"""Queries that read, create and append tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronotable.operators.dedup import sort_by_key
from chronotable.operators.diff import table_diff as diff
from chronotable.sources.readers import inline_batch, read_csv
from chronotable.sources.tables import (
    append,
    create_bucketed_as,
    create_table,
    create_table_like,
    get_property,
    set_properties,
)
from chronotable.sources.workspace import materialize, work_folder
from chronotable.workloads.recipes import (
    order_batches,
    order_dimension,
    read,
    sql_md5,
)


def _fresh_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex}"


def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders")


def inline_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders next to a literal batch of status names; the literals are few enough to broadcast."""
    names = inline_batch(
        spark,
        [("F", "finished", 3), ("O", "open", 1), ("P", "partial", 2)],
        "o_orderstatus string, status_name string, status_rank int",
    )
    return read(spark, sf, "orders").join(F.broadcast(names), "o_orderstatus")


def temp_view_sql(spark: SparkSession, sf: str) -> DataFrame:
    view = _fresh_name("batch")
    read(spark, sf, "lineitem").createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT l_returnflag, l_linestatus, count(*) AS line_count, max(l_shipdate) AS last_shipdate
        FROM {view} GROUP BY l_returnflag, l_linestatus""")


def csv_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV written with upper-case names, read back normalised."""
    part = read(spark, sf, "part")
    path = work_folder(spark)
    part.toDF(*[n.upper() for n in part.columns]).write.option("header", True).csv(path)
    return read_csv(spark, path, {"p_size": "string", "p_partkey": "bigint"})


def create_or_load(spark: SparkSession, sf: str) -> DataFrame:
    """Created once and filled; the second call finds the table and leaves its rows alone."""
    orders, name, base = read(spark, sf, "orders"), _fresh_name("orders"), work_folder(spark)
    create_table(spark, name, orders.schema, ["o_orderstatus"], base)
    append(orders, name)
    return create_table(spark, name, orders.schema, ["o_orderstatus"], base)


def create_from_df_empty(spark: SparkSession, sf: str) -> DataFrame:
    """The new table has the frame's columns and none of its rows."""
    orders = read(spark, sf, "orders")
    created = create_table_like(orders, _fresh_name("orders"), [], work_folder(spark))
    return orders.join(created, "o_orderkey", "left_anti").select(created.columns)


def append_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends to one table; the second has its columns in another order."""
    first, second = order_batches(spark, sf)
    name = _fresh_name("orders")
    table = create_table_like(first, name, [], work_folder(spark))
    append(first, name)
    append(second.select(*reversed(second.columns)), name)
    return spark.table(name).select(table.columns)


def day_partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    events, name = read(spark, sf, "events"), _fresh_name("events")
    create_table_like(events, name, ["ts"], work_folder(spark), transform="Day")
    append(events, name)
    return spark.table(name)


def table_properties(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a table next to a property that was set on it."""
    supplier, name = read(spark, sf, "supplier"), _fresh_name("supplier")
    create_table_like(supplier, name, [], work_folder(spark))
    append(supplier, name)
    set_properties(spark, name, {"steward": "it's finance"})
    return spark.table(name).withColumn("steward", F.lit(get_property(spark, name, "steward")))


def ctas_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders clustered by their number, joined with their rows in lineitem."""
    orders, lines = read(spark, sf, "orders"), read(spark, sf, "lineitem")
    table = create_bucketed_as(orders, _fresh_name("orders"), 8, "o_orderkey", work_folder(spark))
    joined = table.join(lines, table["o_orderkey"] == lines["l_orderkey"])
    return joined.select("o_orderkey", "o_custkey", "o_orderdate", "l_linenumber", "l_shipdate")


def sorted_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Both batches, sorted; ``place`` is the number of rows before a row in the order they come."""
    first, second = order_batches(spark, sf)
    ordered = sort_by_key(order_dimension().enrich(first.unionByName(second)))
    # Partitions of a sorted frame follow one another: rows of earlier ones, then those of its own.
    numbered = ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("number"))
    numbered = materialize(numbered)
    sizes = numbered.groupBy("part").agg(F.count("*").alias("rows"), F.min("number").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select("part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("number") - F.col("first")
    return numbered.join(placed, "part").select(*ordered.columns, place.alias("place"))


def table_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a later state of them: some changed, some gone, some there twice."""
    orders = read(spark, sf, "orders")
    status = F.when(F.col("o_orderkey") % 997 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    later = orders.where("o_orderkey % 1009 <> 3").withColumn("o_orderstatus", status)
    later = later.unionByName(orders.where("o_orderkey % 503 = 1"))
    return diff(orders, later, ["o_orderkey"])


QUERIES = {
    "table_diff": table_diff,
    "table_scan": table_scan,
    "inline_batch": inline_rows,
    "temp_view_sql": temp_view_sql,
    "csv_normalized": csv_normalized,
    "create_or_load": create_or_load,
    "create_from_df_empty": create_from_df_empty,
    "append_rows": append_rows,
    "day_partitioned_write": day_partitioned_write,
    "table_properties": table_properties,
    "ctas_bucketed": ctas_bucketed,
    "sorted_by_key": sorted_by_key,
}

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

SQL = {
    "table_scan": "SELECT * FROM orders",
    "inline_batch": """
        SELECT orders.*, status_name, status_rank
        FROM orders
        JOIN (VALUES ('F', 'finished', 3), ('O', 'open', 1), ('P', 'partial', 2))
          names(code, status_name, status_rank) ON o_orderstatus = code""",
    "temp_view_sql": """
        SELECT l_returnflag, l_linestatus, count(*) AS line_count, max(l_shipdate) AS last_shipdate
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "csv_normalized": """
        SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
               p_retailprice
        FROM part""",
    "create_or_load": "SELECT * FROM orders",
    "create_from_df_empty": "SELECT * FROM orders",
    "append_rows": f"SELECT {_ORDERS} FROM orders",
    "day_partitioned_write": "SELECT *, CAST(ts AS DATE) AS ts_day FROM events",
    "table_properties": "SELECT *, 'it''s finance' AS steward FROM supplier",
    "ctas_bucketed": """
        SELECT o_orderkey, o_custkey, o_orderdate, l_linenumber, l_shipdate
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "sorted_by_key": f"""
        SELECT *, row_number() OVER (ORDER BY row_key, {_ORDERS}, row_md5) - 1 AS place
        FROM (SELECT {_ORDERS}, {sql_md5('o_orderstatus', 'o_totalprice', 'o_orderpriority')} AS row_md5,
                     {sql_md5('o_custkey')} AS row_key
              FROM orders)""",
    "table_diff": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               CAST(sum(a) AS BIGINT) AS n_left, CAST(sum(b) AS BIGINT) AS n_right
        FROM (
          SELECT *, 1 AS a, 0 AS b FROM orders
          UNION ALL
          SELECT * REPLACE (CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus), 0, 1
          FROM orders WHERE o_orderkey % 1009 <> 3
          UNION ALL SELECT *, 0, 1 FROM orders WHERE o_orderkey % 503 = 1)
        GROUP BY ALL HAVING sum(a) <> sum(b)""",
}
