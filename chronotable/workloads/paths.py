"""Queries over the path operators, on page addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotable.functions import base_name, file_kind, replace_prefix
from chronotable.operators.checks import assert_single_value as single_value
from chronotable.operators.relocate import join_on_basename as on_basename
from chronotable.operators.relocate import LOCATION_PROPERTIES, relocate, target_directory
from chronotable.operators.relocate import relocate_many as by_many
from chronotable.workloads.recipes import read

FROM, TO = "http://", "https://"


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select("page_id", "url")


def path_basename(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).withColumn("base_name", base_name(F.col("url")))


def path_prefix_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).withColumn("moved", replace_prefix(F.col("url"), FROM, TO))


def _metadata_file() -> Column:
    """A file below a page's address, one of the three kinds."""
    name = (
        F.when(F.startswith("url", F.lit(FROM)), "v1.metadata.json")
        .when(F.contains(F.col("url"), F.lit(".org/")), "snap-1.avro")
        .otherwise("m0.avro")
    )
    return F.concat_ws("/", "url", name)


def classify_paths(spark: SparkSession, sf: str) -> DataFrame:
    files = _pages(spark, sf).withColumn("path", _metadata_file())
    return files.withColumn("kind", file_kind(F.col("path")))


def rewrite_nested_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Every page lists two files; the list is rewritten whole and then unfolded."""

    def entry(number: int, path: Column) -> Column:
        return F.struct((F.col("page_id") + number).alias("id"), path.alias("path"))

    snapshots = F.array(
        entry(0, F.col("url")), entry(1, F.concat(F.lit("copy-of-"), F.col("url")))
    )
    listed = _pages(spark, sf).select("page_id", snapshots.alias("snapshots"))
    moved = relocate(listed, FROM, TO, struct_paths={"snapshots": "path"})
    return moved.select("page_id", F.inline("snapshots"))


def rewrite_map_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Each of the properties that hold a location, and one that does not."""
    names = [*LOCATION_PROPERTIES, "owner"]
    properties = F.create_map(*[x for n in names for x in (F.lit(n), F.col("url"))])
    tables = _pages(spark, sf).select("page_id", properties.alias("properties"))
    moved = relocate(tables, FROM, TO, properties=["properties"])
    return moved.select("page_id", F.explode("properties").alias("name", "location"))


def assert_single_value(spark: SparkSession, sf: str) -> DataFrame:
    """All order rows agree on the format version, and on the location but for its letter case."""
    files = read(spark, sf, "orders").select(
        F.lit(2).alias("format_version"),
        F.when(F.col("o_orderstatus") == "F", "S3://LAKE/orders")
        .otherwise("s3://lake/orders")
        .alias("location"),
    )
    return single_value(files, exact=["format_version"], any_case=["location"])


def join_on_basename(spark: SparkSession, sf: str) -> DataFrame:
    """Pages next to the newest of the lists that carry the same base name.

    Only encrypted pages are listed, so many base names have no list; ties by format go to the greater number.
    """
    lists = _pages(spark, sf).where(F.startswith("url", F.lit(TO))).select(
        F.col("page_id").alias("snapshot_id"),
        F.concat(F.lit("s3://lists/"), base_name(F.col("url"))).alias("list_path"),
        (F.col("page_id") % 2).alias("format_version"),
    )
    return on_basename(_pages(spark, sf), "url", lists, "list_path", "format_version", missing="keep")


def relocate_entries(spark: SparkSession, sf: str) -> DataFrame:
    """File entries of every status, moved to a new base."""
    status = (
        F.when(F.contains(F.col("url"), F.lit(".org/")), "DELETED")
        .when(F.contains(F.col("url"), F.lit("?")), "EXISTING")
        .otherwise("ADDED")
    )
    entries = _pages(spark, sf).withColumns({"status": status, "content": F.lit("DATA")})
    target = target_directory("http:/", "s3://lake", environment="aws")
    return relocate(entries, FROM, target, paths=["url"], content="content")


def relocate_many(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of every host that has an encrypted one move to that host's bucket, one of its languages to another, all others to a lake."""
    host = F.regexp_extract("url", "^https://[^/?#]+", 0)
    language = F.regexp_extract("url", "^https://[^/?#]+/[a-z]+", 0)
    by_host = _pages(spark, sf).select(host.alias("old")).where("old <> ''")
    by_language = _pages(spark, sf).select(language.alias("old")).where("old LIKE '%/de'")
    pairs = by_host.select("old", F.concat(F.lit("s3://hosts/"), F.md5("old"), F.lit("/")).alias("new"))
    pairs = pairs.union(by_language.select(F.concat("old", F.lit("/")), F.concat(F.lit("s3://german/"), F.md5("old"))))
    pairs = pairs.union(spark.range(1).select(F.lit("http://"), F.lit("s3://lake")))
    pages = _pages(spark, sf).withColumn("copy", F.concat(F.lit("x"), F.col("url")))
    return by_many(pages, pairs, "old", "new", ["url", "copy"])


QUERIES = {
    "relocate_many": relocate_many,
    "path_basename": path_basename,
    "path_prefix_rewrite": path_prefix_rewrite,
    "classify_paths": classify_paths,
    "rewrite_nested_paths": rewrite_nested_paths,
    "rewrite_map_paths": rewrite_map_paths,
    "assert_single_value": assert_single_value,
    "join_on_basename": join_on_basename,
    "relocate_entries": relocate_entries,
}


def _moved(column: str, target: str = TO) -> str:
    return f"""CASE WHEN starts_with({column}, '{FROM}')
  THEN '{target}' || substr({column}, {len(FROM) + 1}) ELSE {column} END"""


_BASE = "regexp_extract(url, '[^/]*$')"

SQL = {
    "path_basename": f"SELECT page_id, url, {_BASE} AS base_name FROM pages",
    "path_prefix_rewrite": f"SELECT page_id, url, {_moved('url')} AS moved FROM pages",
    "classify_paths": f"""
        SELECT page_id, url, url || '/' || name AS path,
               CASE name WHEN 'v1.metadata.json' THEN 'metadata'
                         WHEN 'snap-1.avro' THEN 'manifest_list' ELSE 'manifest' END AS kind
        FROM (SELECT page_id, url,
                     CASE WHEN starts_with(url, '{FROM}') THEN 'v1.metadata.json'
                          WHEN contains(url, '.org/') THEN 'snap-1.avro'
                          ELSE 'm0.avro' END AS name
              FROM pages)""",
    "rewrite_nested_paths": f"""
        SELECT page_id, page_id AS id, {_moved('url')} AS path FROM pages
        UNION ALL SELECT page_id, page_id + 1, 'copy-of-' || url FROM pages""",
    "rewrite_map_paths": f"""
        SELECT page_id, name, CASE WHEN name = 'owner' THEN url ELSE {_moved('url')} END AS location
        FROM pages, (VALUES {', '.join(f"('{n}')" for n in (*LOCATION_PROPERTIES, 'owner'))}) names(name)""",
    "assert_single_value": """
        SELECT 2 AS format_version,
               min(CASE WHEN o_orderstatus = 'F' THEN 'S3://LAKE/orders'
                        ELSE 's3://lake/orders' END) AS location
        FROM orders""",
    "join_on_basename": f"""
        WITH named AS (SELECT page_id, url, {_BASE} AS base_name FROM pages),
        newest AS (
          SELECT base_name AS name, page_id AS snapshot_id, 's3://lists/' || base_name AS list_path,
                 page_id % 2 AS format_version,
                 row_number() OVER (PARTITION BY base_name ORDER BY page_id % 2 DESC, page_id DESC) AS n
          FROM named WHERE starts_with(url, '{TO}'))
        SELECT page_id, url, base_name, snapshot_id, list_path, format_version
        FROM named LEFT JOIN newest ON name = base_name AND n = 1""",
    "relocate_entries": f"""
        SELECT page_id, {_moved('url', 's3://lake/metadata_aws/')} AS url,
               CASE WHEN contains(url, '.org/') THEN 'DELETED'
                    WHEN contains(url, '?') THEN 'EXISTING' ELSE 'ADDED' END AS status,
               'DATA' AS content
        FROM pages""",
    "relocate_many": """
        WITH pairs AS (
          SELECT regexp_extract(url, '^https://[^/?#]+') AS old, 's3://hosts/' || md5(regexp_extract(url, '^https://[^/?#]+')) AS new
          FROM pages WHERE url LIKE 'https://_%'
          UNION
          SELECT regexp_extract(url, '^https://[^/?#]+/[a-z]+'), 's3://german/' || md5(regexp_extract(url, '^https://[^/?#]+/[a-z]+'))
          FROM pages WHERE regexp_extract(url, '^https://[^/?#]+/[a-z]+') LIKE '%/de'
          UNION SELECT 'http:', 's3://lake'),
        deepest AS (
          SELECT page_id, new || substr(url, length(old) + 1) AS moved
          FROM pages JOIN pairs ON url = old OR starts_with(url, old || '/')
          QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(old) DESC) = 1)
        SELECT page_id, coalesce(moved, url) AS url, 'x' || url AS copy FROM pages LEFT JOIN deepest USING (page_id)""",
}
