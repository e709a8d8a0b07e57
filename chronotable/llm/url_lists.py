"""URL filters whose list entries have dates: a capture is judged by the list as it was when it was fetched.

A list is a log of dated changes: (entry, action, effective), ``add`` or ``remove``. Changes of an entry become
validity intervals [valid_from, valid_to). An entry is a host, which also covers the hosts below it
(``example.com``), or a host and a first path segment (``example.com/ads``). A capture is looked up under
its own host, every parent domain, and those with its first path segment. Of the entries in force
the most specific decides: more path first, then the longer host, then ``allow`` before ``block``.

The as-of join is an equality join on key and time bucket with the exact interval test on top. An interval is
repeated for each bucket in which its entry is looked up, so neither a key that changes often nor one that
lasts for years makes a capture meet more than the changes of one bucket; a host with a third of all
captures is a skewed key of a plain join, which adaptive execution splits. Only built-in functions are used.

A host of more than 253 characters is looked up under its last labels, as no entry is longer.

Nulls: a null or unreadable URL, or a null fetch time, matches nothing and is not blocked; the row stays. Entries with
a null entry or time are left out; an action other than ``add`` counts as ``remove``. At one time removal
wins over addition; repeated changes count once. Repeated captures are each judged. Empty tables give no rows,
or no blocked ones. Columns other than those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotable.sources.workspace import materialize

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_LONGEST_HOST = 253  # fixed: the limit of the name system
_SEGMENT = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)"


def _written_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def host_of(url: Column) -> Column:
    """Host in lower case; null if there is none. No host has more than 253 characters."""
    host = _written_host(url)
    return F.when(F.char_length(host).between(1, _LONGEST_HOST), host)


def listable_host(url: Column) -> Column:
    """The host, of a longer one the most last labels that have 253 characters together, which is all that an entry can name."""
    host = _written_host(url)
    # One more character tells whether the first label is whole; what stands before the first dot goes.
    tail = F.regexp_extract(F.substring(host, -_LONGEST_HOST - 1, _LONGEST_HOST + 1), r"\.(.+)$", 1)
    return F.nullif(F.when(F.char_length(host) > _LONGEST_HOST, tail).otherwise(host), F.lit(""))


def segment_of(url: Column) -> Column:
    """First path segment; null if there is none."""
    return F.nullif(F.regexp_extract(url, _SEGMENT, 1), F.lit(""))


def intervals(changes: DataFrame, bucket: int) -> DataFrame:
    """(entry, kind, valid_from, valid_to) of every stretch during which an entry is listed; an open end is null.

    The next change is found within a time bucket, and at its end from the first change of the
    entry's next bucket, so a long history is not sorted in one task.
    """
    logged = (
        changes.select("entry", "kind", F.col("effective").cast("long").alias("valid_from"), F.when(F.col("action") == "add", F.lit(0)).otherwise(F.lit(1)).alias("removed"))
        .where("entry IS NOT NULL AND kind IS NOT NULL AND valid_from IS NOT NULL")
        .groupBy("entry", "kind", "valid_from")
        .agg(F.max("removed").alias("removed"))
        .withColumn("bucket", F.floor(F.col("valid_from") / bucket))
    )
    keys = ["entry", "kind"]
    firsts = logged.groupBy(*keys, "bucket").agg(F.min("valid_from").alias("first"))
    following = firsts.withColumn("after", F.lead("first").over(Window.partitionBy(*keys).orderBy("bucket"))).drop("first")
    inside = logged.withColumn("next", F.lead("valid_from").over(Window.partitionBy(*keys, "bucket").orderBy("valid_from")))
    return inside.join(following, [*keys, "bucket"]).where("removed = 0").select(*keys, "valid_from", F.coalesce("next", "after").alias("valid_to"))


def _keys(host: Column, segment: Column) -> Column:
    """All (key, depth) under which a capture is looked up; the depth orders them by how specific they are."""
    labels = F.split(host, r"\.")
    count = F.size(labels)

    def parent(k: Column) -> Column:
        return F.array_join(F.slice(labels, k, count - k + 1), ".")

    places = F.sequence(F.lit(1), count)
    hosts = F.transform(places, lambda k: F.struct(parent(k).alias("key"), (count - k + 1).alias("depth")))
    paths = F.transform(places, lambda k: F.struct(F.concat(parent(k), F.lit("/"), segment).alias("key"), (1000 + count - k + 1).alias("depth")))
    return F.when(host.isNull(), F.array().cast("array<struct<key:string,depth:int>>")).when(segment.isNull(), hosts).otherwise(F.concat(hosts, paths))


def judge_captures(captures: DataFrame, changes: DataFrame, url: str = "url", fetched: str = "fetched_at", bucket: int = 30 * 86_400) -> DataFrame:
    """Captures (``url`` and ``fetched`` in seconds, and their ``page_id``) with the entry that decides, and ``blocked``.

    ``changes`` has entry, kind (``block`` or ``allow``), action and effective, in seconds.
    """
    rows = captures.select("page_id", F.col(url).alias("url"), F.col(fetched).cast("long").alias("fetched_at"))
    lookups = (
        rows.where("fetched_at IS NOT NULL")
        .select("page_id", "url", "fetched_at", F.inline(_keys(listable_host(F.col("url")), segment_of(F.col("url")))))
        .withColumn("bucket", F.floor(F.col("fetched_at") / bucket))
    )
    # Of an interval's buckets only those are used in which its entry is looked up.
    present = lookups.select("key", "bucket").distinct()
    listed = intervals(changes, bucket).withColumnRenamed("entry", "key")
    within = (F.col("bucket") >= F.floor(F.col("valid_from") / bucket)) & (F.col("valid_to").isNull() | (F.col("bucket") * bucket < F.col("valid_to")))
    by_bucket = materialize(present.join(listed, "key").where(within).select("key", "bucket", "kind", "valid_from", "valid_to"))
    active = lookups.join(by_bucket, ["key", "bucket"]).where("valid_from <= fetched_at AND (valid_to IS NULL OR fetched_at < valid_to)")
    rank = F.struct("depth", (F.col("kind") == "allow").alias("allow"), "key", "valid_from")
    decided = active.groupBy("page_id", "url", "fetched_at").agg(F.max(rank).alias("top"), F.countDistinct("key", "kind").alias("n_active"))
    decided = decided.select(*[F.col(c).alias(f"_{c}") for c in ("page_id", "url", "fetched_at")], "top", "n_active")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("page_id", "url", "fetched_at")]
    return rows.join(decided, same[0] & same[1] & same[2], "left").select(
        "page_id",
        "url",
        "fetched_at",
        F.col("top.key").alias("entry"),
        F.col("top.valid_from").alias("listed_from"),
        F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.coalesce(~F.col("top.allow"), F.lit(False)).alias("blocked"),
    )
