"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotable.sources.workspace import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of an edge; the root is the least node of its component.

    Large-star and small-star rounds: every node hands its larger neighbours, and then its smaller ones, to the least
    that it knows. Each round groups narrow pairs by node with partial aggregation and ends in a
    written table; a round that changes nothing is the last. No edge or label is brought to the driver.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = materialize(links)
    seen = _print_of(links)
    while True:
        links = materialize(_small_star(_large_star(links)))
        now = _print_of(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _print_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(links: DataFrame) -> DataFrame:
    """(node, m): the least neighbour of each node.

    The node is handed on as an aggregated value, so the join with it shuffles both of its sides and
    adaptive execution can split a node that very many others are linked to.
    """
    return links.groupBy("u").agg(F.any_value("u").alias("node"), F.min("v").alias("m")).select("node", "m")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), F.col("u") == F.col("node")).where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = _least(links)
    handed = links.join(least, F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return handed.unionByName(least.select(F.col("node").alias("u"), F.col("m").alias("v"))).distinct()
