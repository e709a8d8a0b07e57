"""Move a table's paths from one base location to another.

Works on any frame that lists paths: in plain columns, in lists of structs (snapshots, log
entries) and in property maps.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotable.functions.columns import col, quoted, require_columns
from chronotable.functions.paths import base_name, replace_prefix
from chronotable.operators.checks import assert_single_value
from chronotable.operators.dedup import total_order
from chronotable.sources.workspace import materialize

# The table properties that hold a location.
LOCATION_PROPERTIES = (
    "write.object-storage.path",
    "write.folder-storage.path",
    "write.data.path",
    "write.metadata.path",
)
# Directory names of relocated metadata.
METADATA_DIR = "metadata"
DEFAULT_ENVIRONMENT = "updated"

DATA_CONTENT = "DATA"
BASE_NAME = "base_name"


def relocate_structs(structs: Column, field: str, source: str, target: str) -> Column:
    """Rewrite one path field in every struct of a list; the other fields stay."""

    def moved(item: Column) -> Column:
        return item.withField(quoted(field), replace_prefix(item[field], source, target))

    return F.transform(structs, moved)


def relocate_properties(
    properties: Column, source: str, target: str, names: Sequence[str] = LOCATION_PROPERTIES
) -> Column:
    """Rewrite the named entries of a property map, where present."""
    return F.transform_values(
        properties,
        lambda name, value: F.when(
            name.isin(list(names)), replace_prefix(value, source, target)
        ).otherwise(value),
    )


def relocate(
    df: DataFrame,
    source: str,
    target: str,
    paths: Sequence[str] = (),
    struct_paths: Mapping[str, str] | None = None,
    properties: Sequence[str] = (),
    content: str | None = None,
) -> DataFrame:
    """Apply one (source, target) pair to every path of a frame.

    ``paths`` are plain columns, ``struct_paths`` maps a list-of-structs column to its path field,
    ``properties`` are map columns. All other columns, an entry's status among them, pass through.
    With ``content``, a row whose content is not ``DATA`` fails the query: lists of deletes cannot
    be moved this way.
    """
    struct_paths = struct_paths or {}
    require_columns(df, [*paths, *struct_paths, *properties], "path columns")
    changes = {n: replace_prefix(col(n), source, target) for n in paths}
    for name, field in struct_paths.items():
        changes[name] = relocate_structs(col(name), field, source, target)
    for name in properties:
        changes[name] = relocate_properties(col(name), source, target)
    if content is not None:
        refused = F.raise_error(F.lit("only data entries can be relocated")).cast("string")
        changes[content] = F.when(col(content) == DATA_CONTENT, col(content)).otherwise(refused)
    return df.withColumns(changes)


def target_directory(
    source_base: str,
    target_base: str | None = None,
    environment: str | None = None,
    in_place: bool = False,
) -> str:
    """Where relocated metadata is written.

    ``in_place`` writes to the plain metadata directory of the target; as that would overwrite the
    originals when both bases are the same (in any letter case), it is ignored then.
    """
    target_base = source_base if target_base is None else target_base
    if in_place and source_base.lower() != target_base.lower():
        return f"{target_base}/{METADATA_DIR}/"
    suffix = DEFAULT_ENVIRONMENT if environment is None else environment
    return f"{target_base}/{METADATA_DIR}_{suffix}/"


def relocate_from(
    df: DataFrame, locations: DataFrame, location: str, target: str, **paths: object
) -> DataFrame:
    """``relocate`` from the one location that all rows of ``locations`` name, in whatever letter case.

    The location is one value; rows that disagree fail.
    """
    source = assert_single_value(locations, exact=[], any_case=[location]).first()[location]
    return relocate(df, source, target, **paths)


def join_on_basename(
    files: DataFrame,
    path: str,
    lookup: DataFrame,
    lookup_path: str,
    latest_by: str,
    missing: str = "fail",
) -> DataFrame:
    """Files next to the lookup row whose path has the same base name.

    A base name that repeats in the lookup resolves to its last row by ``latest_by``, and among equals by
    all other columns, found by a partial aggregate. A file without a lookup row fails the query, or with
    ``missing="keep"`` stays with nulls. The name comes out of the packed row, so that the planner
    shuffles the few rows left and can split a name that very many files share.
    """
    if missing not in ("fail", "keep"):
        raise ValueError(f"missing must be fail or keep, not {missing}")
    both = [*files.columns, *lookup.columns, BASE_NAME]
    twice = sorted({n for n in both if [m.lower() for m in both].count(n.lower()) > 1})
    if twice:
        raise ValueError(f"column names that occur twice: {twice}")
    named = lookup.withColumn(BASE_NAME, base_name(col(lookup_path)))
    order = F.struct(*[F.expr(o) if isinstance(o, str) else o for o in total_order(lookup, [latest_by])])
    last = (
        named.groupBy(BASE_NAME)
        .agg(F.max_by(F.struct("*"), order).alias("__row"))
        .select("__row.*", F.lit(True).alias("__found"))
    )
    joined = files.withColumn(BASE_NAME, base_name(col(path))).join(last, BASE_NAME, "left")
    if missing == "fail":
        lost = F.raise_error(F.concat(F.lit("no lookup row for "), F.col(BASE_NAME))).cast("string")
        joined = joined.withColumn(BASE_NAME, F.when(F.col("__found"), F.col(BASE_NAME)).otherwise(lost))
    return joined.drop("__found")


def relocate_many(df: DataFrame, prefixes: DataFrame, source: str, target: str, paths: Sequence[str]) -> DataFrame:
    """Move paths by many pairs of directories at once; of those that hold a path the deepest counts.

    ``prefixes`` names the pairs in its columns ``source`` and ``target``. A directory holds a path that equals it or goes on after it with
    a slash; slashes at its end mean nothing, so ``/`` holds all paths that begin with one. Paths in no directory, null and empty ones among them, stay, and
    so do all other columns. Pairs with a null are passed over. A directory with two targets fails the query.

    Each different path is unfolded into those of its ancestors that are as deep as some directory, which meet the directories by equality, however many
    those are. Only moved paths are joined back, as aggregated values, so that the planner can split a path that very many rows share.
    """
    require_columns(df, paths, "path columns")
    require_columns(prefixes, [source, target], "prefix columns")
    bare = prefixes.select(F.rtrim(col(source), F.lit("/")).alias("__from"), F.rtrim(col(target), F.lit("/")).alias("__to"))
    depth = F.size(F.split("__from", "/", -1))
    two = F.raise_error(F.concat(F.lit("two targets for "), F.col("__from"))).cast("string")
    pairs = (
        bare.where(F.col("__from").isNotNull() & F.col("__to").isNotNull())
        .groupBy("__from")
        .agg(F.min("__to").alias("__to"), F.max("__to").alias("__last"))
        .select("__from", F.when(F.col("__to") == F.col("__last"), F.col("__to")).otherwise(two).alias("__to"), depth.alias("__depth"))
    )
    pairs = materialize(pairs)
    depths = sorted(row[0] for row in pairs.select("__depth").distinct().collect())  # no more than a directory has parts
    if not depths or not paths:
        return df

    parts = F.split("__path", "/", -1)
    ancestors = F.transform(
        F.filter(F.lit(depths).cast("array<int>"), lambda d: d <= F.size("__parts")),
        lambda d: F.struct(d.alias("__depth"), F.array_join(F.slice("__parts", 1, d), "/").alias("__from")),
    )
    every = functools.reduce(DataFrame.union, [df.select(col(n).cast("string").alias("__path")) for n in paths])
    known = every.where("__path <> ''").distinct().withColumn("__parts", parts)
    met = known.select("__path", F.inline(ancestors)).join(pairs, ["__from", "__depth"])
    best = met.groupBy("__path").agg(F.max_by(F.struct("__path", "__from", "__to"), "__depth").alias("__row")).select("__row.*")
    moved = materialize(best.select("__path", F.concat("__to", F.expr("substring(__path, length(__from) + 1)")).alias("__moved")))

    out = df
    for name in paths:
        found = moved.select(F.col("__path").alias("__old"), F.col("__moved").alias("__new"))
        joined = out.join(found, col(name) == F.col("__old"), "left")
        out = joined.withColumn(name, F.coalesce("__new", col(name))).drop("__old", "__new")
    return out
