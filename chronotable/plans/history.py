"""One-table history kept by a MERGE whose source carries a null key for rows to insert.

Every landed row opens a new version; the open version of its key, if any, is ended. There is no
change detection: landing the same row again opens another version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotable.functions.columns import col, pick, quoted
from chronotable.operators.keys import splittable_keys
from chronotable.operators.merge import TOO_MANY

# The two columns that tell versions apart and the flag's values.
ACTIVE = "active_ind"
END = "end_dt"
YES, NO = "Y", "N"

MERGE_KEY = "key_match"
_LANDED = "__landed"


def superseded(base: DataFrame, landing: DataFrame, key: str) -> DataFrame:
    """Open versions whose key has landed: a correlated ``IN`` as a semi join."""
    landed = landing.select(col(key)).distinct()
    ending = base.where(col(ACTIVE) == YES).join(landed, key, "left_semi")
    return pick(ending, base.columns)


def merge_source(base: DataFrame, landing: DataFrame, key: str, as_of: Column) -> DataFrame:
    """Landed rows under a null merge key, and the versions they supersede under their own key."""
    payload = [n for n in base.columns if n not in (ACTIVE, END)]
    key_type = base.schema[key].dataType
    landed = landing.select(
        F.lit(None).cast(key_type).alias(MERGE_KEY),
        *[quoted(n) for n in payload],
        F.lit(YES).alias(ACTIVE),
        as_of.cast(base.schema[END].dataType).alias(END),
    )
    ending = superseded(base, landing, key).select(
        col(key).alias(MERGE_KEY), *[quoted(n) for n in payload], ACTIVE, END
    )
    return landed.unionByName(ending)


def merge_history(base: DataFrame, landing: DataFrame, key: str, as_of: Column) -> DataFrame:
    """The history after ``landing`` arrived at ``as_of``.

    The rows with a null key of ``merge_source`` always insert and the others always match, so the merge comes down to one
    join of the base with the landed keys, and the landed rows beside it. Two open versions of a
    landed key are an error.
    """
    if ACTIVE in landing.columns:
        raise ValueError(f"landing rows must not carry {ACTIVE}")
    landed = splittable_keys(landing.select(col(key).alias(_LANDED)))
    is_open = col(ACTIVE) == YES
    joined = base.join(landed, col(key) == F.col(_LANDED), "left")
    open_keys = pick(base.where(is_open), [key])
    twice = splittable_keys(open_keys, at_least=2).join(landed, col(key) == F.col(_LANDED), "left_semi")
    competing = twice.agg(F.count(F.lit(1))).scalar() > 0
    ends = F.when(competing, F.raise_error(TOO_MANY).cast("boolean")).otherwise(is_open & F.col(_LANDED).isNotNull())
    types = {f.name: f.dataType for f in base.schema.fields}
    flag = F.when(ends, F.lit(NO)).otherwise(col(ACTIVE))
    end = F.when(ends, as_of.cast(types[END])).otherwise(col(END))
    changed = {ACTIVE: flag.cast(types[ACTIVE]).alias(ACTIVE), END: end.alias(END)}
    kept = joined.select([changed.get(n, col(n)) for n in base.columns])
    new = {ACTIVE: F.lit(YES).cast(types[ACTIVE]).alias(ACTIVE), END: F.lit(None).cast(types[END]).alias(END)}
    opened = landing.select([new[n] if n in new else col(n).cast(types[n]).alias(n) for n in base.columns])
    return kept.unionByName(opened)
