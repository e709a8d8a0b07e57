"""Key sets for semi and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotable.functions.columns import quoted

_ROW = "__row"
_TIMES = "__times"


def splittable_keys(keys: DataFrame, at_least: int = 1) -> DataFrame:
    """Distinct rows that occur ``at_least`` so often, fit to be joined with a side with hot keys.

    Adaptive execution splits a hot key only in joins whose two sides both come straight out of a
    shuffle. An aggregate that is already partitioned by the join key would be joined in place, so
    the keys are handed on as aggregated values, which the planner shuffles (they are few and
    narrow) before the join.
    """
    names = [quoted(n) for n in keys.columns]
    counted = keys.groupBy(*names).agg(
        F.any_value(F.struct(*names)).alias(_ROW), F.count(F.lit(1)).alias(_TIMES)
    )
    if at_least > 1:
        counted = counted.where(F.col(_TIMES) >= at_least)
    return counted.select(f"{_ROW}.*")
