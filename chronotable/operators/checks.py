"""Checks that ride along in the plan, and two that need an answer before going on."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotable.functions.columns import col

_FILLERS: tuple[tuple[type, object], ...] = (
    (T.StringType, ""),
    (T.BooleanType, False),
    (T.NumericType, 0),
    (T.DateType, datetime.date(1970, 1, 1)),
    (T.TimestampType, datetime.datetime(1970, 1, 1)),
    (T.TimestampNTZType, datetime.datetime(1970, 1, 1)),
)


def _required(name: str, data_type: T.DataType) -> Column:
    value = col(name)
    checked = F.when(
        value.isNull(), F.raise_error(f"null in column {name}").cast(data_type)
    ).otherwise(value)
    for kind, filler in _FILLERS:
        if isinstance(data_type, kind):
            # The filler is never reached; it only tells Catalyst that no null can come out.
            return F.coalesce(checked, F.lit(filler).cast(data_type))
    return checked


def assert_non_null(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Same rows, with the named columns declared non-null; a null fails the query that meets it.

    The check is part of the projection, so it costs no pass of its own. Columns of a nested
    type are checked but keep their nullable flag.
    """
    wanted = set(df.columns if names is None else names)
    return df.select(
        [
            (_required(f.name, f.dataType) if f.name in wanted else col(f.name)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Fail if some key occurs twice. Counts combine on the map side, so no key is too hot."""
    repeated = df.groupBy(*[col(k) for k in keys]).count().where("count > 1").select(*keys).take(1)
    if repeated:
        raise ValueError(f"{what}: more than one row for {repeated[0].asDict()}")


def assert_single_value(df: DataFrame, exact: Sequence[str], any_case: Sequence[str]) -> DataFrame:
    """One row holding the values that all rows share; the query fails if they do not.

    ``any_case`` columns are compared without regard to case and give their smallest spelling.
    Only counts, minima and maxima are kept, so the check is one partial aggregate.
    """
    names = [*exact, *any_case]
    facts: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for n in names:
        value = F.lower(col(n)) if n in any_case else col(n)
        facts += [
            F.count(col(n)).alias(f"known_{n}"),
            F.min(value).alias(f"low_{n}"),
            F.max(value).alias(f"high_{n}"),
            F.min(col(n)).alias(f"shown_{n}"),
        ]
    agreed = {
        n: (F.col("rows") == col(f"known_{n}")) & col(f"low_{n}").eqNullSafe(col(f"high_{n}"))
        for n in names
    }
    return df.agg(*facts).select(
        [
            F.when(agreed[n], col(f"shown_{n}"))
            .otherwise(
                F.raise_error(f"column {n} holds more than one value").cast(df.schema[n].dataType)
            )
            .alias(n)
            for n in names
        ]
    )
