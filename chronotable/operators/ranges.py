"""Pairs of a point and an interval that holds it, as an equality join.

An interval is put into buckets of one width, by its own length, so it lies in ten of them at most. A point looks into the one bucket of each
width that intervals have, some twenty at most. The join is on width and bucket, which Spark shuffles, and splits where a bucket is hot; an
exact test follows. A bucket is an eighth of its interval or less, so few pairs fail it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotable.functions.columns import col, quoted, require_columns

_STEP = 3  # widths grow by factors of eight
_WIDTH, _BUCKET, _LOW, _HIGH = "__width", "__bucket", "__low", "__high"
_CLOCKS = (T.TimestampType, T.TimestampNTZType)


def whole_seconds(moment: Column, data_type: T.DataType) -> Column:
    """Whole seconds since 1970; of a timestamp without a zone by its own clock."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_seconds(moment)
    clock = F.hour(moment) * 3_600 + F.minute(moment) * 60 + F.second(moment)
    return F.unix_date(F.to_date(moment)).cast("long") * 86_400 + clock


def _whole(value: Column, data_type: T.DataType) -> Column:
    """A whole number that never falls while the value rises; null for NaN."""
    if isinstance(data_type, T.IntegralType):
        return value.cast("long")
    if isinstance(data_type, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(data_type, _CLOCKS):
        return whole_seconds(value, data_type)
    if isinstance(data_type, T.DecimalType) and data_type.precision - data_type.scale <= 18:
        return F.floor(value).cast("long")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), F.floor(value))
    raise ValueError(f"no ranges over {data_type.simpleString()}")


def _common_type(types: Sequence[T.DataType]) -> T.DataType | None:
    """The type to compare in, or None to compare as they are; times only with times, days with days, numbers with numbers."""
    if all(isinstance(t, _CLOCKS) for t in types):
        return T.TimestampType() if any(isinstance(t, T.TimestampType) for t in types) else T.TimestampNTZType()
    if all(isinstance(t, T.DateType) for t in types) or all(isinstance(t, T.NumericType) for t in types):
        return None
    raise ValueError(f"a range over {', '.join(t.simpleString() for t in types)}")


def join_in_range(
    points: DataFrame,
    spans: DataFrame,
    point: str,
    low: str,
    high: str,
    aliases: tuple[str, str],
    keys: Sequence[tuple[str, str]] = (),
    condition: Column | None = None,
) -> DataFrame:
    """Rows of ``points`` beside each row of ``spans`` with ``low`` <= ``point`` <= ``high``, under their aliases.

    ``keys`` are (point's, span's) names that must be equal too, ``condition`` is any further test over the aliases. Nulls and NaN lie in
    nothing and hold nothing, and so does a span whose ends are the wrong way round.
    """
    require_columns(points, [point, *[p for p, _ in keys]], "point columns")
    require_columns(spans, [low, high, *[s for _, s in keys]], "span columns")
    types = {"point": points.schema[point].dataType, "low": spans.schema[low].dataType, "high": spans.schema[high].dataType}
    common = _common_type(list(types.values()))

    def value(name: str, which: str) -> tuple[Column, T.DataType]:
        return (F.col(name), types[which]) if common is None else (F.col(name).cast(common), common)

    held = spans.where(col(low) <= col(high)).withColumns({_LOW: _whole(*value(quoted(low), "low")), _HIGH: _whole(*value(quoted(high), "high"))})
    held = held.where(F.col(_LOW).isNotNull() & F.col(_HIGH).isNotNull())
    size = F.ceil(F.log2(F.col(_HIGH).cast("double") - F.col(_LOW).cast("double") + 1) / _STEP).cast("int")
    held = held.withColumn(_WIDTH, F.least(F.greatest(size - 1, F.lit(0)) * _STEP, F.lit(63)))
    widths = sorted(row[0] for row in held.select(_WIDTH).distinct().collect())  # at most 22 numbers
    held = held.withColumn(_BUCKET, F.explode(F.expr(f"sequence(shiftright({_LOW}, {_WIDTH}), shiftright({_HIGH}, {_WIDTH}))"))).drop(_LOW, _HIGH)
    looking = points.withColumn(_LOW, _whole(*value(quoted(point), "point"))).where(F.col(_LOW).isNotNull())
    looking = looking.withColumn(_WIDTH, F.explode(F.lit(widths).cast("array<int>")))
    looking = looking.withColumn(_BUCKET, F.expr(f"shiftright({_LOW}, {_WIDTH})")).drop(_LOW)

    left, right = (quoted(a) for a in aliases)
    on = (F.col(f"{left}.{_WIDTH}") == F.col(f"{right}.{_WIDTH}")) & (F.col(f"{left}.{_BUCKET}") == F.col(f"{right}.{_BUCKET}"))
    for p, s in keys:
        on &= F.col(f"{left}.{quoted(p)}") == F.col(f"{right}.{quoted(s)}")
    at = value(f"{left}.{quoted(point)}", "point")[0]
    on &= (at >= value(f"{right}.{quoted(low)}", "low")[0]) & (at <= value(f"{right}.{quoted(high)}", "high")[0])
    if condition is not None:
        on &= condition
    return looking.alias(aliases[0]).join(held.alias(aliases[1]), on)
