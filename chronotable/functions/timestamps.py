"""Validity bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the end of validity of a row that is still open.
OPEN_END = "9999-12-31 00:00:00"


def bound_type(data_type: T.DataType) -> T.DataType:
    """Type of a validity bound: that of the source column if it is a timestamp."""
    return data_type if isinstance(data_type, T.TimestampNTZType) else T.TimestampType()


def open_end(data_type: T.DataType) -> Column:
    return F.lit(OPEN_END).cast(bound_type(data_type))


def one_milli_before(ts: Column, data_type: T.DataType) -> Column:
    """The millisecond before ``ts``; digits below a millisecond are dropped first."""
    return F.timestamp_millis(F.unix_millis(ts.cast("timestamp")) - F.lit(1)).cast(
        bound_type(data_type)
    )
