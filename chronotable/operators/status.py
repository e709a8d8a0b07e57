"""Outcome codes of a dimension run."""

from __future__ import annotations

from enum import IntEnum

from pyspark.sql import Column
from pyspark.sql import functions as F


class Status(IntEnum):
    """What became of a row. Fixed values but for the last, which only ``late="reject"`` gives."""

    NA = 0
    DUPLICATE_IN_MICRO_BATCH = 1
    CLOSED = 2
    DUPLICATE_RECORD_OPEN = 3
    UPDATED = 4
    INSERT = 5
    LATE_RECORD = 6


def status_lit(status: Status) -> Column:
    return F.lit(int(status)).cast("int")


def status_name(code: Column) -> Column:
    """Name of a status code; the query fails on a code that does not exist."""
    names = F.expr(f"map({', '.join(f"{int(s)}, '{s.name}'" for s in Status)})")
    unknown = F.concat(
        F.lit("unknown status code "), F.coalesce(code.cast("string"), F.lit("null"))
    )
    return F.coalesce(F.try_element_at(names, code), F.raise_error(unknown).cast("string"))
