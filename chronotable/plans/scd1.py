"""Type 1 dimension: the newest row replaces the old one, no history."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chronotable.operators.columns import ROW_KEY
from chronotable.operators.dedup import duplicate_rejects
from chronotable.operators.merge import upsert
from chronotable.plans.scd2 import incoming_rows
from chronotable.plans.spec import Dimension


def scd1_upsert(open_rows: DataFrame, batch: DataFrame, dimension: Dimension) -> DataFrame:
    """The open table after every batch row replaced, or joined, the row of its key."""
    incoming = incoming_rows(dimension.enrich(batch), dimension)
    return upsert(open_rows, incoming, [ROW_KEY], source_unique=dimension.dedup)


def scd1_rejects(batch: DataFrame, dimension: Dimension) -> DataFrame:
    return duplicate_rejects(dimension.enrich(batch), dimension.ordering)
