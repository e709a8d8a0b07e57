"""What a dimension is made of."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from chronotable.functions.columns import require_columns
from chronotable.operators.columns import (
    DELETE_INDICATOR,
    RESERVED,
    VALID_FROM,
    VALID_TO,
    add_validity,
    enrich,
    reject_reserved,
)
from chronotable.operators.dedup import HOT_ROWS
from chronotable.operators.status import Status


@dataclass(frozen=True)
class Dimension:
    """Business key, valid-from column and run options of one dimension.

    ``ignore`` are further columns whose changes do not count. ``order_by`` says which of several
    batch rows with one key is kept (the first); it defaults to the valid-from column.
    ``dedup=False`` skips in-batch de-duplication, ``reject_open_duplicates=False`` does not
    report rows that equal the open row. ``late="reject"`` refuses changed rows that are not newer than the open
    row, which would otherwise end it before it began. ``hot_rows`` is how many rows of one key a task
    may sort; keys with more are spread.
    """

    keys: Sequence[str]
    valid_from: str
    ignore: Sequence[str] = ()
    order_by: Sequence[str | Column] | None = None
    dedup: bool = True
    reject_open_duplicates: bool = True
    sep: str = ""
    late: str = "accept"
    hot_rows: int = HOT_ROWS

    def __post_init__(self) -> None:
        if self.late not in ("accept", "reject"):
            raise ValueError(f"late must be accept or reject, not {self.late}")

    @property
    def ordering(self) -> Sequence[str | Column]:
        return [self.valid_from] if self.order_by is None else self.order_by

    @property
    def ignored(self) -> list[str]:
        """Columns left out of the payload fingerprint."""
        return [
            *self.keys, VALID_FROM, VALID_TO, self.valid_from, DELETE_INDICATOR, *self.ignore
        ]

    @property
    def rejects_late(self) -> bool:
        return self.late == "reject"

    @property
    def refused(self) -> list[Status]:
        """Outcomes against the open table that make a reject."""
        duplicates = [Status.DUPLICATE_RECORD_OPEN] if self.reject_open_duplicates else []
        return [*duplicates, Status.LATE_RECORD]

    def enrich(self, batch: DataFrame) -> DataFrame:
        reject_reserved(batch, RESERVED)
        require_columns(batch, [*self.keys, self.valid_from], "dimension columns")
        return enrich(batch, self.keys, self.ignored, self.sep)

    def open_rows(self, enriched: DataFrame) -> DataFrame:
        return add_validity(enriched, self.valid_from)

    def empty_open(self, batch: DataFrame) -> DataFrame:
        """The open table before the first batch: the right schema and no rows."""
        return self.open_rows(self.enrich(batch)).limit(0)
