"""Type 2 dimension: open, closed and rejected rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotable.operators.checks import assert_unique
from chronotable.operators.classify import (
    classify_changes,
    classify_restricted,
    closed_rows,
    incoming_of,
    open_delta,
    split_by_status,
)
from chronotable.operators.columns import LEFT, ROW_KEY, STATUS
from chronotable.operators.dedup import deduplicate, duplicate_rejects, mark_duplicates
from chronotable.operators.merge import upsert
from chronotable.operators.rejects import reject_rows
from chronotable.operators.status import Status
from chronotable.plans.spec import Dimension
from chronotable.sources.workspace import materialize


@dataclass(frozen=True)
class Changes:
    """What one batch does to a dimension. Every frame is lazy."""

    delta: DataFrame
    closed: DataFrame
    rejects: DataFrame


@dataclass(frozen=True)
class State:
    """The three tables of a dimension."""

    open: DataFrame
    closed: DataFrame
    rejects: DataFrame


def incoming_rows(enriched: DataFrame, dimension: Dimension) -> DataFrame:
    """A fingerprinted batch as it would be opened: one row per key, with validity."""
    if dimension.dedup:
        enriched = deduplicate(enriched, dimension.ordering)
    return dimension.open_rows(enriched)


def _classified(incoming: DataFrame, open_rows: DataFrame, dimension: Dimension) -> DataFrame:
    classify = classify_restricted if dimension.dedup else classify_changes
    return classify(incoming, open_rows, dimension.rejects_late)


def classified_batch(
    open_rows: DataFrame, enriched: DataFrame, dimension: Dimension
) -> DataFrame:
    """Every incoming row with what becomes of it.

    A batch that was not de-duplicated may repeat one key a great many times. It is joined with the
    open table as that is, because adaptive execution cannot split a key of a join on a join.
    """
    return _classified(incoming_rows(enriched, dimension), open_rows, dimension)


def _changes(classified: DataFrame, in_batch: DataFrame, dimension: Dimension) -> Changes:
    against_open = reject_rows(incoming_of(classified, *dimension.refused))
    return Changes(open_delta(classified), closed_rows(classified), in_batch.unionByName(against_open))


def changes_of(classified: DataFrame, enriched: DataFrame, dimension: Dimension) -> Changes:
    """Split a classified batch. In-batch rejects are rendered before validity is added."""
    in_batch = duplicate_rejects(enriched, dimension.ordering, hot_rows=dimension.hot_rows)
    return _changes(classified, in_batch, dimension)


def apply_delta(open_rows: DataFrame, delta: DataFrame, dimension: Dimension) -> DataFrame:
    """The next open table. De-duplicated batches cannot compete for a row."""
    return upsert(open_rows, delta, [ROW_KEY], source_unique=dimension.dedup)


def scd2_changes(open_rows: DataFrame, batch: DataFrame, dimension: Dimension) -> Changes:
    enriched = dimension.enrich(batch)
    return changes_of(classified_batch(open_rows, enriched, dimension), enriched, dimension)


def scd2_run(state: State | None, batch: DataFrame, dimension: Dimension) -> State:
    """One batch: the state before it in, the state after it out.

    The batch is read, fingerprinted and ranked once; its marked rows are written, and both the rows that are
    kept and those that are refused come from there. The classified batch is written as well, as
    it feeds three outputs. An open table with two rows of one key of the batch is an error.
    """
    open_rows = dimension.empty_open(batch) if state is None else state.open
    enriched = dimension.enrich(batch)
    marked = materialize(mark_duplicates(enriched, dimension.ordering, hot_rows=dimension.hot_rows))
    incoming = split_by_status(marked, Status.NA) if dimension.dedup else marked
    incoming = dimension.open_rows(incoming.drop(STATUS))
    classified = materialize(_classified(incoming, open_rows, dimension))
    if dimension.dedup:
        # Each incoming key has one row but for what it closes, unless the open table repeats it.
        incoming_keys = classified.where(F.col(STATUS) != int(Status.CLOSED))
        assert_unique(incoming_keys, [LEFT + ROW_KEY], "the open table")
    in_batch = reject_rows(split_by_status(marked, Status.DUPLICATE_IN_MICRO_BATCH))
    changes = _changes(classified, in_batch, dimension)
    after = apply_delta(open_rows, changes.delta, dimension)
    if state is None:
        return State(after, changes.closed, changes.rejects)
    return State(
        after,
        state.closed.unionByName(changes.closed),
        state.rejects.unionByName(changes.rejects),
    )


def scd2_fold(
    batches: Iterable[DataFrame], dimension: Dimension, state: State | None = None
) -> State:
    """Batches in order.

    The open table is written between batches, so its plan does not grow with them. Closed and
    rejected rows are the union of one plan per batch: keep long sequences in a ``HistoryStore``.
    """
    for batch in batches:
        if state is not None:
            state = State(materialize(state.open), state.closed, state.rejects)
        state = scd2_run(state, batch, dimension)
    if state is None:
        raise ValueError("nothing to fold: no batches and no state")
    return state
