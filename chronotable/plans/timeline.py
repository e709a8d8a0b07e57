"""Histories that do not depend on the order in which rows arrive.

A ``History`` keeps every observation: the ones that begin a version (open or closed) and the ones that only confirm the
version they fall in. A batch brings any number of rows of a key, at any moment. The timelines of the keys
it touches are cut anew from all observations: a late row splits the version it falls in, a row between two equal ones
parts them, and equal neighbours melt together. Of several rows of one key and moment the first in the total order
stays and the others are refused, so the four tables are the same however the rows were dealt out to batches.

``chain_run`` is the two-table run for batches that hold several versions of a key, in one pass, when nothing comes late.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotable.functions.columns import col, pick
from chronotable.functions.timestamps import open_end
from chronotable.operators.checks import assert_unique
from chronotable.operators.columns import ROW_KEY, ROW_MD5, STATUS, VALID_FROM, VALID_TO
from chronotable.operators.dedup import mark_duplicates
from chronotable.operators.keys import splittable_keys
from chronotable.operators.rejects import reject_rows
from chronotable.operators.status import Status, status_lit
from chronotable.operators.timeline import STARTS, assert_moments, cut_versions, point_key
from chronotable.plans.scd2 import State
from chronotable.plans.spec import Dimension
from chronotable.sources.workspace import materialize

_POINT, _OLD = "__point", "__old"


@dataclass(frozen=True)
class History:
    """The tables of a dimension, and the rows that confirm a version without beginning one."""

    open: DataFrame
    closed: DataFrame
    confirmed: DataFrame
    rejects: DataFrame

    @property
    def versions(self) -> DataFrame:
        return self.open.unionByName(self.closed)


def _is_open(rows: DataFrame) -> Column:
    bound = rows.schema[VALID_TO].dataType
    return col(VALID_TO) == open_end(bound).cast(bound)


def history_run(state: History | None, batch: DataFrame, dimension: Dimension) -> History:
    """One batch, late or not: the history before it in, the one after it out.

    Keys that the batch does not touch are passed on as they are. A null valid-from fails the query.
    """
    incoming = dimension.open_rows(dimension.enrich(batch))
    assert_moments(incoming)
    names = incoming.columns
    end = open_end(incoming.schema[VALID_TO].dataType).cast(incoming.schema[VALID_TO].dataType)
    touched = splittable_keys(incoming.select(col(ROW_KEY)))
    pool = incoming
    if state is not None:
        for rows in (state.open, state.closed, state.confirmed):
            pool = pool.unionByName(pick(rows.join(touched, ROW_KEY, "left_semi"), names))
    # Where a version ended does not tell its first row from others.
    pool = pool.withColumn(VALID_TO, end).withColumn(_POINT, point_key())
    marked = materialize(mark_duplicates(pool, dimension.ordering, key=_POINT, hot_rows=dimension.hot_rows).drop(_POINT))
    points = marked.where(F.col(STATUS) == int(Status.NA)).drop(STATUS)
    cut = materialize(cut_versions(points, dimension.hot_rows))
    versions, confirmed = cut.where(STARTS).drop(STARTS), cut.where(~F.col(STARTS)).drop(STARTS)
    refused = pick(marked.where(F.col(STATUS) != int(Status.NA)), [*batch.columns, ROW_MD5, ROW_KEY, STATUS])
    after = History(versions.where(_is_open(versions)), versions.where(~_is_open(versions)), confirmed, reject_rows(refused))
    if state is None:
        return after

    def rest(rows: DataFrame) -> DataFrame:
        return pick(rows.join(touched, ROW_KEY, "left_anti"), names)

    return History(
        rest(state.open).unionByName(after.open),
        rest(state.closed).unionByName(after.closed),
        rest(state.confirmed).unionByName(after.confirmed),
        state.rejects.unionByName(after.rejects),
    )


def history_fold(batches: Iterable[DataFrame], dimension: Dimension, state: History | None = None) -> History:
    """Batches one after the other, in any order; the tables are written between them."""
    for batch in batches:
        if state is not None:
            state = History(*map(materialize, (state.open, state.closed, state.confirmed, state.rejects)))
        state = history_run(state, batch, dimension)
    if state is None:
        raise ValueError("nothing to fold: no batches and no state")
    return state


def chain_run(state: State | None, batch: DataFrame, dimension: Dimension) -> State:
    """``scd2_run`` for batches with several versions of a key: what running them row by row, oldest first, would give.

    Of rows of one key and moment the first in the total order counts. A row that says what the one before it said is refused as an open
    duplicate, one that is not newer than the open row of its key, and says something else, as late.
    """
    incoming = dimension.open_rows(dimension.enrich(batch))
    assert_moments(incoming)
    names = incoming.columns
    held = incoming.limit(0) if state is None else state.open
    touched = splittable_keys(incoming.select(col(ROW_KEY)))
    marked = mark_duplicates(incoming.withColumn(_POINT, point_key()), dimension.ordering, key=_POINT, hot_rows=dimension.hot_rows)
    marked = materialize(marked.drop(_POINT))
    fresh = marked.where(F.col(STATUS) == int(Status.NA)).drop(STATUS)
    old = materialize(pick(held.join(touched, ROW_KEY, "left_semi"), names))
    assert_unique(old, [ROW_KEY], "the open table")
    known = old.select(F.struct(VALID_FROM, ROW_MD5).alias("__was"), col(ROW_KEY).alias("__key"))
    beside = fresh.join(known, col(ROW_KEY) == F.col("__key"), "left")
    past = F.col("__key").isNotNull() & (col(VALID_FROM) <= F.col(f"__was.{VALID_FROM}"))
    same = F.lower(col(ROW_MD5)).eqNullSafe(F.lower(F.col(f"__was.{ROW_MD5}")))
    verdict = F.when(past & same, status_lit(Status.DUPLICATE_RECORD_OPEN)).when(past, status_lit(Status.LATE_RECORD)).otherwise(status_lit(Status.NA))
    judged = materialize(pick(beside.withColumn(STATUS, verdict), [*names, STATUS]))
    newer = judged.where(F.col(STATUS) == int(Status.NA)).drop(STATUS).withColumn(_OLD, F.lit(False))
    cut = materialize(cut_versions(old.withColumn(_OLD, F.lit(True)).unionByName(newer), dimension.hot_rows))
    versions = cut.where(STARTS).drop(STARTS, _OLD)
    again = cut.where(~F.col(STARTS)).drop(STARTS, _OLD).withColumn(STATUS, status_lit(Status.DUPLICATE_RECORD_OPEN))
    refused = judged.where(F.col(STATUS) != int(Status.NA)).unionByName(again)
    if not dimension.reject_open_duplicates:
        refused = refused.where(F.col(STATUS) != int(Status.DUPLICATE_RECORD_OPEN))
    twice = pick(marked.where(F.col(STATUS) != int(Status.NA)), [*batch.columns, ROW_MD5, ROW_KEY, STATUS])
    rejects = reject_rows(twice).unionByName(reject_rows(refused.withColumn(VALID_TO, open_end(incoming.schema[VALID_TO].dataType).cast(incoming.schema[VALID_TO].dataType))))
    opened, closed = versions.where(_is_open(versions)), versions.where(~_is_open(versions))
    if state is None:
        return State(opened, closed, rejects)
    stay = pick(state.open.join(touched, ROW_KEY, "left_anti"), names)
    return State(stay.unionByName(opened), state.closed.unionByName(closed), state.rejects.unionByName(rejects))
