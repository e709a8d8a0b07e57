"""Compare a de-duplicated batch with the open rows and say what becomes of each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotable.functions.columns import col, pick, quoted
from chronotable.functions.timestamps import one_milli_before
from chronotable.operators.columns import (
    LEFT,
    RIGHT,
    ROW_KEY,
    ROW_MD5,
    STATUS,
    VALID_FROM,
    VALID_TO,
    prefix_columns,
    select_prefix,
    strip_prefix,
)
from chronotable.operators.rejects import reject_rows
from chronotable.operators.status import Status, status_lit

_LEFT_KEY, _RIGHT_KEY = LEFT + ROW_KEY, RIGHT + ROW_KEY
_NO_VALID_FROM = "a changed row needs a valid_from"


def restrict_existing(existing: DataFrame, incoming: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """Open rows whose key occurs in the batch.

    A semi join without a hint: Spark broadcasts the batch keys when they are small enough, so
    the open table is not shuffled, and falls back to a shuffled join when they are not. Distinct
    keys keep a batch that repeats one key from gathering in a task.
    """
    touched = existing.join(incoming.select(col(key)).distinct(), key, "left_semi")
    return pick(touched, existing.columns)


def left_join_prefixed(
    incoming: DataFrame, existing: DataFrame, how: str = "left"
) -> DataFrame:
    """Incoming rows (``left_*``) next to the open row with the same key (``right_*``)."""
    left, right = prefix_columns(incoming, LEFT), prefix_columns(existing, RIGHT)
    return left.join(right, left[_LEFT_KEY] == right[_RIGHT_KEY], how)


def new_keys(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows without an open row; the ``right_*`` columns are null."""
    left = left_join_prefixed(incoming, existing, "left_anti")
    return left.select(
        "*",
        *[F.lit(None).cast(f.dataType).alias(RIGHT + f.name) for f in existing.schema.fields],
    )


def known_keys(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows that have an open row."""
    return left_join_prefixed(incoming, existing, "inner")


def same_payload() -> Column:
    """Both sides carry the same payload fingerprint, in any letter case."""
    return F.lower(col(LEFT + ROW_MD5)).eqNullSafe(F.lower(col(RIGHT + ROW_MD5)))


def unchanged_rows(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    return known_keys(incoming, existing).where(same_payload())


def classify_changes(
    incoming: DataFrame, existing: DataFrame, reject_late: bool = False
) -> DataFrame:
    """``left_*``, ``right_*`` and ``status`` for every incoming row.

    No open row: ``INSERT``. Same payload: ``DUPLICATE_RECORD_OPEN``. Changed payload: two rows,
    ``UPDATED`` and ``CLOSED``, both with ``right_valid_to`` one millisecond before the new
    ``valid_from`` (a null there fails the query). One join; the second row is generated. With
    ``reject_late`` a changed payload that is not newer than the open row is one row, ``LATE_RECORD``.
    """
    joined = left_join_prefixed(incoming, existing)
    right_end = existing.schema[VALID_TO].dataType
    new_from = col(LEFT + VALID_FROM)
    ended = F.coalesce(
        one_milli_before(new_from, incoming.schema[VALID_FROM].dataType).cast(right_end),
        F.raise_error(_NO_VALID_FROM).cast(right_end),
    )

    def outcome(status: Status, end: Column) -> Column:
        return F.struct(status_lit(status).alias(STATUS), end.alias(RIGHT + VALID_TO))

    as_is = col(RIGHT + VALID_TO)
    outcomes = (
        F.when(col(_RIGHT_KEY).isNull(), F.array(outcome(Status.INSERT, as_is)))
        .when(same_payload(), F.array(outcome(Status.DUPLICATE_RECORD_OPEN, as_is)))
        .when(
            F.lit(reject_late) & (new_from <= col(RIGHT + VALID_FROM)),
            F.array(outcome(Status.LATE_RECORD, as_is)),
        )
        .otherwise(F.array(outcome(Status.UPDATED, ended), outcome(Status.CLOSED, ended)))
    )
    kept = [n for n in joined.columns if n != RIGHT + VALID_TO]
    generated = joined.select(*[quoted(n) for n in kept], F.inline(outcomes))
    return pick(generated, [*joined.columns, STATUS])


def classify_restricted(
    incoming: DataFrame, existing: DataFrame, reject_late: bool = False
) -> DataFrame:
    """``classify_changes`` against only those open rows whose key is in the batch."""
    return classify_changes(incoming, restrict_existing(existing, incoming), reject_late)


def incoming_status(
    incoming: DataFrame, existing: DataFrame, restricted: bool = True, reject_late: bool = False
) -> DataFrame:
    """Incoming rows with ``INSERT``, ``UPDATED``, ``DUPLICATE_RECORD_OPEN`` or ``LATE_RECORD`` as their status.

    The same decision as ``classify_changes`` without carrying the old rows along: of the open
    table only the key and the fingerprint are read, and the begin if late rows are to be refused.
    """
    known = pick(existing, [ROW_KEY, ROW_MD5, *([VALID_FROM] if reject_late else [])])
    if restricted:
        known = restrict_existing(known, incoming)
    known = prefix_columns(known, RIGHT)
    joined = incoming.join(known, incoming[ROW_KEY] == known[_RIGHT_KEY], "left")
    same = F.lower(col(ROW_MD5)).eqNullSafe(F.lower(col(RIGHT + ROW_MD5)))
    status = (
        F.when(col(_RIGHT_KEY).isNull(), status_lit(Status.INSERT))
        .when(same, status_lit(Status.DUPLICATE_RECORD_OPEN))
    )
    if reject_late:
        is_late = col(VALID_FROM) <= col(RIGHT + VALID_FROM)
        status = status.when(is_late, status_lit(Status.LATE_RECORD))
    status = status.otherwise(status_lit(Status.UPDATED))
    return joined.select(*[quoted(n) for n in incoming.columns], status.alias(STATUS))


def end_versions(open_rows: DataFrame, updated: DataFrame, ended: str) -> DataFrame:
    """All open rows in one pass, with ``valid_to`` moved where ``updated`` has the key.

    The column named by ``ended`` tells which rows those are. A null ``valid_from`` in ``updated``
    fails the query.
    """
    end_type = open_rows.schema[VALID_TO].dataType
    end = F.coalesce(
        one_milli_before(col(VALID_FROM), updated.schema[VALID_FROM].dataType).cast(end_type),
        F.raise_error(_NO_VALID_FROM).cast(end_type),
    )
    ends = updated.select(col(ROW_KEY).alias("__key"), end.alias("__end"))
    joined = open_rows.join(ends, open_rows[ROW_KEY] == ends["__key"], "left")
    rows = joined.withColumns(
        {VALID_TO: F.coalesce("__end", VALID_TO), ended: F.col("__key").isNotNull()}
    )
    return pick(rows, [*open_rows.columns, ended])


def split_by_status(classified: DataFrame, *statuses: Status) -> DataFrame:
    return classified.where(col(STATUS).isin([int(s) for s in statuses]))


def closed_rows(classified: DataFrame) -> DataFrame:
    """Old versions that ended, with their new ``valid_to``."""
    return strip_prefix(select_prefix(split_by_status(classified, Status.CLOSED), RIGHT), RIGHT)


def open_delta(classified: DataFrame) -> DataFrame:
    """Rows that become the open version of their key."""
    changed = split_by_status(classified, Status.UPDATED, Status.INSERT)
    return strip_prefix(select_prefix(changed, LEFT), LEFT)


def incoming_of(classified: DataFrame, *statuses: Status) -> DataFrame:
    """Incoming rows that met one of these outcomes, with their status."""
    met = split_by_status(classified, *statuses)
    return strip_prefix(select_prefix(met, LEFT, STATUS), LEFT)


def open_duplicates(classified: DataFrame) -> DataFrame:
    """Incoming rows equal to the open row, with their status."""
    return incoming_of(classified, Status.DUPLICATE_RECORD_OPEN)


def open_duplicate_rejects(classified: DataFrame) -> DataFrame:
    return reject_rows(open_duplicates(classified))
