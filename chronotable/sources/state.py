"""Versioned state of a type 2 dimension on plain parquet folders.

Layout below the root, where a run is ``<version>-<random>`` and the folders' own columns begin with
``__ct_``, which a batch column must not::

    rows/__ct_run=<run>/__ct_state=open/__ct_part=<bucket>/   open rows, by hash bucket of the row key
    rows/__ct_run=<run>/__ct_state=closed/__ct_part=<day>/    rows that the run ended, by the day they ended
    rejects/__ct_run=<run>/                                   rows that the run refused
    versions/v-<n>.json                                       created last and at once: version n exists
    batches/<hash>                                            a batch id of a version before the newest

A batch is compared with two narrow columns of the open buckets it touches. The buckets it changes
are then read once and written once, open and closed rows together, in folders of this run alone;
last comes the one small version file, which says who holds each bucket, and so publishes rows and
rejects at the same time. Nothing is ever overwritten: a run that dies half-way leaves the last version as it
was, and folders that no version names (``remove_orphans`` deletes them). Buckets that a batch does not change are
not rewritten. Of two runs that start from the same version one creates its file; the other fails and changes nothing.

A version file is as large as the number of buckets and names its own run only, and a run reads no version
but the newest, so a batch costs the same after a thousand versions. Readers of closed rows and rejects
join the run folders with the version files; ``compact`` gathers them in one run.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotable.functions.columns import col, pick
from chronotable.operators.checks import assert_unique
from chronotable.operators.classify import end_versions, incoming_status, split_by_status
from chronotable.operators.columns import ROW_KEY, STATUS, VALID_TO
from chronotable.operators.dedup import mark_duplicates
from chronotable.operators.rejects import REJECT_SCHEMA, reject_rows
from chronotable.operators.status import Status
from chronotable.plans.scd2 import State
from chronotable.plans.spec import Dimension
from chronotable.sources.readers import conform
from chronotable.sources.workspace import create_once, exists, names_in, read_text, remove, scratch

_RUN, _STATE, _PART, _ENDED = "__ct_run", "__ct_state", "__ct_part", "__ct_ended"
_OPEN, _CLOSED = "open", "closed"
CLOSED_ON = "closed_on"

# What readers of many versions need of each.
_RUNS = "number int, run string, compacted boolean"


@dataclass(frozen=True)
class Version:
    """One published version.

    ``held_by`` names the run whose folder holds each open bucket that has rows. A ``compacted``
    version's run holds all closed rows and rejects up to it.
    """

    number: int
    run: str
    batch_id: str | None
    batch_schema: T.StructType
    open_schema: T.StructType
    buckets: int
    held_by: Mapping[int, str]
    compacted: bool = False


class HistoryStore:
    """Open, closed and reject tables that move from version to version together.

    ``buckets`` is the number of parts of the open table. A batch rewrites the buckets in which it changes a row,
    so choose it by the size one task should write: the open table's bytes / 256 MB, say. It is kept
    from the first version on; ``compact`` can change it.
    """

    def __init__(self, spark: SparkSession, root: str, dimension: Dimension, buckets: int) -> None:
        self._spark = spark
        self._root = root.rstrip("/")
        self._dimension = dimension
        self._buckets = buckets

    # Reading

    def _file(self, number: int) -> str:
        return f"{self._root}/versions/v-{number:010d}.json"

    def _numbers(self) -> list[int]:
        names = names_in(self._spark, f"{self._root}/versions")
        return sorted(int(n[2:-5]) for n in names if n.startswith("v-") and n.endswith(".json"))

    def version(self, number: int | None = None) -> Version | None:
        """A published version, by default the newest; None before the first."""
        numbers = self._numbers()
        if number is None:
            if not numbers:
                return None
            number = numbers[-1]
        elif number not in numbers:
            raise ValueError(f"there is no version {number}")
        row = json.loads(read_text(self._spark, self._file(number)))
        return Version(
            row["number"],
            row["run"],
            row["batch_id"],
            T.StructType.fromDDL(row["batch_ddl"]),
            T.StructType.fromDDL(row["open_ddl"]),
            row["buckets"],
            {int(b): run for b, run in row["held_by"].items()},
            row["compacted"],
        )

    def _read(self, table: str, folders: list[str], schema: T.StructType, required: bool = False) -> DataFrame:
        """Rows of folders below a table, which may be patterns, with the columns that the folders stand for.

        No folder may match a pattern, as not every run ends or refuses rows; ``required`` ones must all be there.
        """
        layout = T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in (_RUN, _STATE, _PART)]])
        base = f"{self._root}/{table}"
        try:
            if not folders:
                return self._spark.createDataFrame([], layout)
            reader = self._spark.read.schema(layout).option("basePath", base)
            return reader.parquet(*[f"{base}/{_RUN}={folder}" for folder in folders])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            if required:
                raise FileNotFoundError(f"a folder of open rows is gone from {base}: {error.getMessage()}") from error
            return self._spark.createDataFrame([], layout)

    def _open_of(self, version: Version, only: set[int] | None = None) -> DataFrame:
        folders = [
            f"{run}/{_STATE}={_OPEN}/{_PART}={bucket}"
            for bucket, run in sorted(version.held_by.items())
            if only is None or bucket in only
        ]
        return pick(self._read("rows", folders, version.open_schema, required=True), version.open_schema.fieldNames())

    def _published(self, rows: DataFrame, number: int) -> DataFrame:
        """Of rows of all runs those of versions up to a number, from the last compacted one on."""
        versions = self._spark.read.schema(_RUNS).json(f"{self._root}/versions/v-*.json").where(F.col("number") <= number)
        since = versions.where("compacted").agg(F.coalesce(F.max("number"), F.lit(0)))
        runs = versions.where(F.col("number") >= since.scalar()).select(F.col("run").alias(_RUN))
        return rows.join(runs, _RUN, "left_semi")

    def _closed_of(self, version: Version) -> DataFrame:
        rows = self._read("rows", [f"*/{_STATE}={_CLOSED}"], version.open_schema)
        return self._published(rows, version.number)

    def _rejects_of(self, version: Version) -> DataFrame:
        rows = self._published(self._read("rejects", ["*"], REJECT_SCHEMA), version.number)
        return pick(rows, REJECT_SCHEMA.fieldNames())

    def _newest(self, number: int | None) -> Version:
        version = self.version(number)
        if version is None:
            raise ValueError(f"nothing has been published under {self._root}")
        return version

    def state(self, number: int | None = None) -> State:
        """The three tables as of a version, by default the newest."""
        version = self._newest(number)
        closed = pick(self._closed_of(version), version.open_schema.fieldNames())
        return State(self._open_of(version), closed, self._rejects_of(version))

    def create_views(self, prefix: str, number: int | None = None) -> None:
        """Temporary views ``<prefix>_open``, ``_closed`` and ``_rejects`` of a version, for SQL by name."""
        state = self.state(number)
        for name, rows in (("open", state.open), ("closed", state.closed), ("rejects", state.rejects)):
            rows.createOrReplaceTempView(f"{prefix}_{name}")

    def closed_by_day(self, number: int | None = None) -> DataFrame:
        """Closed rows with the day they ended, ``closed_on``; a filter on it leaves other days' folders unread."""
        version = self._newest(number)
        names = version.open_schema.fieldNames()
        return self._closed_of(version).select(*[col(n) for n in names], F.col(_PART).cast("date").alias(CLOSED_ON))

    # Writing

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(col(ROW_KEY)), F.lit(buckets)).cast("int")

    def _marker(self, batch_id: str) -> str:
        return f"{self._root}/batches/{hashlib.sha256(batch_id.encode()).hexdigest()}"

    def apply(self, batch: DataFrame, batch_id: str | None = None) -> int:
        """Apply one batch and publish the next version; returns the newest version number.

        A ``batch_id`` that was published before is skipped.
        """
        clash = [n for n in batch.columns if n.lower().startswith("__ct_")]
        if clash:
            raise ValueError(f"these column names are reserved: {clash}")
        last = self.version()
        if batch_id is not None and last is not None:
            if last.batch_id == batch_id or exists(self._spark, self._marker(batch_id)):
                return last.number
        dimension = self._dimension
        if last is None:
            empty = dimension.empty_open(batch)
            last = Version(0, "", None, batch.schema, empty.schema, self._buckets, {})
        else:
            batch = conform(batch, last.batch_schema)
            if last.batch_id is not None:
                # From now on the newest version does not tell any more that it was applied.
                create_once(self._spark, self._marker(last.batch_id), "")
        number = last.number + 1
        run = f"{number}-{uuid.uuid4().hex}"
        bucket = self._bucket(last.buckets)

        with scratch(self._spark) as save:
            # One shuffle of the batch serves the rows that are kept and those that are refused.
            marked = save(mark_duplicates(dimension.enrich(batch), dimension.ordering, hot_rows=dimension.hot_rows))
            incoming = split_by_status(marked, Status.NA) if dimension.dedup else marked
            incoming = dimension.open_rows(incoming.drop(STATUS))
            # At most as many numbers as there are buckets.
            touched = {row[0] for row in incoming.select(bucket).distinct().collect()}
            open_rows = self._open_of(last, touched)
            outcome = save(incoming_status(incoming, open_rows, restricted=dimension.dedup, reject_late=dimension.rejects_late))
            updated = split_by_status(outcome, Status.UPDATED)
            if dimension.dedup:
                assert_unique(pick(outcome, [ROW_KEY]), [ROW_KEY], "the open table")
            else:
                assert_unique(pick(updated, [ROW_KEY]), [ROW_KEY], "changed rows of the batch")
            delta = split_by_status(outcome, Status.UPDATED, Status.INSERT)
            changed = {row[0] for row in delta.select(bucket).distinct().collect()}
            if changed:
                self._write_rows(run, self._open_of(last, changed), updated, delta.drop(STATUS), bucket)
            self._write_rejects(run, marked, outcome)
        self._publish(replace(last, number=number, run=run, batch_id=batch_id, held_by={**last.held_by, **dict.fromkeys(changed, run)}, compacted=False))
        return number

    def _write_rows(
        self,
        run: str,
        open_rows: DataFrame,
        updated: DataFrame,
        delta: DataFrame,
        bucket: Column,
    ) -> None:
        """The changed buckets and what ended in them, in one pass over the old open rows."""
        ended = F.col(_ENDED)
        moved = end_versions(open_rows, updated, _ENDED)
        day = F.to_date(col(VALID_TO)).cast("string")
        moved = moved.withColumns(
            {
                _STATE: F.when(ended, _CLOSED).otherwise(_OPEN),
                _PART: F.when(ended, day).otherwise(bucket.cast("string")),
            }
        ).drop(_ENDED)
        delta = delta.withColumns({_STATE: F.lit(_OPEN), _PART: bucket.cast("string")})
        self._write_parts(run, moved.unionByName(delta))

    def _write_parts(self, run: str, rows: DataFrame) -> None:
        # Gathers a partition's rows, but splits what would be too much for one task.
        rows = rows.hint("rebalance", F.col(_STATE), F.col(_PART))
        rows.write.partitionBy(_STATE, _PART).parquet(f"{self._root}/rows/{_RUN}={run}")

    def _write_rejects(self, run: str, marked: DataFrame, outcome: DataFrame) -> None:
        rejects = reject_rows(split_by_status(marked, Status.DUPLICATE_IN_MICRO_BATCH))
        refused = split_by_status(outcome, *self._dimension.refused)
        rejects = rejects.unionByName(reject_rows(refused))
        rejects.write.parquet(f"{self._root}/rejects/{_RUN}={run}")

    def _publish(self, version: Version) -> None:
        """Create the version file; an error if there is one of that number already."""
        row = {
            "number": version.number,
            "run": version.run,
            "batch_id": version.batch_id,
            "batch_ddl": version.batch_schema.toDDL(),
            "open_ddl": version.open_schema.toDDL(),
            "buckets": version.buckets,
            "held_by": version.held_by,
            "compacted": version.compacted,
        }
        if not create_once(self._spark, self._file(version.number), json.dumps(row)):
            raise RuntimeError(f"version {version.number} was published by another run; nothing has been changed")

    # Upkeep

    def compact(self, buckets: int | None = None) -> int:
        """Publish a version of the same rows in one run, by default with as many buckets; returns its number."""
        last = self._newest(None)
        number, buckets = last.number + 1, buckets or last.buckets
        run = f"{number}-{uuid.uuid4().hex}"
        if last.batch_id is not None:
            create_once(self._spark, self._marker(last.batch_id), "")
        bucket = self._bucket(buckets)
        closed = self._closed_of(last).withColumn(_STATE, F.lit(_CLOSED)).drop(_RUN)
        rows = self._open_of(last).withColumns({_STATE: F.lit(_OPEN), _PART: bucket.cast("string")})
        self._write_parts(run, rows.unionByName(closed))
        self._rejects_of(last).write.parquet(f"{self._root}/rejects/{_RUN}={run}")
        held = {row[0]: run for row in self._open_of(last).select(bucket).distinct().collect()}
        self._publish(replace(last, number=number, run=run, batch_id=None, buckets=buckets, held_by=held, compacted=True))
        return number

    def remove_orphans(self) -> int:
        """Delete the folders of runs that died before they published; returns how many.

        A run that is still at work is for the next version and is left alone.
        """
        numbers = self._numbers()
        newest = numbers[-1] if numbers else 0
        published = {json.loads(read_text(self._spark, self._file(n)))["run"] for n in numbers}
        gone = set()
        for table in ("rows", "rejects"):
            for name in names_in(self._spark, f"{self._root}/{table}"):
                run = name.removeprefix(f"{_RUN}=")
                if run != name and int(run.partition("-")[0]) <= newest and run not in published:
                    remove(self._spark, f"{self._root}/{table}/{name}")
                    gone.add(run)
        return len(gone)
