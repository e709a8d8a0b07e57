"""Queries over de-duplication, classification and whole dimension runs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotable.functions.render import row_text
from chronotable.operators.asof import as_of_join
from chronotable.operators.classify import (
    classify_changes,
    classify_restricted,
    closed_rows,
    known_keys,
    left_join_prefixed,
    new_keys,
    open_delta,
    open_duplicate_rejects,
    restrict_existing,
    split_by_status,
    unchanged_rows,
)
from chronotable.operators.columns import ROW_KEY
from chronotable.operators.dedup import (
    deduplicate,
    deduplicate_and_reject,
    duplicate_rejects,
    mark_duplicates,
)
from chronotable.operators.rejects import reject_rows
from chronotable.operators.status import Status, status_lit, status_name
from chronotable.plans.history import merge_history, merge_source, superseded
from chronotable.plans.scd1 import scd1_rejects, scd1_upsert
from chronotable.plans.scd2 import State, incoming_rows, scd2_changes, scd2_fold, scd2_run
from chronotable.plans.spec import Dimension
from chronotable.plans.timeline import History, chain_run, history_fold, history_run
from chronotable.plans.stored import history_into, merge_into, merge_on, scd1_into
from chronotable.sources.state import HistoryStore
from chronotable.sources.tables import append, create_table_like
from chronotable.sources.workspace import work_folder
from chronotable.streaming import stream_into
from chronotable.workloads.recipes import (
    BASE_TS,
    EVENTS,
    EVENTS_SQL,
    LATE_EVENTS_SQL,
    ORDER_HISTORY,
    ORDER_TIMELINE_SQL,
    ORDERS_SQL,
    PARTY,
    PARTY_COLUMNS,
    PARTY_SCD_SQL,
    PARTY_SQL,
    STEPS,
    TIMELINE_SQL,
    event_batches,
    events,
    order_batches,
    order_dimension,
    party_base,
    party_batch,
    party_changes,
    party_open,
    read,
    sql_milli_before,
    sql_timestamp,
    validity_sql,
)

# Duplicates


def dedup_keep(spark: SparkSession, sf: str) -> DataFrame:
    return deduplicate(PARTY.enrich(party_batch(spark, sf)), PARTY.ordering)


def dedup_reject(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_rejects(PARTY.enrich(party_batch(spark, sf)), PARTY.ordering)


def dedup_events_keep(spark: SparkSession, sf: str) -> DataFrame:
    return deduplicate_and_reject(EVENTS.enrich(events(spark, sf)), EVENTS.ordering)[0]


def dedup_events_reject(spark: SparkSession, sf: str) -> DataFrame:
    return deduplicate_and_reject(EVENTS.enrich(events(spark, sf)), EVENTS.ordering)[1]


def batch_row_number(spark: SparkSession, sf: str) -> DataFrame:
    return mark_duplicates(EVENTS.enrich(events(spark, sf)), EVENTS.ordering)


def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return PARTY.enrich(party_batch(spark, sf)).select(ROW_KEY).distinct()


# Classification


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return incoming_rows(PARTY.enrich(party_batch(spark, sf)), PARTY), party_open(spark, sf)


def restricted(spark: SparkSession, sf: str) -> DataFrame:
    """Open rows of both batches' parties that the supplier half cannot touch are left out."""
    incoming, existing = _sides(spark, sf)
    return restrict_existing(existing, incoming.where(F.col("segment") == "CHANGED"))


def left_join(spark: SparkSession, sf: str) -> DataFrame:
    return left_join_prefixed(*_sides(spark, sf))


def only_new(spark: SparkSession, sf: str) -> DataFrame:
    return new_keys(*_sides(spark, sf))


def only_known(spark: SparkSession, sf: str) -> DataFrame:
    return known_keys(*_sides(spark, sf))


def unchanged(spark: SparkSession, sf: str) -> DataFrame:
    return unchanged_rows(*_sides(spark, sf))


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify_changes(*_sides(spark, sf))


def classified_restricted(spark: SparkSession, sf: str) -> DataFrame:
    return classify_restricted(*_sides(spark, sf))


def classified_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Classification of the later orders against the earlier ones, with counts per status."""
    dimension = order_dimension()
    early, late = order_batches(spark, sf)
    before, after = (incoming_rows(dimension.enrich(rows), dimension) for rows in (early, late))
    outcome = classify_restricted(after, before)
    return outcome.groupBy("status").agg(
        F.count("*").alias("row_count"),
        F.countDistinct("left_row_key").alias("key_count"),
        F.max("left_valid_from").alias("last_valid_from"),
    )


def union_classified(spark: SparkSession, sf: str) -> DataFrame:
    """Known keys with their outcome, then new keys as inserts."""
    incoming, existing = _sides(spark, sf)
    known = classify_changes(incoming, existing).where(F.col("right_row_key").isNotNull())
    inserts = new_keys(incoming, existing).withColumn("status", status_lit(Status.INSERT))
    return known.unionByName(inserts)


def split(spark: SparkSession, sf: str) -> DataFrame:
    return split_by_status(classified(spark, sf), Status.UPDATED, Status.CLOSED)


def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    outcome = classified(spark, sf)
    return outcome.groupBy("status").agg(F.count("*").alias("row_count"))


def status_names(spark: SparkSession, sf: str) -> DataFrame:
    return classified(spark, sf).select(
        "left_row_key", "status", status_name(F.col("status")).alias("status_name")
    )


def closed(spark: SparkSession, sf: str) -> DataFrame:
    return closed_rows(classified(spark, sf))


def delta(spark: SparkSession, sf: str) -> DataFrame:
    return open_delta(classified(spark, sf))


def open_duplicates_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return open_duplicate_rejects(classified(spark, sf))


def reject_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of a batch as a reject row."""
    batch = PARTY.enrich(party_batch(spark, sf))
    return reject_rows(batch.withColumn("status", status_lit(Status.DUPLICATE_RECORD_OPEN)))


# Runs


def _party_state(spark: SparkSession, sf: str) -> State:
    """The state after the base was loaded."""
    base = party_base(spark, sf)
    changes = scd2_changes(PARTY.empty_open(base), base, PARTY)
    return State(party_open(spark, sf), changes.closed, changes.rejects)


def _party_run(spark: SparkSession, sf: str) -> State:
    return scd2_run(_party_state(spark, sf), party_batch(spark, sf), PARTY)


def scd2_open(spark: SparkSession, sf: str) -> DataFrame:
    return _party_run(spark, sf).open


def scd2_close(spark: SparkSession, sf: str) -> DataFrame:
    return _party_run(spark, sf).closed


def scd2_reject(spark: SparkSession, sf: str) -> DataFrame:
    return _party_run(spark, sf).rejects


def _party_fold(spark: SparkSession, sf: str) -> State:
    return scd2_fold([party_base(spark, sf), party_batch(spark, sf)], PARTY)


def scd2_two_batches_open(spark: SparkSession, sf: str) -> DataFrame:
    return _party_fold(spark, sf).open


def scd2_two_batches_close(spark: SparkSession, sf: str) -> DataFrame:
    return _party_fold(spark, sf).closed


def scd2_two_batches_reject(spark: SparkSession, sf: str) -> DataFrame:
    return _party_fold(spark, sf).rejects


def scd2_events_open(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_fold(event_batches(spark, sf), EVENTS).open


def scd2_events_close(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_fold(event_batches(spark, sf), EVENTS).closed


def scd2_events_reject(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_fold(event_batches(spark, sf), EVENTS).rejects


def _event_store(spark: SparkSession, sf: str) -> State:
    """The same batches through the versioned store; the last one is offered twice."""
    store = HistoryStore(spark, work_folder(spark), EVENTS, buckets=8)
    batches = event_batches(spark, sf)
    for number, batch in enumerate([*batches, batches[-1]]):
        store.apply(batch, f"batch-{min(number, 2)}")
    return store.state()


def store_open(spark: SparkSession, sf: str) -> DataFrame:
    return _event_store(spark, sf).open


def store_close(spark: SparkSession, sf: str) -> DataFrame:
    return _event_store(spark, sf).closed


def store_reject(spark: SparkSession, sf: str) -> DataFrame:
    return _event_store(spark, sf).rejects


def stream_open(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed in two steps and streamed into a store, a file at a time; then progress is lost.

    The stream that starts anew reads everything again, which changes nothing.
    """
    folder = work_folder(spark)
    store = HistoryStore(spark, f"{folder}/store", order_dimension(), buckets=8)

    def run(progress: str) -> None:
        schema = read(spark, sf, "orders").schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landed")
        stream_into(stream, store, f"{folder}/{progress}", "orders").awaitTermination()

    for rows in order_batches(spark, sf):
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/landed")
        run("progress")
    run("lost")
    return store.state().open


def scd1(spark: SparkSession, sf: str) -> DataFrame:
    return scd1_upsert(party_open(spark, sf), party_batch(spark, sf), PARTY)


def scd1_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return scd1_rejects(party_batch(spark, sf), PARTY)


def scd2_without_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """A batch taken as it is, with no open duplicates reported.

    Suppliers come twice and are opened twice; the repeats are still rejected as such, so every
    table of the run shows, each row as text.
    """
    dimension = Dimension(
        PARTY.keys, PARTY.valid_from, dedup=False, reject_open_duplicates=False
    )
    state = State(party_open(spark, sf), *_party_tables(spark, sf, dimension))
    changes = party_changes(spark, sf)
    batch = changes.unionByName(changes.where("kind = 'S'"))
    after = scd2_run(state, batch, dimension)

    def shown(rows: DataFrame, table: str) -> DataFrame:
        return rows.select(F.lit(table).alias("part"), row_text(rows).alias("row_text"))

    return (
        shown(after.open, "open")
        .unionByName(shown(after.closed, "closed"))
        .unionByName(after.rejects.select(F.concat(F.lit("reject "), "reason").alias("part"), F.col("rowData").alias("row_text")))
    )


def scd2_late_reject(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the second date range, then those of the first: what changed comes too late."""
    strict = Dimension(EVENTS.keys, EVENTS.valid_from, EVENTS.ignore, late="reject")
    first, second, _ = event_batches(spark, sf)
    return scd2_fold([second, first], strict).rejects


def _late_events(spark: SparkSession, sf: str) -> History:
    """The last date range first, the first one last."""
    return history_fold(reversed(event_batches(spark, sf)), STEPS)


def scd2_late_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _late_events(spark, sf).versions


def scd2_late_confirmed(spark: SparkSession, sf: str) -> DataFrame:
    return _late_events(spark, sf).confirmed.drop("valid_to")


def _event_chain(spark: SparkSession, sf: str) -> State:
    """All events of the first date range in one batch, all others in a second one."""
    first, *rest = event_batches(spark, sf)
    return chain_run(chain_run(None, first, STEPS), rest[0].unionByName(rest[1]), STEPS)


def scd2_chain(spark: SparkSession, sf: str) -> DataFrame:
    state = _event_chain(spark, sf)
    return state.open.unionByName(state.closed)


def scd2_chain_reject(spark: SparkSession, sf: str) -> DataFrame:
    return _event_chain(spark, sf).rejects


def as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Every order with what its customer's newest order was 45 days later, by the history of all orders."""
    orders = read(spark, sf, "orders")
    history = history_run(None, orders, ORDER_HISTORY)
    facts = orders.select("o_orderkey", "o_custkey", (F.col("o_orderdate") + F.expr("INTERVAL '45' DAY")).alias("looked_at"))
    joined = as_of_join(facts, history.versions, ["o_custkey"], "looked_at")
    return joined.select("o_orderkey", "o_custkey", "looked_at", "version_o_orderkey", "version_o_orderstatus", "version_valid_from")


def _party_tables(
    spark: SparkSession, sf: str, dimension: Dimension
) -> tuple[DataFrame, DataFrame]:
    base = party_base(spark, sf)
    changes = scd2_changes(dimension.empty_open(base), base, dimension)
    return changes.closed, changes.rejects


# One-table history


def _history_base(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer and every nation open, and an ended version of each customer in a low nation."""
    nations = read(spark, sf, "nation").select(
        (F.col("n_nationkey") + 1_000_000_000).cast("bigint").alias("party_id"),
        F.col("n_name").alias("name"),
        F.col("n_nationkey").alias("nation"),
        F.lit("NATION").alias("segment"),
        F.lit(None).cast("double").alias("balance"),
        F.lit(BASE_TS).cast("timestamp_ntz").alias("update_ts"),
    )
    base = party_base(spark, sf).drop("kind").unionByName(nations)
    end = F.lit(None).cast("timestamp_ntz")
    now = base.withColumns({"active_ind": F.lit("Y"), "end_dt": end})
    before = base.where("nation < 10 AND segment <> 'NATION'").withColumns(
        {
            "segment": F.lit("EARLIER"),
            "active_ind": F.lit("N"),
            "end_dt": F.lit("2023-06-30 00:00:00").cast("timestamp_ntz"),
        }
    )
    return now.unionByName(before)


def _history_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as it is now, and suppliers under negative numbers; no nation has landed."""
    number = F.when(F.col("kind") == "S", -1 - F.col("party_id")).otherwise(F.col("party_id"))
    return party_changes(spark, sf).withColumn("party_id", number).drop("kind")


AS_OF = "2024-06-01 00:00:00"


def _history(spark: SparkSession, sf: str):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return _history_base(spark, sf), _history_landing(spark, sf), "party_id", as_of


def scd2_null_key_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merge_history(*_history(spark, sf))


def history_into_table(spark: SparkSession, sf: str) -> DataFrame:
    base, landing, key, as_of = _history(spark, sf)
    return history_into(_stored(base, "history"), landing, key, as_of)


def scd1_into_table(spark: SparkSession, sf: str) -> DataFrame:
    return scd1_into(_stored(party_open(spark, sf), "open"), party_batch(spark, sf), PARTY)


def merge_into_table(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in a table; the changes are merged into it twice, which is the same as once."""
    name = _stored(party_base(spark, sf), "party")
    for _ in range(2):
        merge = merge_on(spark, name).using(party_changes(spark, sf)).on_keys(["kind", "party_id"])
        merge_into(merge.when_matched().update_all().when_not_matched().insert_all(), name)
    return spark.sql(f"SELECT * FROM {name}")


def merge_into_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in a table partitioned by nation; nations that change are merged, others are neither read nor written."""
    name = _stored(party_base(spark, sf), "party", ["nation"])
    changes = party_changes(spark, sf).where("segment = 'CHANGED' OR kind = 'S' AND nation > 20")
    merge = merge_on(spark, name).using(changes).on_keys(["kind", "party_id"])
    merge_into(merge.when_matched("source.nation = 0").delete().when_matched().update_all().when_not_matched().insert_all(), name)
    return spark.sql(f"SELECT {PARTY_COLUMNS} FROM {name}")


def _stored(rows: DataFrame, stem: str, partition_by: Sequence[str] = ()) -> str:
    """The name of a new table with these rows."""
    name = f"{stem}_{uuid.uuid4().hex}"
    create_table_like(rows, name, partition_by, work_folder(rows.sparkSession))
    append(rows, name)
    return name


def merge_source_union(spark: SparkSession, sf: str) -> DataFrame:
    return merge_source(*_history(spark, sf))


def in_subquery_correlated(spark: SparkSession, sf: str) -> DataFrame:
    base, landing, key, _ = _history(spark, sf)
    return superseded(base, landing, key).select(base.columns)


QUERIES = {
    "dedup_keep": dedup_keep,
    "dedup_reject": dedup_reject,
    "dedup_events_keep": dedup_events_keep,
    "dedup_events_reject": dedup_events_reject,
    "batch_row_number": batch_row_number,
    "distinct_keys": distinct_keys,
    "restrict_existing": restricted,
    "left_join_prefixed": left_join,
    "new_keys": only_new,
    "known_keys": only_known,
    "unchanged_rows": unchanged,
    "classify_changes": classified,
    "classify_restricted": classified_restricted,
    "classify_orders": classified_orders,
    "union_classified": union_classified,
    "split_by_status": split,
    "status_counts": status_counts,
    "status_names": status_names,
    "closed_rows": closed,
    "open_delta": delta,
    "open_duplicate_rejects": open_duplicates_rejected,
    "reject_rows": reject_text,
    "scd2_open": scd2_open,
    "scd2_close": scd2_close,
    "scd2_reject": scd2_reject,
    "scd2_two_batches_open": scd2_two_batches_open,
    "scd2_two_batches_close": scd2_two_batches_close,
    "scd2_two_batches_reject": scd2_two_batches_reject,
    "scd2_events_open": scd2_events_open,
    "scd2_events_close": scd2_events_close,
    "scd2_events_reject": scd2_events_reject,
    "store_open": store_open,
    "store_close": store_close,
    "store_reject": store_reject,
    "stream_open": stream_open,
    "scd1_upsert": scd1,
    "scd1_reject": scd1_rejected,
    "scd2_without_dedup": scd2_without_dedup,
    "scd2_late_reject": scd2_late_reject,
    "scd2_late_insert": scd2_late_insert,
    "scd2_late_confirmed": scd2_late_confirmed,
    "scd2_chain": scd2_chain,
    "scd2_chain_reject": scd2_chain_reject,
    "as_of_join": as_of,
    "scd2_null_key_merge": scd2_null_key_merge,
    "history_into_table": history_into_table,
    "scd1_into_table": scd1_into_table,
    "merge_into_table": merge_into_table,
    "merge_into_partitions": merge_into_partitions,
    "merge_source_union": merge_source_union,
    "in_subquery_correlated": in_subquery_correlated,
}


# The same in SQL

_OPEN = f"{PARTY_COLUMNS}, row_md5, row_key, valid_from, valid_to, delete_indicator"
_OPEN_NAMES = [n.strip() for n in _OPEN.split(",")]
_JOINED = ", ".join(
    [f"l.{n} AS left_{n}" for n in _OPEN_NAMES]
    + [f"r.{n} AS right_{n}" for n in _OPEN_NAMES if n != "valid_to"]
)
_ENDED = sql_milli_before("l.valid_from")
_BOTH = "incoming l LEFT JOIN base_open r ON l.row_key = r.row_key"

_CLASSIFIED = f"""{PARTY_SCD_SQL},
classified AS (
  SELECT {_JOINED}, r.valid_to AS right_valid_to, 5 AS status
  FROM {_BOTH} WHERE r.row_key IS NULL
  UNION ALL
  SELECT {_JOINED}, r.valid_to, 3 FROM {_BOTH} WHERE l.row_md5 = r.row_md5
  UNION ALL
  SELECT {_JOINED}, {_ENDED}, s.status
  FROM {_BOTH}, (VALUES (4), (2)) s(status) WHERE l.row_md5 <> r.row_md5),
closed AS (
  SELECT {', '.join(f'right_{n} AS {n}' for n in _OPEN_NAMES)} FROM classified WHERE status = 2),
delta AS (
  SELECT {', '.join(f'left_{n} AS {n}' for n in _OPEN_NAMES)}
  FROM classified WHERE status IN (4, 5)),
next_open AS (
  SELECT {_OPEN} FROM base_open WHERE row_key NOT IN (SELECT row_key FROM delta)
  UNION ALL SELECT {_OPEN} FROM delta)"""


def _row_text(names: list[str], stamps: tuple[str, ...]) -> str:
    texts = [
        sql_timestamp(n) if n in stamps else f"coalesce(CAST({n} AS VARCHAR), 'null')"
        for n in names
    ]
    return "'[' || " + " || ',' || ".join(texts) + " || ']'"


_STAMPS = ("update_ts", "valid_from", "valid_to", "ts", "o_orderdate")
_BATCH_NAMES = _OPEN_NAMES[:9]
_BATCH_REJECTS = f"""
SELECT 'DUPLICATE_IN_MICRO_BATCH' AS reason,
       {_row_text([*_BATCH_NAMES, '1'], _STAMPS)} AS "rowData"
FROM marked WHERE rn > 1"""
_LEFT_NAMES = [f"left_{n}" for n in _OPEN_NAMES]
_OPEN_REJECTS = f"""
SELECT 'DUPLICATE_RECORD_OPEN' AS reason,
       {_row_text([*_LEFT_NAMES, '3'], tuple(f'left_{n}' for n in _STAMPS))} AS "rowData"
FROM classified WHERE status = 3"""

_EVENT_NAMES = ["event_id", "ts", "user_id", "event_type", "value", "props", "row_md5", "row_key"]
_ENDS = ["valid_from", "valid_to", "delete_indicator"]
_EVENT_OPEN = f"WITH {EVENTS_SQL} SELECT * FROM open3"
_EVENT_CLOSED = f"""WITH {EVENTS_SQL}
SELECT * FROM closed1 UNION ALL SELECT * FROM closed2 UNION ALL SELECT * FROM closed3"""
_EVENT_REJECTS = f"""WITH {EVENTS_SQL}
SELECT 'DUPLICATE_IN_MICRO_BATCH' AS reason,
       {_row_text([*_EVENT_NAMES, '1'], _STAMPS)} AS "rowData"
FROM marked WHERE rn > 1
UNION ALL
SELECT 'DUPLICATE_RECORD_OPEN', {_row_text([*_EVENT_NAMES, *_ENDS, '3'], _STAMPS)}
FROM (SELECT * FROM same1 UNION ALL SELECT * FROM same2 UNION ALL SELECT * FROM same3)"""

_ALL_EVENTS = f"""WITH {EVENTS_SQL},
ranked AS (
  SELECT {', '.join(_EVENT_NAMES)}, row_number() OVER (
    PARTITION BY row_key ORDER BY ts, event_id, user_id, event_type, value, props) AS place
  FROM enriched)"""

_HISTORY = f"""{PARTY_SCD_SQL},
hist AS (
  SELECT party_id, name, nation, segment, balance, update_ts, 'Y' AS active_ind,
         CAST(NULL AS TIMESTAMP) AS end_dt FROM base_raw
  UNION ALL
  SELECT CAST(n_nationkey + 1000000000 AS BIGINT), n_name, n_nationkey, 'NATION', NULL,
         TIMESTAMP '{BASE_TS}', 'Y', NULL FROM nation
  UNION ALL
  SELECT party_id, name, nation, 'EARLIER', balance, update_ts, 'N', TIMESTAMP '2023-06-30 00:00:00'
  FROM base_raw WHERE nation < 10),
land AS (
  SELECT CASE WHEN kind = 'S' THEN -1 - party_id ELSE party_id END AS party_id, name, nation,
         segment, balance, update_ts
  FROM changes_raw)"""

_NULL_KEY_MERGE = f"""WITH {_HISTORY}
SELECT party_id, name, nation, segment, balance, update_ts,
       CASE WHEN active_ind = 'Y' AND hit THEN 'N' ELSE active_ind END AS active_ind,
       CASE WHEN active_ind = 'Y' AND hit THEN TIMESTAMP '{AS_OF}' ELSE end_dt END AS end_dt
FROM (SELECT *, party_id IN (SELECT party_id FROM land) AS hit FROM hist)
UNION ALL
SELECT party_id, name, nation, segment, balance, update_ts, 'Y', NULL FROM land"""

_SCD1 = f"""WITH {PARTY_SCD_SQL}
SELECT {_OPEN} FROM incoming
UNION ALL
SELECT {_OPEN} FROM base_open WHERE row_key NOT IN (SELECT row_key FROM incoming)"""

SQL = {
    "dedup_keep": f"WITH {PARTY_SCD_SQL} SELECT * EXCLUDE (rn) FROM marked WHERE rn = 1",
    "dedup_reject": f"WITH {PARTY_SCD_SQL} {_BATCH_REJECTS}",
    "dedup_events_keep": f"{_ALL_EVENTS} SELECT * EXCLUDE (place) FROM ranked WHERE place = 1",
    "dedup_events_reject": f"""{_ALL_EVENTS}
SELECT 'DUPLICATE_IN_MICRO_BATCH' AS reason,
       {_row_text([*_EVENT_NAMES, '1'], _STAMPS)} AS "rowData"
FROM ranked WHERE place > 1""",
    "batch_row_number": f"""{_ALL_EVENTS}
SELECT * EXCLUDE (place), CASE WHEN place > 1 THEN 1 ELSE 0 END AS status FROM ranked""",
    "distinct_keys": f"WITH {PARTY_SCD_SQL} SELECT DISTINCT row_key FROM batch",
    "restrict_existing": f"""WITH {PARTY_SCD_SQL}
SELECT * FROM base_open
WHERE row_key IN (SELECT row_key FROM incoming WHERE segment = 'CHANGED')""",
    "left_join_prefixed": f"""WITH {PARTY_SCD_SQL}
SELECT {_JOINED}, r.valid_to AS right_valid_to FROM {_BOTH}""",
    "new_keys": f"""WITH {PARTY_SCD_SQL}
SELECT {_JOINED}, r.valid_to AS right_valid_to FROM {_BOTH} WHERE r.row_key IS NULL""",
    "known_keys": f"""WITH {PARTY_SCD_SQL}
SELECT {_JOINED}, r.valid_to AS right_valid_to FROM {_BOTH} WHERE r.row_key IS NOT NULL""",
    "unchanged_rows": f"""WITH {PARTY_SCD_SQL}
SELECT {_JOINED}, r.valid_to AS right_valid_to FROM {_BOTH} WHERE l.row_md5 = r.row_md5""",
    "classify_changes": f"WITH {_CLASSIFIED} SELECT * FROM classified",
    "classify_restricted": f"WITH {_CLASSIFIED} SELECT * FROM classified",
    "classify_orders": f"""WITH {ORDERS_SQL},
outcomes AS (
  SELECT 5 AS status, row_key, valid_from FROM compared WHERE known IS NULL
  UNION ALL SELECT 3, row_key, valid_from FROM compared WHERE same
  UNION ALL SELECT s.status, row_key, valid_from
  FROM compared, (VALUES (4), (2)) s(status) WHERE NOT same)
SELECT status, count(*) AS row_count, count(DISTINCT row_key) AS key_count,
       max(valid_from) AS last_valid_from
FROM outcomes GROUP BY status""",
    "union_classified": f"WITH {_CLASSIFIED} SELECT * FROM classified",
    "split_by_status": f"WITH {_CLASSIFIED} SELECT * FROM classified WHERE status IN (2, 4)",
    "status_counts": f"""WITH {_CLASSIFIED}
SELECT status, count(*) AS row_count FROM classified GROUP BY status""",
    "status_names": f"""WITH {_CLASSIFIED}
SELECT left_row_key, status,
       CASE status WHEN 2 THEN 'CLOSED' WHEN 3 THEN 'DUPLICATE_RECORD_OPEN'
                   WHEN 4 THEN 'UPDATED' WHEN 5 THEN 'INSERT' END AS status_name
FROM classified""",
    "closed_rows": f"WITH {_CLASSIFIED} SELECT * FROM closed",
    "open_delta": f"WITH {_CLASSIFIED} SELECT * FROM delta",
    "open_duplicate_rejects": f"WITH {_CLASSIFIED} {_OPEN_REJECTS}",
    "reject_rows": f"""WITH {PARTY_SCD_SQL}
SELECT 'DUPLICATE_RECORD_OPEN' AS reason,
       {_row_text([*_BATCH_NAMES, '3'], _STAMPS)} AS "rowData"
FROM batch""",
    "scd2_open": f"WITH {_CLASSIFIED} SELECT * FROM next_open",
    "scd2_close": f"WITH {_CLASSIFIED} SELECT * FROM closed",
    "scd2_reject": f"WITH {_CLASSIFIED} {_BATCH_REJECTS} UNION ALL {_OPEN_REJECTS}",
    "scd2_two_batches_open": f"WITH {_CLASSIFIED} SELECT * FROM next_open",
    "scd2_two_batches_close": f"WITH {_CLASSIFIED} SELECT * FROM closed",
    "scd2_two_batches_reject": f"WITH {_CLASSIFIED} {_BATCH_REJECTS} UNION ALL {_OPEN_REJECTS}",
    "scd2_events_open": _EVENT_OPEN,
    "scd2_events_close": _EVENT_CLOSED,
    "scd2_events_reject": _EVENT_REJECTS,
    "store_open": _EVENT_OPEN,
    "store_close": _EVENT_CLOSED,
    "store_reject": _EVENT_REJECTS,
    "stream_open": f"""WITH {ORDERS_SQL}
SELECT * EXCLUDE (batch_no, known, same) FROM compared WHERE known IS NULL OR NOT same
UNION ALL
SELECT * EXCLUDE (batch_no) FROM kept
WHERE batch_no = 1 AND row_key NOT IN (SELECT row_key FROM compared WHERE NOT coalesce(same, false))""",
    "scd1_upsert": _SCD1,
    "scd1_into_table": _SCD1,
    "scd1_reject": f"WITH {PARTY_SCD_SQL} {_BATCH_REJECTS}",
    "scd2_without_dedup": f"""WITH {_CLASSIFIED},
twice AS (SELECT * FROM changes WHERE kind = 'S')
SELECT 'open' AS part, {_row_text(_OPEN_NAMES, _STAMPS)} AS row_text
FROM (SELECT {_OPEN} FROM next_open UNION ALL SELECT {_OPEN} FROM twice)
UNION ALL
SELECT 'closed', {_row_text(_OPEN_NAMES, _STAMPS)} FROM closed
UNION ALL
SELECT 'reject DUPLICATE_IN_MICRO_BATCH', {_row_text([*_BATCH_NAMES, '1'], _STAMPS)} FROM twice""",
    "scd2_late_insert": f"WITH {TIMELINE_SQL} SELECT {', '.join([*_EVENT_NAMES, *_ENDS])} FROM versions",
    "scd2_late_confirmed": f"WITH {TIMELINE_SQL} SELECT {', '.join(_EVENT_NAMES)}, ts AS valid_from, 'NA' AS delete_indicator FROM points WHERE NOT starts",
    "scd2_chain": f"WITH {TIMELINE_SQL} SELECT {', '.join([*_EVENT_NAMES, *_ENDS])} FROM versions",
    "scd2_chain_reject": f"""WITH {TIMELINE_SQL}
SELECT 'DUPLICATE_IN_MICRO_BATCH' AS reason, {_row_text([*_EVENT_NAMES, '1'], _STAMPS)} AS "rowData" FROM moments WHERE place > 1
UNION ALL
SELECT 'DUPLICATE_RECORD_OPEN', {_row_text([*_EVENT_NAMES, *_ENDS, '3'], _STAMPS)}
FROM (SELECT *, {validity_sql('ts')} FROM points WHERE NOT starts)""",
    "as_of_join": f"""WITH {ORDER_TIMELINE_SQL}
SELECT f.o_orderkey, f.o_custkey, f.o_orderdate + INTERVAL 45 DAY AS looked_at,
       v.o_orderkey AS version_o_orderkey, v.o_orderstatus AS version_o_orderstatus, v.o_orderdate AS version_valid_from
FROM orders f LEFT JOIN versions v ON f.o_custkey = v.o_custkey
  AND v.o_orderdate <= f.o_orderdate + INTERVAL 45 DAY
  AND (v.following IS NULL OR f.o_orderdate + INTERVAL 45 DAY < v.following)""",
    "scd2_late_reject": f"""WITH {LATE_EVENTS_SQL}
SELECT 'DUPLICATE_IN_MICRO_BATCH' AS reason,
       {_row_text([*_EVENT_NAMES, '1'], _STAMPS)} AS "rowData"
FROM marked WHERE rn > 1 AND batch_no < 3
UNION ALL
SELECT CASE WHEN same THEN 'DUPLICATE_RECORD_OPEN' ELSE 'LATE_RECORD' END,
       {_row_text([*_EVENT_NAMES, *_ENDS, 'CASE WHEN same THEN 3 ELSE 6 END'], _STAMPS)}
FROM paired WHERE known IS NOT NULL""",
    "scd2_null_key_merge": _NULL_KEY_MERGE,
    "history_into_table": _NULL_KEY_MERGE,
    "merge_into_table": f"""WITH {PARTY_SQL}
SELECT * FROM changes_raw
UNION ALL
SELECT * FROM base_raw WHERE (kind, party_id) NOT IN (SELECT (kind, party_id) FROM changes_raw)""",
    "merge_into_partitions": f"""WITH {PARTY_SQL},
chosen AS (SELECT * FROM changes_raw WHERE segment = 'CHANGED' OR kind = 'S' AND nation > 20)
SELECT * FROM chosen WHERE NOT (kind = 'C' AND nation = 0)
UNION ALL
SELECT * FROM base_raw WHERE (kind, party_id) NOT IN (SELECT (kind, party_id) FROM chosen)""",
    "merge_source_union": f"""WITH {_HISTORY}
SELECT CAST(NULL AS BIGINT) AS key_match, party_id, name, nation, segment, balance, update_ts,
       'Y' AS active_ind, TIMESTAMP '{AS_OF}' AS end_dt
FROM land
UNION ALL
SELECT party_id, party_id, name, nation, segment, balance, update_ts, active_ind, end_dt
FROM hist WHERE active_ind = 'Y' AND party_id IN (SELECT party_id FROM land)""",
    "in_subquery_correlated": f"""WITH {_HISTORY}
SELECT * FROM hist
WHERE party_id IN (SELECT party_id FROM land WHERE active_ind = 'Y')""",
}
