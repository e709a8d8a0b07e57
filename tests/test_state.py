import datetime
import json
import re
import threading
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from chronotable.plans.spec import Dimension
from chronotable.sources.state import HistoryStore
from chronotable.sources.workspace import create_once, names_in, read_text
from chronotable.streaming import stream_into
from test_scd2 import BATCHES, CLOSED, DIMENSION, OPEN, REASONS, SCHEMA, day, reasons, versions


@pytest.fixture
def batches(spark):
    return [spark.createDataFrame(rows, SCHEMA) for rows in BATCHES]


@pytest.fixture
def store(spark, tmp_path):
    return HistoryStore(spark, str(tmp_path / "store"), DIMENSION, buckets=8)


def test_batches(store, batches):
    assert store.version() is None
    with pytest.raises(ValueError, match="nothing has been published"):
        store.state()
    assert [store.apply(b) for b in batches] == [1, 2, 3]
    now = store.state()
    assert versions(now.open) == OPEN
    assert versions(now.closed) == CLOSED
    assert reasons(now.rejects) == REASONS


def test_earlier_versions_stay_readable(spark, store, batches):
    for batch in batches:
        store.apply(batch)
    first = store.state(1)
    assert {r.id for r in first.open.collect()} == {"1", "2"}
    assert first.closed.count() == first.rejects.count() == 0
    assert store.state(2).closed.count() == 1
    store.create_views("people")
    joined = "SELECT count(*) FROM people_open JOIN people_closed USING (row_key)"
    assert spark.sql(joined).first()[0] == len(CLOSED)
    with pytest.raises(ValueError, match="no version 9"):
        store.state(9)


def test_a_batch_that_was_applied_is_skipped(store, batches):
    assert store.apply(batches[0], "a") == 1
    assert store.apply(batches[1], "b") == 2
    assert store.apply(batches[0], "a") == 2
    assert store.state().rejects.count() == 2


def test_only_changed_buckets_are_written(store, batches, tmp_path):
    store.apply(batches[0])
    store.apply(batches[1])
    before = store.version()
    store.apply(batches[2])
    after = store.version()
    changed = {b for b, run in after.held_by.items() if run.startswith("3-")}
    assert 0 < len(changed) <= 2
    assert all(after.held_by[b] == before.held_by[b] for b in before.held_by if b not in changed)
    written = (tmp_path / "store/rows").glob("__ct_run=3-*/__ct_state=open/__ct_part=*")
    assert {int(p.name.removeprefix("__ct_part=")) for p in written} == changed


def test_nothing_shows_before_it_is_published(store, batches, monkeypatch):
    store.apply(batches[0])
    store.apply(batches[1])
    shown = versions(store.state().open), versions(store.state().closed)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(HistoryStore, "_publish", fail)
        with pytest.raises(RuntimeError, match="lost"):
            store.apply(batches[2])
    assert store.version().number == 2
    assert (versions(store.state().open), versions(store.state().closed)) == shown
    assert store.apply(batches[2]) == 3
    assert versions(store.state().open) == OPEN
    assert versions(store.state().closed) == CLOSED
    assert reasons(store.state().rejects) == REASONS


def test_of_two_runs_from_one_version_one_is_published(spark, store, batches, monkeypatch):
    store.apply(batches[0])
    start = store.version()
    assert store.apply(batches[1], "first") == 2
    shown = versions(store.state().open)
    with monkeypatch.context() as patch:
        patch.setattr(HistoryStore, "version", lambda *_: start)
        with pytest.raises(RuntimeError, match="version 2 was published by another run"):
            store.apply(batches[2], "second")
    assert store.version().number == 2
    assert versions(store.state().open) == shown
    assert store.state().rejects.count() == 2


def test_schema_drift(spark, store, batches):
    store.apply(batches[0])
    with pytest.raises(ValueError, match="not expected \\['extra'\\]"):
        store.apply(batches[1].selectExpr("*", "1 AS extra"))
    with pytest.raises(ValueError, match="missing \\['tax'\\]"):
        store.apply(batches[1].drop("tax"))
    # Another order and a type that can be converted are fine.
    other = batches[1].selectExpr("tax", "address", "update_ts", "name", "CAST(id AS INT) AS id")
    store.apply(other)
    assert store.state().open.schema == store.state(1).open.schema


def test_values_that_cannot_be_converted_fail(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "s"), Dimension(["k"], "ts"), buckets=2)
    stamp = datetime.datetime(2024, 1, 1)
    store.apply(spark.createDataFrame([(1, stamp, 5)], "k int, ts timestamp, boss int"))
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        store.apply(spark.createDataFrame([(2, stamp, " - ")], "k int, ts timestamp, boss string"))
    assert store.version().number == 1


def test_two_open_rows_of_one_key_are_found(spark, store, batches, monkeypatch):
    store.apply(batches[0])
    good = HistoryStore._open_of
    monkeypatch.setattr(
        HistoryStore, "_open_of", lambda *a, **k: good(*a, **k).unionByName(good(*a, **k))
    )
    with pytest.raises(ValueError, match="the open table: more than one row"):
        store.apply(batches[1])


def test_without_dedup(spark, tmp_path, batches):
    as_is = Dimension(["id", "name"], "update_ts", dedup=False, reject_open_duplicates=False)
    store = HistoryStore(spark, str(tmp_path / "s"), as_is, buckets=4)
    store.apply(batches[0])
    store.apply(batches[2])
    twice = batches[1].where("id = '3'").selectExpr("'9' AS id", "* EXCEPT (id)")
    store.apply(twice.union(twice))
    assert store.state().open.where("id = '9'").count() == 2
    clash = batches[1].where("id = '2'")
    with pytest.raises(ValueError, match="changed rows of the batch"):
        store.apply(clash.union(clash))


def test_changed_row_needs_a_valid_from(spark, store, batches):
    store.apply(batches[0])
    rows = spark.createDataFrame([("2", "Omar", None, "x", "y")], SCHEMA)
    with pytest.raises(PySparkException, match="needs a valid_from"):
        store.apply(rows)
    assert store.version().number == 1


def test_closed_rows_are_kept_by_day(store, batches, tmp_path):
    for batch in batches:
        store.apply(batch)
    days = {p.name for p in (tmp_path / "store/rows").glob("__ct_run=*/__ct_state=closed/__ct_part=*")}
    assert days == {"__ct_part=2020-12-31", "__ct_part=2021-02-28"}
    by_day = store.closed_by_day()
    assert {(r.id, str(r.closed_on)) for r in by_day.collect()} == {("2", "2020-12-31"), ("4", "2021-02-28")}
    one = by_day.where("closed_on = DATE'2021-02-28'")
    assert [r.id for r in one.collect()] == ["4"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*__ct_part", plan)


def test_stream(spark, store, tmp_path):
    folder = tmp_path / "in"
    for number, rows in enumerate(BATCHES):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{number}")

        def run(progress):
            stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/*")
            stream_into(stream, store, str(tmp_path / progress), "people").awaitTermination()

        run("progress")
    assert versions(store.state().open) == OPEN
    assert reasons(store.state().rejects) == REASONS
    # A stream that lost its progress reads all files again, and a new one with them.
    spark.createDataFrame([("6", "Sue", day(2023), "x", "T6")], SCHEMA).write.parquet(f"{folder}/9")
    run("lost")
    assert store.version().number == 4
    assert {r.id for r in store.state().open.collect()} == {"1", "2", "3", "4", "5", "6"}
    # A batch that its own stream offers again is skipped.
    assert store.apply(spark.createDataFrame(BATCHES[0], SCHEMA), store.version().batch_id) == 4


def test_work_folder(spark, monkeypatch):
    from chronotable.sources import workspace

    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace.work_folder(spark), workspace.work_folder(spark)
    assert first != second
    assert Path(first).parent == Path(shared)
    def folders():
        return set(Path(shared).glob("chronotable-*"))

    workspace.remove_intermediates(spark)
    others = folders()  # tables and stores that a query made for good
    saved = workspace.materialize(spark.range(3))
    assert saved.count() == 3
    assert len(folders() - others) == 1
    workspace.remove_intermediates(spark)
    assert folders() == others
    with workspace.scratch(spark) as save:
        assert save(spark.range(4)).count() == 4
        assert len(folders() - others) == 1
    assert folders() == others

    class Unset:
        """A session of a cluster, and of one machine, without the setting."""

        def __init__(self, master):
            self.conf = self
            self.sparkContext = self
            self.master = master

        def get(self, _, default):
            return default

    assert "chronotable" in workspace.work_folder(Unset("local[2]"))
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            workspace.work_folder(Unset(master))


def test_columns_named_like_parts_of_the_store(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "s"), Dimension(["k"], "ts"), buckets=2)
    schema = "k int, ts timestamp, state string, part int, run string, number int, v int"
    first = [(1, day(2024), "TX", 7, "a", 1, 1), (2, day(2024), "CA", 8, "b", 2, 2)]
    store.apply(spark.createDataFrame(first, schema))
    store.apply(spark.createDataFrame([(1, day(2025), "NY", 9, "c", 3, 3)], schema))
    names = ["k", "state", "part", "run", "number", "v"]
    now = store.state()
    assert {tuple(r) for r in now.open.select(names).collect()} == {(1, "NY", 9, "c", 3, 3), (2, "CA", 8, "b", 2, 2)}
    assert [tuple(r) for r in now.closed.select(names).collect()] == [(1, "TX", 7, "a", 1, 1)]
    with pytest.raises(ValueError, match="reserved.*__CT_run"):
        store.apply(spark.createDataFrame([(1, day(2025), "x")], "k int, ts timestamp, __CT_run string"))


def test_files_are_created_once_and_whole(spark, tmp_path):
    path = str(tmp_path / "a" / "f.json")
    assert create_once(spark, path, "first")
    assert not create_once(spark, path, "second")
    assert read_text(spark, path) == "first"
    assert [n for n in names_in(spark, str(tmp_path / "a")) if not n.startswith((".", "_"))] == ["f.json"]
    done = []
    threads = [threading.Thread(target=lambda i=i: done.append(create_once(spark, f"{path}.2", str(i)))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(done) == [False] * 7 + [True]


def test_what_a_dead_driver_leaves_does_not_jam_the_store(store, batches, tmp_path):
    store.apply(batches[0])
    folder = tmp_path / "store/versions"
    (folder / "_draft-dead").write_text('{"number": 2')
    (folder / "v=2" / "_temporary").mkdir(parents=True)
    assert store.version().number == 1
    assert store.apply(batches[1]) == 2
    assert store.apply(batches[2]) == 3
    assert versions(store.state().open) == OPEN
    assert versions(store.state().closed) == CLOSED


def test_two_runs_at_the_same_time(spark, store, batches):
    store.apply(batches[0])
    outcome = []

    def run(batch):
        try:
            outcome.append(store.apply(batch))
        except RuntimeError as error:
            outcome.append(str(error))

    threads = [threading.Thread(target=run, args=(b,)) for b in (batches[1], batches[2])]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    lost = [o for o in outcome if isinstance(o, str)]
    assert store.version().number == 3 - len(lost)
    if lost:
        assert "another run" in lost[0]
        assert store.remove_orphans() == 1
        assert store.remove_orphans() == 0


def test_compaction(store, batches):
    for batch in batches:
        store.apply(batch, str(batch.count()))
    assert store.compact(buckets=3) == 4
    now = store.state()
    assert store.version().buckets == 3
    assert versions(now.open) == OPEN
    assert versions(now.closed) == CLOSED
    assert reasons(now.rejects) == REASONS
    assert store.state(2).closed.count() == 1
    # Batches of before are still known, and new ones go on from here.
    assert store.apply(batches[0], str(batches[0].count())) == 4
    assert store.apply(batches[2]) == 5
    assert versions(store.state().closed) == CLOSED
    assert reasons(store.state().rejects).total() == REASONS.total() + 3
    assert store.remove_orphans() == 0


def test_a_version_file_does_not_grow_with_history(store, batches, tmp_path):
    for _ in range(3):
        for batch in batches:
            store.apply(batch)
    files = sorted((tmp_path / "store/versions").glob("v-*.json"))
    assert len(files) == 9
    assert files[-1].stat().st_size <= files[2].stat().st_size + 40
    assert "run" in json.loads(files[-1].read_text())


def test_late_rows(store, batches, spark, tmp_path):
    from chronotable.plans.scd2 import scd2_fold

    strict = Dimension(["id", "name"], "update_ts", late="reject")
    strict_store = HistoryStore(spark, str(tmp_path / "strict"), strict, buckets=4)
    for batch in batches:
        strict_store.apply(batch)
    for state in (strict_store.state(), scd2_fold(batches, strict)):
        assert ("2", "Omar", "T2") in {(r.id, r.name, r.tax) for r in state.open.collect()}
        assert {r.id for r in state.closed.collect()} == {"4"}
        assert reasons(state.rejects) == REASONS + Counter({"LATE_RECORD": 1})
    with pytest.raises(ValueError, match="late must be"):
        Dimension(["id"], "update_ts", late="drop")


def test_a_lost_folder_is_an_error_and_not_an_empty_table(spark, tmp_path):
    """Each of the buckets that the newest version names, one at a time."""
    import shutil

    store = HistoryStore(spark, str(tmp_path / "store"), DIMENSION, buckets=4)
    rows = [(str(i), f"n{i}", day(1), "a", "c") for i in range(20)]
    store.apply(spark.createDataFrame(rows, SCHEMA))
    later = spark.createDataFrame([(i, n, day(2), "b", c) for i, n, _, _, c in rows], SCHEMA)
    for folder in sorted((tmp_path / "store/rows").glob("__ct_run=1-*/__ct_state=open/__ct_part=*")):
        aside = tmp_path / f"aside-{folder.name}"
        shutil.copytree(folder, aside)
        shutil.rmtree(folder)
        with pytest.raises(FileNotFoundError, match="open rows is gone"):
            store.state()
        with pytest.raises(FileNotFoundError, match="open rows is gone"):
            store.apply(later)
        shutil.copytree(aside, folder)
    assert store.version().number == 1
    assert store.apply(later) == 2
    assert store.state().open.count() == store.state().closed.count() == 20
