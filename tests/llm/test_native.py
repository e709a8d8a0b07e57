"""Contamination and URL lists against their SQL and brute force; both run on built-in functions alone."""

import hashlib
import re

import pytest
from compare import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronotable.llm import decontaminate
from chronotable.llm.decontaminate import find_contamination
from chronotable.llm.queries import QUERIES, SQL
from chronotable.llm.url_lists import host_of, intervals, judge_captures

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], SQL[name], SF) == []


@pytest.mark.parametrize("name", ["op5_contamination", "op9_url_lists"])
def test_no_python_in_the_plan(spark, name):
    df = QUERIES[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = {}
    for key, text in enumerate(texts):
        w = words(text)
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[key] = (len(w), len(hit), len(found), digest, bool(hit))
    return out


def found(frame):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect()}


vocabulary = st.sampled_from(["a", "b", "É", "é", "Z9", "ß", "the", "\x00x", "..."])
texts_of = st.lists(vocabulary, max_size=40).map(" ".join)


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_contamination_against_brute_force(spark, documents, most):
    @settings(max_examples=6, deadline=None)
    @given(st.lists(texts_of, min_size=1, max_size=12), st.lists(texts_of, max_size=6))
    def check(texts, items):
        benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
        table = documents(texts)
        assert found(find_contamination(table, benchmark, most=most)) == brute(texts, enumerate(items))

    check()


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_contamination_of_odd_rows(spark, documents, most):
    long = " ".join(f"w{i}" for i in range(12))
    texts = [None, "", long, f"x {long.upper()} y", "b a", "A! b? c", "same " * 3000, long[:-3]]
    items = [(1, long), (2, "a-b"), (2, "Same same"), (None, "x"), (10, None), (11, ""), (12, long), (3, " ".join(["same"] * 10))]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    table = documents(texts).withColumn("item_id", F.lit(0)).withColumn("words", F.lit("clash"))
    table = table.unionByName(table.where("doc_id = 2"))
    expected = brute(texts, [(i, t) for i, t in items if i is not None])
    got = find_contamination(table, benchmark, most=most)
    assert got.count() == len(texts) + 1
    assert found(got) == expected
    assert expected[6][1] == 3000
    nulls = find_contamination(table.withColumn("doc_id", F.lit(None).cast("long")), benchmark, most=most).collect()
    assert sorted(r.n_hit for r in nulls) == sorted([expected[i][1] for i in range(len(texts))] + [expected[2][1]])
    assert find_contamination(documents([]), benchmark, most=most).count() == 0
    assert found(find_contamination(table, benchmark.limit(0), most=most))[2][1] == 0


def test_a_shared_passage_of_ten_words_is_found_wherever_it_stands(spark, documents):
    passage = [f"p{i}" for i in range(10)]
    texts = [" ".join([f"l{j}" for j in range(k)] + passage + [f"r{j}" for j in range(30 - k)]) for k in range(30)]
    benchmark = spark.createDataFrame([(5, " ".join([f"q{j}" for j in range(7)] + passage + ["z"] * 9))], "item_id long, text string")
    assert all(v[1] == 10 and v[2] == 1 for v in found(find_contamination(documents(texts), benchmark)).values())


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_contamination_of_texts_cut_into_pieces(spark, documents, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "WHOLE", 20)
    monkeypatch.setattr(decontaminate, "PIECE", 12)
    breaks = st.sampled_from([" ", " ", ", ", "\n", "...-"])
    broken = st.lists(st.tuples(vocabulary, breaks), max_size=80).map(lambda x: "".join(w + b for w, b in x))

    @settings(max_examples=2, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(["", " ", ".,; " * 8]), broken).map("".join), min_size=1, max_size=12), st.lists(texts_of, max_size=6))
    def check(texts, items):
        texts = [*texts, "." * 50, " ".join(f"w{i}" for i in range(12 * 5)), " ".join(f"w{i}" for i in range(12 * 2 + 1))]
        items = [*items, *(" ".join(f"w{i}" for i in range(k, k + n)) for k, n in ((3, 10), (11, 1), (12, 9), (20, 2), (22, 30)))]
        benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
        assert found(find_contamination(documents(texts), benchmark, most=most)) == brute(texts, enumerate(items))

    check()


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_memory_does_not_grow_with_hits_times_words(spark, documents, most):
    """A row for every hit that holds all words of its text would be 60,000 times a megabyte here."""
    texts = ["same " * 60_000, "x " * 30_000 + "same " * 10 + "y " * 30_000]
    benchmark = spark.createDataFrame([(1, "same " * 10)], "item_id long, text string")
    got = found(find_contamination(documents(texts), benchmark, most=most))
    assert [got[i][:3] for i in range(2)] == [(60_000, 60_000, 1), (60_010, 10, 1)]


CHANGES = "entry string, kind string, action string, effective long"
PAGES = "page_id long, url string, fetched_at long"


def test_intervals(spark):
    rows = [("a", "block", "add", 10), ("a", "block", "add", 20), ("a", "block", "remove", 95), ("a", "block", "add", 250), ("b", "block", "remove", 5), ("c", "block", "add", 7), ("c", "block", "remove", 7), (None, "block", "add", 1), ("d", "block", "add", None)]
    got = intervals(spark.createDataFrame(rows + rows[:2], CHANGES), bucket=100)
    assert sorted(map(tuple, got.collect()), key=str) == [("a", "block", 10, 20), ("a", "block", 20, 95), ("a", "block", 250, None)]


def judged(spark, pages, changes, **kw):
    rows = judge_captures(spark.createDataFrame(pages, PAGES), spark.createDataFrame(changes, CHANGES), **kw).collect()
    return sorted((r.page_id, r.entry, r.n_active, r.blocked) for r in rows)


@pytest.mark.parametrize("bucket", [7, 30 * 86_400])
def test_captures_see_the_list_of_their_time(spark, bucket):
    changes = [("example.com", "block", "add", 100), ("example.com", "block", "remove", 200), ("ok.example.com", "allow", "add", 150), ("example.com/ads", "block", "add", 0)]
    pages = [
        (1, "http://example.com/x", 99), (2, "http://example.com/x", 100), (3, "https://user@a.b.EXAMPLE.com:80/x", 199),
        (4, "http://example.com/", 200), (5, "http://ok.example.com/x", 160), (6, "http://ok.example.com/ads/1?x", 160),
        (7, "http://notexample.com/ads", 160), (8, "nonsense", 160), (9, "http://example.com", 10**9),
    ]
    assert judged(spark, pages, changes, bucket=bucket) == [
        (1, None, 0, False), (2, "example.com", 1, True), (3, "example.com", 1, True), (4, None, 0, False), (5, "ok.example.com", 2, False),
        (6, "example.com/ads", 3, True), (7, None, 0, False), (8, None, 0, False), (9, None, 0, False),
    ]


def test_overlong_hosts_are_looked_up_under_their_last_labels(spark):
    whole = "b" * 241 + ".example.com"  # 253 characters
    changes = [("example.com", "block", "add", 0), ("ok.example.com/a", "allow", "add", 0), (whole, "block", "add", 0)]
    pages = [
        (1, "http://" + "x" * 300 + ".example.com/y", 5), (2, "http://" + "x." * 50_000 + "ok.example.com/a", 5), (3, f"http://z.{whole}/", 5),
        (4, "http://" + "x" * 300 + ".notexample.com/", 5), (5, "http://" + "x" * 300, 5), (6, "http://x" + whole + "/", 5),
    ]
    assert judged(spark, pages, changes) == [(1, "example.com", 1, True), (2, "ok.example.com/a", 2, False), (3, whole, 2, True), (4, None, 0, False), (5, None, 0, False), (6, "example.com", 1, True)]


def test_odd_captures(spark):
    pages = [(1, None, 5), (2, "http://a.de/", None), (None, "http://a.de/", 5), (3, "http://a.de/", 5), (3, "http://a.de/", 5), (4, "http://" + "x" * 100_000 + ".de/", 5)]
    changes = [("a.de", "block", "add", 0), ("a.de", "allow", "add", 0)]
    frame = spark.createDataFrame(pages, PAGES).withColumn("entry", F.lit("clash")).withColumn("key", F.lit(1))
    rows = judge_captures(frame, spark.createDataFrame(changes[:1], CHANGES)).collect()
    assert sorted((r.page_id or 0, r.blocked) for r in rows) == [(0, True), (1, False), (2, False), (3, True), (3, True), (4, False)]
    assert not any(r[3] for r in judged(spark, pages[3:4], changes))
    assert judged(spark, [], changes) == []
    assert judged(spark, pages[3:4], []) == [(3, None, 0, False)]
    assert spark.createDataFrame([("ftp://H.x",), ("x",)], "u string").select(host_of(F.col("u"))).collect() == [("h.x",), (None,)]
