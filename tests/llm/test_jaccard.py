"""The similarity join against all pairs, and the components it stands on."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import chronotable.llm.jaccard_join as module
from chronotable.llm.components import components
from chronotable.llm.jaccard_join import depth_for, join_similar, shingles, signature
from chronotable.llm.queries import op6_jaccard_join

SF = "/root/testdata/sf0.01"


def brute(texts, threshold=0.8):
    """(class, links) by row number."""
    hashes = module._Hashes()
    sets = [set(shingles(t or "", hashes).tolist()) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(sets)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if not a or not b or min(len(a), len(b)) < threshold * max(len(a), len(b)):
                continue
            common = len(a & b)
            if common >= threshold * (len(a) + len(b) - common):
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (root(i), links[i]) for i in range(len(sets))}


def found(frame):
    return {r.doc_id: (r.class_id, r.n_links) for r in frame.collect()}


def test_whole_table(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    expected = brute(texts)
    assert sum(n > 0 for _, n in expected.values()) > 50
    assert found(op6_jaccard_join(spark, SF)) == expected


def variants(rng, n, words, changes):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [1024, 7])
def test_groups_around_the_threshold(spark, documents, monkeypatch, block):
    monkeypatch.setattr(module, "_BLOCK", block)
    rng = random.Random(block)
    texts = [t for _ in range(6) for t in variants(rng, 14, 120, 4)]
    texts += [texts[0]] * 9 + ["common passage " * 6 + t for t in variants(rng, 20, 10, 9)]
    rng.shuffle(texts)
    expected = brute(texts)
    table = documents(texts)
    for most in (400_000, 0):
        assert found(join_similar(table, recall=0.9999, most=most)) == expected


def test_a_pair_at_the_threshold_that_shares_four_values_at_most(spark, documents):
    """With the default recall, as the queries run it."""
    rng = random.Random(128)
    words = [f"w{rng.randrange(10**6)}" for _ in range(49)]
    pair = [" ".join(words), " ".join(words[:44] + [f"x{rng.randrange(10**6)}" for _ in range(5)])]
    same = np.equal(*(signature(shingles(t, module._Hashes())) for t in pair)).reshape(module.TREES, module.DEEPEST)
    assert not same.all(axis=1).any()
    assert same[:, :4].all(axis=1).any()
    assert found(join_similar(documents(pair))) == brute(pair) == {0: (0, 1), 1: (0, 1)}


def test_prefixes_are_as_short_as_the_recall_needs():
    shortest = depth_for(0.8, 0.9999)
    assert module.prefix_lengths({}, 0.8, 0.9999) == [shortest] * module.TREES

    def missed(lengths):
        return np.prod([1 - 0.8**d for d in lengths])

    # Some large nodes are left alone, and only as deep as they are large.
    few = {(3, shortest): 5_000, (9, shortest): 4_000}
    lengths = module.prefix_lengths(few, 0.8, 0.9999)
    assert [t for t, d in enumerate(lengths) if d == shortest + 1] == [3, 9] and sum(lengths) == shortest * module.TREES + 2
    assert missed(lengths) <= 1e-4
    assert depth_for(0.7, 0.9999) == 2
    lengths = module.prefix_lengths({(3, 2): 5_000, (9, 2): 4_000, (9, 3): 2_000}, 0.7, 0.9999)
    assert (lengths[3], lengths[9], sum(lengths)) == (3, 4, 2 * 18 + 7)
    # If all are large, the smallest are taken until the recall is met, and no more.
    every = {(t, d): 10_000 * (t + 1) // d for t in range(module.TREES) for d in range(shortest, module.DEEPEST)}
    lengths = module.prefix_lengths(every, 0.8, 0.9999)
    assert missed(lengths) <= 1e-4 and lengths[0] == shortest and lengths[-1] > shortest
    assert missed([*lengths[:-1], lengths[-1] + 1]) > missed(lengths)


def test_classes_stop_at_different_lengths(spark, documents):
    """Texts that share a long passage have large nodes, single texts none; both are found whole."""
    rng = random.Random(5)
    texts = variants(rng, 60, 200, 3)
    texts += [t for _ in range(10) for t in variants(rng, 2, 60, 1)]
    signatures = [signature(shingles(t, module._Hashes())).tobytes() for t in texts]
    classes = spark.createDataFrame(list(enumerate(map(bytearray, signatures))), "cid long, signature binary")
    lengths = {r.cid: r.lengths for r in module._chosen_lengths(classes, 0.8, 0.9999, 4).collect()}
    assert set(lengths) == set(range(60))
    assert all(4 <= d <= module.DEEPEST for own in lengths.values() for d in own)
    assert all(np.prod([1 - 0.8**d for d in own]) <= 1e-4 for own in lengths.values())
    assert len({tuple(own) for own in lengths.values()}) > 1 and any(max(own) > 4 for own in lengths.values())
    stops = module._stops(classes, 0.8, 0.9999, 4).where("seeks").groupBy("cid").count().collect()
    assert {r["count"] for r in stops} == {module.TREES} and len(stops) == len(texts)
    assert found(join_similar(documents(texts), large=4)) == brute(texts)
    lower = module._chosen_lengths(classes, 0.7, 0.9999, 4).collect()
    assert {d for r in lower for d in r.lengths} > {2, 3}
    assert found(join_similar(documents(texts), threshold=0.7, large=4)) == brute(texts, 0.7)


def test_whole_table_with_nodes_of_three_as_large(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute([r.text for r in table.orderBy("doc_id").collect()])
    assert found(join_similar(table, large=2)) == expected


def test_depth_keeps_the_recall():
    for recall in (0.9, 0.99, 0.999, 0.9999):
        depth = depth_for(0.8, recall)
        assert 1 - (1 - 0.8**depth) ** module.TREES >= recall
        assert depth == module.DEEPEST or 1 - (1 - 0.8 ** (depth + 1)) ** module.TREES < recall


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    values = np.unique(rng.integers(0, 1 << 63, 3000, np.uint64))
    a, b = values[:2700], values[300:]
    agree = (signature(a) == signature(b)).mean()
    assert abs(agree - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.13


def test_components(spark):
    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=25))
    def check(edges):
        parent = {x: x for e in edges for x in e}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
        real = {x for a, b in edges if a != b for x in (a, b)}
        got = components(spark.createDataFrame(edges, "a long, b long"))
        assert {r.node: r.root for r in got.collect()} == {x: root(x) for x in real}
        assert got.count() == len(real)

    check()
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components(chain).select("root").distinct().collect() == [(0,)]


def test_odd_rows(spark, documents):
    texts = [None, "", "...", "one two", "two one", "One, two!", "long " * 60_000, "long " * 50, "a b c d e f", None]
    table = documents(texts).withColumn("cid", F.lit("clash")).withColumn("digest", F.lit(1)).withColumn("root", F.lit(1))
    expected = brute(texts)
    assert found(join_similar(table)) == expected
    assert expected[3] == (3, 1) and expected[7] == (6, 1) and expected[0] == (0, 0)
    twice = join_similar(table.unionByName(table)).collect()
    assert len(twice) == 20
    assert {(r.doc_id, r.class_id, r.n_links) for r in twice if r.doc_id in (3, 8)} == {(3, 3, 3), (8, 8, 1)}
    nameless = join_similar(table.withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert {(r.class_id, r.n_links) for r in nameless} == {(None, 0)}
    assert join_similar(documents([])).count() == 0
    # One id, two texts: the class is told by the text.
    same = documents(["a b c d e f g h", "z y x w v u"]).withColumn("doc_id", F.lit(7).cast("long"))
    assert sorted(tuple(r)[2:] for r in join_similar(same).collect()) == [(7, 0), (7, 0)]
