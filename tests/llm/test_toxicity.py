"""Toxicity: held-out accuracy, the risk estimator, and odd rows."""

import numpy as np
from pyspark.sql import functions as F

from chronotable.llm.common import first_by_hash
from chronotable.llm.queries import op1_toxicity
from chronotable.llm.toxicity import Examples, fit, score_toxicity, train_toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    scored = op1_toxicity(spark, SF)
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = scored.join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").toPandas()
    truth, predicted = held["toxic"].to_numpy() == 1, held["predicted"].to_numpy() == 1
    assert (truth == predicted).mean() > 0.95
    assert predicted[truth].mean() > 0.85
    assert ((held["score"] >= 0) & (held["score"] <= 1)).all()
    assert ((held["score"] >= 0.5) == predicted).all()


def test_held_out_rows_follow_the_checksum(spark, documents):
    import zlib

    scored = score_toxicity(documents(["a"] * 40), np.zeros(1 << 18), 0.0).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)


def test_examples_are_sparse_rows():
    rows = Examples([np.array([0, 2]), np.array([], int), np.array([1])])
    weights = np.array([1.0, 10.0, 100.0])
    assert rows.output(weights).tolist() == [101.0, 0.0, 10.0]
    assert rows.gradient(np.array([1.0, 5.0, 2.0]), 3).tolist() == [1.0, 2.0, 1.0]


def test_learns_from_positives_and_unlabelled_alone():
    random = np.random.default_rng(1)

    def text(toxic):
        words = set(random.integers(10, 60, 12).tolist())
        return np.array(sorted(words | ({int(random.integers(0, 5))} if toxic else set())))

    positive = [text(True) for _ in range(300)]
    unlabelled = [text(i % 10 == 0) for i in range(2000)]
    weights, intercept = fit(positive, unlabelled, 0.11, 60)
    fresh = [text(i % 2 == 0) for i in range(400)]
    found = Examples(fresh).output(weights) + intercept > 0
    assert (found == (np.arange(400) % 2 == 0)).mean() > 0.97


def test_odd_rows(spark, documents):
    table = documents([None, "", "bad " * 50_000, "fine"]).withColumn("score", F.lit("clash")).withColumn("features", F.lit(1))
    table = table.unionByName(table).unionByName(table.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    labels = spark.createDataFrame([(0, None, None), (None, 1, 1), (2, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    model = train_toxicity(table, labels)
    scored = score_toxicity(table, *model)
    assert scored.count() == 9
    assert scored.where("score IS NULL OR score < 0 OR score > 1 OR held_out IS NULL").count() == 0
    none = train_toxicity(table, labels.limit(0))
    assert score_toxicity(table, *none).agg(F.max("score")).first()[0] < 0.5
    empty = documents([])
    assert score_toxicity(empty, *train_toxicity(empty, labels)).count() == 0


def test_samples_come_in_one_order_whatever_their_bound(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    whole = [r.doc_id for r in first_by_hash(ids, 20_000).collect()]
    assert sorted(whole) == list(range(20_000))
    for most in (1, 50, 3_000):
        assert [r.doc_id for r in first_by_hash(ids, most).collect()] == whole[:most]
    assert first_by_hash(ids.limit(0), 5).count() == 0


def test_no_confirmed_example_among_the_documents(spark, documents):
    """Labels of other rows, or of held-out rows only: every score is the prior, and nothing is predicted toxic."""
    import zlib

    table = documents(["some text"] * 30)
    held = [i for i in range(30) if zlib.crc32(str(i).encode()) % 5 == 0]
    elsewhere = [(i, int(i % 3 == 0)) for i in range(1_000, 1_030)]
    for rows in (elsewhere, [(held[0], 1), *elsewhere]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        scored = score_toxicity(table, *train_toxicity(table, labels)).collect()
        scores = {round(r.score, 6) for r in scored}
        assert len(scores) == 1 and 0.2 < scores.pop() < 0.5
        assert not any(r.predicted for r in scored)


def test_an_average_is_over_the_members_that_were_fitted(spark, documents):
    """One document, in one part of the sample, leaves one member without any row."""
    table = documents(["a single document"] + [None] * 5).limit(1)
    doc = table.first().doc_id
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(2_000, 2_040)], "doc_id long, toxic int")
    _, intercept = train_toxicity(table, labels)
    known = [i for i in range(2_000, 2_040) if __import__("zlib").crc32(str(i).encode()) % 5]
    prior = 1.1 * sum(i % 4 == 0 for i in known) / len(known)
    assert doc is not None and abs(intercept - np.log(prior / (1 - prior))) < 1e-9
