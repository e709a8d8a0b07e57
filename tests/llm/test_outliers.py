"""Counts against brute force, and verdicts of the robust estimate."""

import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronotable.llm.outliers import count_text, judge_quality
from chronotable.llm.queries import op7_outliers

SF = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\x0b\x1c\x85\xa0é#*|"), max_size=120))
def test_counts(text):
    assert count_text(text)[:5] == brute(text)


def test_repeated_windows():
    words = "a b c d e f g h".split()
    assert count_text(" ".join([*words, "x", *words]))[4] == 16
    assert count_text(" ".join(["w"] * 100))[4] == 100
    assert count_text(" ".join(words[:7] * 2))[4] == brute(" ".join(words[:7] * 2))[4]


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op7_outliers(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in rows if labels.get(r.doc_id) == 0]
    assert sum(r.kept for r in good) / len(good) > 0.99
    assert sum(not r.kept for r in bad) / len(bad) > 0.5


def sentence(rng, n=60):
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(n)) + "."


def test_a_third_of_junk_does_not_pull_the_estimate(spark, documents):
    rng = random.Random(3)
    clean = [(sentence(rng), "en", "s") for _ in range(200)]
    junk = [(" ".join(w + "***" for w in sentence(rng).split()), "en", "s") for _ in range(100)]
    kept = {r.doc_id: r.kept for r in judge_quality(documents(clean + junk)).collect()}
    assert all(kept[i] for i in range(200))
    assert not any(kept[i] for i in range(200, 300))


def test_small_groups_are_pooled_and_the_last_pool_is_kept(spark, documents):
    rng = random.Random(4)
    rows = [(sentence(rng), "en", f"s{i}") for i in range(80)] + [(" ".join(w + "***" for w in sentence(rng).split()), "en", "other")]
    kept = {r.doc_id: r.kept for r in judge_quality(documents(rows)).collect()}
    assert all(kept[i] for i in range(80))
    assert not kept[80]
    assert all(r.kept for r in judge_quality(documents(rows[-3:])).collect())


def test_own_verdict_on_rows_that_pass_the_base_rule(spark):
    rows = op7_outliers(spark, "/root/testdata/sf0.1").select("doc_id", "kept", "base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    passed = rows.where("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    kept = dict(passed)
    assert kept[0] < 0.1
    assert kept[1] > 0.99


def test_few_symbols_in_a_long_text_are_far(spark, documents):
    rng = random.Random(6)
    clean = [(sentence(rng, 600), "en", "s") for _ in range(100)]
    junk = [(" ".join(w + "#" * (i % 3 == 0) for i, w in enumerate(sentence(rng, 600).split())), "en", "s") for _ in range(10)]
    kept = {r.doc_id: r.kept for r in judge_quality(documents(clean + junk)).collect()}
    assert all(kept[i] for i in range(100))
    assert not any(kept[i] for i in range(100, 110))


def test_odd_rows(spark, documents):
    rng = random.Random(5)
    table = documents([None, "", "x " * 200_000, *[(sentence(rng), None, None) for _ in range(70)]])
    table = table.unionByName(table).unionByName(table.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    table = table.withColumn("g", F.lit("clash")).withColumn("z0", F.lit(1)).withColumn("n_words", F.lit(-1))
    rows = judge_quality(table).collect()
    assert len(rows) == 2 * 73 + 1
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (None, 0, 1))
    assert all(r.kept for r in rows if r.doc_id is not None and r.doc_id >= 3)
    assert judge_quality(documents([])).count() == 0


def test_the_half_is_made_consistent():
    """Squared distances of normal rows by the raised scatter of their nearest half have the median of the distribution."""
    import numpy as np

    from chronotable.llm.outliers import _chi2, consistency

    x = np.random.default_rng(1).normal(size=(200_000, 6))
    d = (x**2).sum(axis=1)
    half = x[d <= np.median(d)]
    assert abs(consistency(0.5) * half.var(axis=0).mean() - 1) < 0.02
    assert abs(np.median(d) - _chi2(0.0)) < 0.05


def test_the_start_of_the_least_determinant_wins(spark):
    """A cloud of contaminated rows along a direction: from no correlations alone the steps end in a larger determinant than the best start does."""
    import numpy as np

    from chronotable.llm.outliers import _E, _Z, _least, _starts, concentrate

    rng = np.random.default_rng(3)
    mixing = rng.normal(size=(6, 6))
    x = np.concatenate([rng.normal(size=(1_400, 6)) @ mixing, rng.normal(size=(600, 6)) * 0.3 + 4])
    rows = spark.createDataFrame([("g", *map(float, r), 1e-4, 1e-4, 1e-4) for r in x], ["g", *_Z, *_E])
    ends = [concentrate(rows, start, 10, 0.5) for start in _starts(rows)]
    dets = [end.first().log_det for end in ends]
    assert _least(ends).first().log_det == min(dets)
    # Of every start the last determinant is no larger than after one step.
    for start, det in zip(_starts(rows), dets, strict=True):
        assert det <= concentrate(rows, start, 1, 0.5).first().log_det + 1e-9
