"""The pipeline's stages, alone and together, and the guard around this folder."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from chronotable.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_every_query_is_registered():
    registered = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF))
        out[name] = docs
    return out


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_all_but_the_last_stage_keep_the_columns(stages):
    columns = stages[""].dtypes
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].dtypes == columns


def test_one_document_of_each_group_stays(spark, stages):
    from test_jaccard import brute

    before = stages["language"].orderBy("doc_id").collect()
    classes = brute([r.text for r in before])
    first = {before[c].doc_id for c, _ in classes.values()}
    assert ids(stages["near_duplicates"]) == first
    assert len(first) < len(before)


def test_contaminated_documents_go_and_no_others(spark, stages):
    from test_native import brute

    before = stages["near_duplicates"].collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = brute([r.text for r in before], items)
    clean = {r.doc_id for i, r in enumerate(before) if not hit[i][4]}
    assert ids(stages["decontamination"]) == clean
    assert len(clean) < len(before)


def test_decontamination_of_a_text_full_of_benchmark_passages(spark, documents, tmp_path):
    """A row for every passage that holds all words of its text would be 60,000 times a megabyte here."""
    spark.createDataFrame([(1, "same " * 10)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(["same " * 60_000, "other " * 60_000, "x " * 20_000 + "same " * 10])
    stage = dict(corpus_pipeline.STAGES)["decontamination"]
    assert ids(stage(spark, docs, str(tmp_path))) == {1}


def test_personal_data_is_masked(stages):
    from test_pii import brute

    before = {r.doc_id: r.text for r in stages["decontamination"].collect()}
    after = {r.doc_id: r for r in stages["personal_data"].collect()}
    assert set(after) == set(before)
    for i, r in after.items():
        assert brute(r.text) == []
        assert r.n_chars == len(r.text)
        if not any(c in before[i] for c in "0123456789@"):
            assert r.text == before[i]


def test_run_is_the_stages_in_turn(spark, stages):
    rows = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert [(r[0], r[4]) for r in rows] == sorted((r.doc_id, r.doc_tokens) for r in stages["packing"].collect())
    assert {r[0] for r in rows} == ids(stages["personal_data"])


def test_the_last_stage_returns_what_can_be_trained_on(stages):
    """The ids of a document's pieces, put together again, are those of the library."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in stages["personal_data"].limit(20).collect()}
    pieces = [r for r in stages["packing"].collect() if r.doc_id in texts]
    for doc_id, text in texts.items():
        own = sorted((r for r in pieces if r.doc_id == doc_id), key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in own), "<u2").tolist()
        assert ids == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_a_step_keeps_its_result_alone(spark):
    from chronotable.sources import workspace

    before = list(workspace._written)
    kept = workspace.materialize_step(spark, lambda: workspace.materialize(spark.range(5)).where("id > 1"))
    assert len(workspace._written) == len(before) + 1
    assert kept.count() == 3


def test_odd_rows_pass_every_stage(spark, stages):
    docs = stages[""].limit(60)
    odd = docs.limit(3).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.lit(None)).otherwise(F.lit(""))).withColumn("doc_id", F.col("doc_id") + 10_000)
    nulls = docs.limit(2).select([F.col("text") if c == "text" else F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    # All that is clean of one language, ten times over, is like no other text.
    clean = " ".join(r.text for r in stages["decontamination"].where("lang = 'en'").orderBy("doc_id").collect())
    length = len(clean) * 10
    long = spark.createDataFrame([(20_000, " ".join([clean] * 10), "en", "s", length)], stages[""].schema)
    table = docs.unionByName(odd).unionByName(nulls).unionByName(docs.limit(5)).unionByName(long).withColumn("mark", F.lit("extra")).withColumn("_id", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = corpus_pipeline.materialize(stage(spark, table, SF))
        assert {"mark", "_id"} <= set(table.columns), name
    assert table.where("doc_id IS NOT NULL").count() == table.where("doc_id IS NOT NULL").select("doc_id").distinct().count()
    assert table.agg(F.max(F.length("text"))).first()[0] > length // 2 > 400_000
    pieces = corpus_pipeline.STAGES[-1][1](spark, table, SF)
    found = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("whole"), F.max("length").alias("most")).collect()
    assert all(r.most <= 4096 and (r.n == r.whole or r.doc_id is None) for r in found)
    assert {r.doc_id for r in found} == ids(table)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_rows_of_one_id_with_different_texts_are_judged_each(spark, stages):
    words = [[f"{name}{i}" for i in range(60)] for name in "abcd"]
    groups = [(1, words[0]), (2, words[0] + ["x"]), (1, words[1]), (3, words[1] + ["x"])]  # two groups of one least id
    rows = [(i, " ".join(text)) for i, text in [*groups, (4, words[2]), (4, words[2]), (4, words[3]), (4, words[3])]] + [(1, None)]
    columns = [F.lit(None).cast(t).alias(c) for c, t in stages[""].dtypes if c not in ("doc_id", "text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", *columns)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id, (r.text or "-")[0]) for r in kept) == [(1, "-"), (1, "a"), (1, "b"), (4, "c"), (4, "d")]


def test_the_rest_works_without_this_folder():
    code = (
        "import sys; sys.modules['chronotable.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; q = e.queries(); assert 'scd2_open' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_workers_get_the_package_with_the_query(tmp_path):
    """A driver that has the repository on its own path alone, in another folder."""
    code = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2')"
        f".config('spark.checkpoint.dir', {str(tmp_path / 'shared')!r}).getOrCreate()\n"
        "import __spark_entry__ as e\n"
        f"assert e.queries()['op3_token_counts'](s, {SF!r}).count() > 0\n"
        f"assert e.queries()['op4_personal_data'](s, {SF!r}).count() > 0\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
