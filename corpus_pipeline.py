"""A corpus, from documents as they come to packed token sequences.

Each stage applies one operator of ``chronotable.llm`` to all that the stage before kept. Documents are named
by their id and a hash of their text, so rows that repeat an id are judged each. Rows with nulls, empty texts
and empty tables pass as the operators define it: a text without a letter has no language and goes in the first
stage; extra columns are carried along up to the last stage. Texts are long, so Python workers are given ``BATCH`` rows at a time,
unless the session asks for fewer.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotable.llm.common import read, ship
from chronotable.llm.decontaminate import find_contamination
from chronotable.llm.jaccard_join import similar_groups
from chronotable.llm.language import document_evidence, identify_languages, train_text_model
from chronotable.llm.packing import pack_documents
from chronotable.llm.pii import redact, train_personal_data
from chronotable.sources.workspace import materialize, materialize_step

BATCH = 1_000
_ROWS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _same(docs: DataFrame, keys: DataFrame) -> Column:
    return docs["doc_id"].cast("long").eqNullSafe(keys["_id"]) & (F.xxhash64(docs["text"]) == keys["_mark"])


def _without(docs: DataFrame, gone: DataFrame, most: int = 500_000) -> DataFrame:
    """Documents but those that (doc_id, mark) names.

    Up to ``most`` names, of 16 bytes each, are sent to all tasks, so that no text moves; beyond that both sides are shuffled.
    """
    keys = materialize(gone.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct())
    few = keys.limit(most + 1).count() <= most
    return docs.join(F.broadcast(keys) if few else keys, _same(docs, keys), "left_anti")


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence."""
    model = train_text_model(docs.select(F.col("doc_id").cast("long").alias("id"), "text", "lang"))
    found = identify_languages(document_evidence(docs), model)
    return _without(docs, found.where("NOT kept").select(F.col("id").alias("doc_id"), "mark"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one of the least id, and of its rows the one of the least mark."""
    joined = materialize(similar_groups(docs)).where("doc_id IS NOT NULL")
    kept = _without(docs, joined.where("doc_id != class_id OR mark != class_mark"))
    # Equal rows share their name; one of them stays.
    again = materialize(joined.groupBy("doc_id", "mark").count().where("count > 1").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")))
    if again.isEmpty():
        return kept
    single = kept.join(again, _same(kept, again), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, _same(kept, again), "left_anti").unionByName(single)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated").select(F.col("doc_id").cast("long"), "mark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    masked = redact(docs, train_personal_data(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with their ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, with_ids=True, keep=False)


def _shipped(stage: Stage) -> Stage:
    """The stage, on workers that have the package and get few rows at a time."""

    @functools.wraps(stage)
    def apply(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        if not 0 < int(spark.conf.get(_ROWS_AT_ONCE)) <= BATCH:
            spark.conf.set(_ROWS_AT_ONCE, str(BATCH))
        return stage(spark, docs, sf_dir)

    return apply


STAGES: list[tuple[str, Stage]] = [
    ("language", _shipped(languages)),
    ("near_duplicates", _shipped(near_duplicates)),
    ("decontamination", _shipped(decontaminated)),
    ("personal_data", _shipped(personal_data)),
    ("packing", _shipped(packed)),
]

# Stages that train models or use a tokenizer have no SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each on the written result of the one before; what a stage wrote on its way is deleted."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize_step(spark, functools.partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
