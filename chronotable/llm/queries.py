"""The registered queries of this folder; each applies one operator to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotable.llm.common import read, ship
from chronotable.llm.context_tree import score_documents
from chronotable.llm.conversation_trie import conversation_trie
from chronotable.llm.decontaminate import find_contamination
from chronotable.llm.jaccard_join import join_similar
from chronotable.llm.language import document_evidence, identify_languages, page_evidence, train_text_model
from chronotable.llm.outliers import judge_quality
from chronotable.llm.packing import pack_documents
from chronotable.llm.phrases import find_collocations
from chronotable.llm.pii import find_personal_data, train_personal_data
from chronotable.llm.sql import SQL
from chronotable.llm.token_counts import count_tokens
from chronotable.llm.token_files import read_documents, write_token_files
from chronotable.llm.toxicity import score_toxicity, train_toxicity
from chronotable.llm.url_lists import host_of, judge_captures, segment_of

__all__ = ["QUERIES", "SQL"]

Query = Callable[[SparkSession, str], DataFrame]

# The tables hold no time of fetching; it is derived from the number of a page, over half a year.
_FIRST_SECOND = 1_704_067_200
_SECONDS = 180 * 86_400
_STEP = 7_919


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return score_toxicity(documents, *train_toxicity(documents, read(spark, sf_dir, "labels")))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(manifest)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return find_personal_data(documents, train_personal_data(documents))


def op5_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("mark")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(read(spark, sf_dir, "documents")).drop("mark")


def op7_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(read(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables that have evidence on a language: documents, and web pages."""
    documents = read(spark, sf_dir, "documents")
    model = train_text_model(documents.select(F.col("doc_id").alias("id"), "text", "lang"))
    rows = document_evidence(documents).unionByName(page_evidence(read(spark, sf_dir, "pages")))
    found = identify_languages(rows, model)
    return found.select(
        F.when(F.col("kind") == "document", F.col("id")).alias("doc_id"),
        F.when(F.col("kind") == "page", F.col("id")).alias("page_id"),
        "language",
        "text_language",
        "posterior",
        "kept",
    )


def captures(pages: DataFrame) -> DataFrame:
    fetched = F.col("page_id") * _STEP % _SECONDS + _FIRST_SECOND
    return pages.select("page_id", "url", fetched.alias("fetched_at"))


def list_changes(fetched: DataFrame) -> DataFrame:
    """A dated list, kept from the captures themselves.

    A host is listed from the day after one on which more than half of its captures had a query or a
    fragment, a domain from the week after one with mostly unencrypted captures; a first path segment of a host is
    let through after a week in which at most a quarter had one. The next day or week without it ends that.
    """
    host = host_of(F.col("url"))
    odd = F.sum(F.col("url").rlike("[?#]").cast("long"))
    plain = F.sum(F.col("url").rlike("^http:").cast("long"))
    n = F.count("*")

    def logged(entry: Column, kind: str, period: int, listed: Column) -> DataFrame:
        start = F.floor(F.col("fetched_at") / period) * period
        grouped = fetched.where(entry.isNotNull()).groupBy(entry.alias("entry"), (start + period).alias("effective"))
        return grouped.agg(F.when(listed, "add").otherwise("remove").alias("action")).withColumn("kind", F.lit(kind))

    domain = F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit(""))
    by_host = logged(host, "block", 86_400, 2 * odd > n)
    by_domain = logged(domain, "block", 7 * 86_400, 2 * plain > n)
    by_segment = logged(F.concat(host, F.lit("/"), segment_of(F.col("url"))), "allow", 7 * 86_400, 4 * odd <= n)
    return by_host.unionByName(by_domain).unionByName(by_segment)


def op9_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = captures(read(spark, sf_dir, "pages"))
    return judge_captures(fetched, list_changes(fetched))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_collocations(read(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read(spark, sf_dir, "conversations"))


def op13_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))


def _shipped(query: Query) -> Query:
    """The query, on workers that have this package."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _shipped(f)
    for f in (
        op1_toxicity,
        op2_token_files,
        op3_token_counts,
        op4_personal_data,
        op5_contamination,
        op6_jaccard_join,
        op7_outliers,
        op8_language,
        op9_url_lists,
        op10_packing,
        op11_collocations,
        op12_conversation_trie,
        op13_context_tree,
    )
}
