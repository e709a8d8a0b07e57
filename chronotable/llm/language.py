"""Language identification by fusing evidence with Bayes' rule.

For every row and language the logarithms of these add up:

* text likelihood: hashed byte trigrams of the whole lower-cased text, a naive Bayes model per language; as
  neighbouring trigrams depend on one another, a text weighs no more than ``weight`` independent ones;
* declared language (the markup's ``lang``, or a table's own column) and address suffix: how often
  each value occurs with each language, by grouped aggregation over all rows, smoothed;
* host prior: a row's host is smoothed towards its domain and that towards all rows, with ``strength`` pseudo-rows
  each. Counts are the text posteriors summed over all rows, without the row's own share.

A row is kept if its text has letters (three in a row, or at an end), its best language has a posterior of at least ``least``, and its trigrams
are as likely as those of the language's own sample, within ``spread`` deviations.

Sampling: only the trigram model is fitted on a bounded sample, ``most`` labelled rows of each of the ``languages`` most frequent
labels, in the order of a hash of the id; texts stay in the tasks that read them and hand out counts of trigrams. All counts of evidence cover all rows.

Nulls: missing evidence adds nothing; a null or empty text has no letters, so its language is ``und`` and it is not
kept. Rows may repeat. An empty table gives no rows; without labelled rows everything is ``und``. Columns other than
those named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, give_back
from chronotable.llm.url_lists import host_of
from chronotable.sources.workspace import materialize

_BITS = 16
_SALTS = 64
_ROW = ("kind", "id")
_EVIDENCE = ("declared", "suffix", "domain", "host")
_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_FOLDED = np.array([b if b >= 0x80 or chr(b) in "abcdefghijklmnopqrstuvwxyz " else 0 for b in range(256)], np.uint32)
_FIRST_TAG = r"(?i)<html\b([^>]*)"
_DECLARED = r"(?i)\slang\s*=\s*[\"']?([A-Za-z]{2,3})"
_HIDDEN = re.compile(r"<(?:(script|style)\b|!--|(?=[a-z/!?]))", re.IGNORECASE)


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the UTF-8 bytes of letters and spaces; those with a digit or a sign say nothing about a language."""
    data = _FOLDED[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    hashed = (data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - _BITS)
    return hashed[(data[:-2] > 0) & (data[1:-1] > 0) & (data[2:] > 0)].astype(np.int64)


def visible_text(html: str) -> str:
    """What stands between the tags, without scripts, styles and comments; one that is not closed hides the rest, as in browsers. A ``<`` that begins none is text."""
    lowered = html.lower()
    if len(lowered) != len(html):  # a letter that changes its length; tags are ASCII
        lowered = html.translate(_TO_LOWER)
    out, at = [], 0
    while match := _HIDDEN.search(html, at):
        out.append(html[at : match.start()])
        name = match.group(1)
        closing = f"</{name.lower()}" if name else "-->" if match.group().endswith("--") else ">"
        end = lowered.find(closing, match.end())
        if name and end >= 0:
            closing, end = ">", lowered.find(">", end)
        if end < 0:
            return " ".join(out)
        at = end + len(closing)
    return " ".join([*out, html[at:]])


@dataclass(frozen=True)
class TextModel:
    languages: list[str]
    table: np.ndarray  # log probability by trigram and language
    usual: np.ndarray  # mean log probability of a trigram of the language's own texts
    apart: np.ndarray  # and the deviation of single trigrams from it


def train_text_model(labelled: DataFrame, most: int = 300, languages: int = 64) -> TextModel:
    """From rows (id, text, lang); at most ``most`` texts of each of the ``languages`` most frequent labels."""
    rows = labelled.where("lang IS NOT NULL AND id IS NOT NULL").select(F.col("id").cast("long").alias("id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    frequent = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    names = sorted(row.lang for row in frequent.collect())
    ids = rows.where(F.col("lang").isin(names)).select("lang", F.xxhash64("id", "text").alias("hash")).distinct()
    ids = ids.withColumn("salt", F.pmod("hash", F.lit(_SALTS)))
    # Only hashes are ranked, first among those of a language and salt, so no language gathers in a task.
    for keys in (["lang", "salt"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))
        ids = ids.withColumn("rank", rank).where(F.col("rank") <= most)
    chosen = materialize(ids.select(F.col("lang").alias("l"), F.col("hash").alias("h")))
    same = (F.col("lang") == F.col("l")) & (F.xxhash64("id", "text") == F.col("h"))
    sample = rows.join(F.broadcast(chosen), same, "left_semi").select("lang", "id", "text")  # at most `most` x `languages` hashes
    parts = sample.dropDuplicates(["lang", "id", "text"]).select("lang", "text").mapInArrow(_trigram_counts, "lang string, trigram int, units long")
    # At most 65,536 sums of each of the languages.
    counted = parts.groupBy("lang", "trigram").agg(F.sum("units").alias("units")).toArrow()
    counts = np.zeros((1 << _BITS, len(names)))
    index = {name: i for i, name in enumerate(names)}
    counts[counted.column(1).to_numpy(), [index[name] for name in counted.column(0).to_pylist()]] = counted.column(2).to_numpy() / _UNIT
    if not names:
        return TextModel([], np.zeros((1 << _BITS, 0), np.float32), np.zeros(0), np.zeros(0))
    table = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * (1 << _BITS)))
    shares = counts / np.maximum(counts.sum(axis=0), 1)
    usual = (shares * table).sum(axis=0)
    apart = np.sqrt((shares * (table - usual) ** 2).sum(axis=0))
    # A language whose sample has no trigram has no deviation either.
    return TextModel(names, table.astype(np.float32), usual, np.where(apart > 0, apart, 1.0))


_UNIT = 1 << 20  # sums of whole numbers do not depend on their order
_TRIGRAMS = pa.schema([("lang", pa.string()), ("trigram", pa.int32()), ("units", pa.int64())])


def _trigram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, value in zip(batch.column(0), batch.column(1), strict=True):
            found, times = np.unique(trigrams(value.as_py()), return_counts=True)
            # A long text counts as much as ten thousand trigrams, so that no single one makes the model.
            share = min(1.0, 10_000 / max(times.sum(), 1))
            units = np.rint(times * (share * _UNIT)).astype(np.int64)
            yield batch_of(_TRIGRAMS, (pa.array([lang.as_py()] * len(found), pa.string()), found.astype(np.int32), units))


def _likelihoods(model: TextModel, weight: float) -> Callable:
    schema = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("mark", pa.int64()), ("declared", pa.string()), ("suffix", pa.string()), ("domain", pa.string()), ("host", pa.string()), ("text_log", pa.list_(pa.float64())), ("strange", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, strange = [], []
            for value, markup in zip(batch.column(7), batch.column(8), strict=True):
                text = value.as_py() or ""
                text = visible_text(text) if markup.as_py() else text
                if not any(map(str.isalpha, text)) or not model.languages:
                    logs.append(None)
                    strange.append(None)
                    continue
                found = trigrams(text)
                if not len(found):
                    logs.append(None)
                    strange.append(None)
                    continue
                total = np.zeros(len(model.languages))
                for start in range(0, len(found), 1 << 20):
                    total += model.table[found[start : start + (1 << 20)]].sum(axis=0, dtype=np.float64)
                mean = total / len(found)
                logs.append(mean * min(len(found), weight))
                best = int(mean.argmax())
                strange.append((model.usual[best] - mean[best]) / model.apart[best])
            yield batch_of(schema, (*(batch.column(i) for i in range(7)), logs, strange))
        give_back()

    return score


def _soft_counts(rows: DataFrame, by: str, name: str) -> DataFrame:
    """Text posteriors summed by a column, as an array in the order of the languages."""
    shares = rows.where(F.col(by).isNotNull() & F.col("p").isNotNull()).select(F.col(by).alias(f"{name}_key"), F.posexplode("p").alias("k", "share"))
    sums = shares.groupBy(f"{name}_key", "k").agg(F.sum("share").alias("share"))
    inorder = F.array_sort(F.collect_list(F.struct("k", "share")))
    return sums.groupBy(f"{name}_key").agg(F.transform(inorder, lambda s: s["share"]).alias(name))


def _sums(arrays: DataFrame, column: str, n: int) -> np.ndarray:
    """An array column summed over all rows."""
    rows = arrays.select(F.posexplode(column).alias("k", "share")).groupBy("k").agg(F.sum("share").alias("share")).collect()
    out = np.zeros(n)
    for row in rows:
        out[row.k] = row.share
    return out


def _left(counts: str) -> Column:
    """An array of counts without a row's own share."""
    return F.transform("own", lambda own, k: F.greatest(F.coalesce(F.get(counts, k), F.lit(0.0)) - own, F.lit(0.0)))


def _with_evidence(name: str, values: int, totals: np.ndarray) -> Column:
    """``logs`` plus how often a value of an evidence occurs with each language, smoothed."""
    every = F.lit(totals.tolist())

    def more(log: Column, k: Column) -> Column:
        smoothed = (F.get(f"n_{name}", k) + 1) / (F.greatest(F.get(every, k) - F.get("own", k), F.lit(0.0)) + values + 1)
        return log + F.when(F.col(name).isNotNull(), F.log(smoothed)).otherwise(F.lit(0.0))

    return F.transform("logs", more)


def _joined(rows: DataFrame, counts: DataFrame, by: str, name: str, most: int) -> DataFrame:
    """With the counts of the row's value; sent to all tasks only if there are at most ``most`` values."""
    few = counts.limit(most + 1).count() <= most
    return rows.join(F.broadcast(counts) if few else counts, F.col(by) == F.col(f"{name}_key"), "left").drop(f"{name}_key")


def identify_languages(rows: DataFrame, model: TextModel, weight: float = 100.0, strength: float = 5.0, least: float = 0.5, spread: float = 3.0, most: int = 50_000) -> DataFrame:
    """Language, posterior and verdict of every row.

    Counts of at most ``most`` different values of an evidence are sent to all tasks; beyond that they are joined by a shuffle.

    ``rows`` has kind and id, which name a row; text, declared, suffix, domain and host, all strings, any of them null;
    ``markup`` says whether the text is HTML.
    ``mark`` is a hash of the text, which tells rows of one id apart.
    """
    n = len(model.languages)
    rows = rows.select(*_ROW, F.xxhash64("text").alias("mark"), *[F.nullif(F.lower(F.col(c)), F.lit("")).alias(c) for c in ("declared", "suffix", "domain", "host")], "text", "markup")
    scored = materialize(rows.mapInArrow(_likelihoods(model, weight), "kind string, id long, mark long, declared string, suffix string, domain string, host string, text_log array<double>, strange double"))
    if not n:
        return scored.select(*_ROW, "mark", F.lit("und").alias("language"), F.lit("und").alias("text_language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("kept"))
    peak = F.array_max("text_log")
    raised = F.transform("text_log", lambda x: F.exp(x - peak))
    scored = scored.withColumn("raised", raised).withColumn("p", F.transform("raised", lambda x: x / F.aggregate("raised", F.lit(0.0), lambda a, b: a + b)))
    scored = materialize(scored.drop("raised"))
    all_counts = _sums(scored.where("p IS NOT NULL"), "p", n)
    shares = F.lit(((all_counts + 1) / (all_counts + 1).sum()).tolist())
    fused = scored.withColumn("own", F.coalesce("p", F.lit([0.0] * n)))
    sizes = {}
    for name in _EVIDENCE:
        counts = materialize(_soft_counts(scored, name, f"n_{name}"))
        sizes[name] = counts
        fused = _joined(fused, counts, name, f"n_{name}", most)
        # The counts of the row's value without the row itself.
        fused = fused.withColumn(f"n_{name}", _left(f"n_{name}"))

    def total(name: str) -> Column:
        return F.aggregate(f"n_{name}", F.lit(0.0), lambda a, x: a + x)

    fused = fused.withColumns({f"t_{name}": total(name) for name in ("domain", "host")})
    domain = F.transform("n_domain", lambda x, k: (x + strength * F.get(shares, k)) / (F.col("t_domain") + strength))
    fused = fused.withColumn("n_domain", domain)
    fused = fused.withColumn("n_host", F.transform("n_host", lambda x, k: (x + strength * F.get("n_domain", k)) / (F.col("t_host") + strength)))
    fused = fused.withColumn("logs", F.transform("n_host", lambda x, k: F.coalesce(F.get("text_log", k), F.lit(0.0)) + F.log(x)))
    for name in ("declared", "suffix"):
        fused = fused.withColumn("logs", _with_evidence(name, sizes[name].count(), _sums(sizes[name], f"n_{name}", n)))
    names = F.array(*[F.lit(name) for name in model.languages])
    with_logs = fused.select(*_ROW, "mark", "text_log", "strange", "logs")
    best = with_logs.withColumn("top", F.array_max("logs")).withColumn("posterior", 1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    language = F.element_at(names, F.array_position("logs", F.col("top")).cast("int"))
    by_text = F.element_at(names, F.array_position("text_log", F.array_max("text_log")).cast("int"))
    readable = F.col("text_log").isNotNull()
    return best.select(
        *_ROW,
        "mark",
        F.when(readable, language).otherwise(F.lit("und")).alias("language"),
        F.when(readable, by_text).otherwise(F.lit("und")).alias("text_language"),
        F.when(readable, F.col("posterior")).otherwise(F.lit(0.0)).alias("posterior"),
        (readable & (F.col("posterior") >= least) & (F.coalesce("strange", F.lit(0.0)) <= spread)).alias("kept"),
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """Declared language, address and HTML of web pages."""
    host = host_of(F.col("url"))
    tag = F.regexp_extract(F.coalesce("html", F.lit("")), _FIRST_TAG, 1)
    return pages.select(
        F.lit("page").alias("kind"),
        F.col("page_id").cast("long").alias("id"),
        F.col("html").cast("string").alias("text"),
        F.lit(True).alias("markup"),
        F.regexp_extract(tag, _DECLARED, 1).alias("declared"),
        F.regexp_extract(host, r"\.([^.]+)$", 1).alias("suffix"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        host.alias("host"),
    )


def document_evidence(documents: DataFrame) -> DataFrame:
    """A document's own language column is its declaration and its source stands for the host."""
    return documents.select(
        F.lit("document").alias("kind"),
        F.col("doc_id").cast("long").alias("id"),
        F.col("text").cast("string").alias("text"),
        F.lit(False).alias("markup"),
        F.col("lang").cast("string").alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        F.lit(None).cast("string").alias("domain"),
        F.col("source").cast("string").alias("host"),
    )
