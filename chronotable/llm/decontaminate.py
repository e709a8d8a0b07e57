"""Benchmark passages in documents, found by winnowing.

A window is ten consecutive words of an item. Of every ``GUARANTEE - GRAM + 1`` consecutive k-grams the one with
the least hash is kept as a fingerprint. A passage of ten shared words holds such a run of k-grams on both sides, and
as the choice depends on the run alone, both sides keep the same one: no shared passage is missed. Runs
whose fingerprint the benchmark has are extended to their ten words, and those joined with the windows as text,
so nothing is reported that is not shared. Items of fewer than ten words are one window, whose hash is the fingerprint.

Only built-in functions are used. The fingerprints of the benchmark go to every task if there are
at most ``most`` (8 bytes each); the runs are then tested while the documents are scanned, and no text is
shuffled. Beyond that the fingerprints of documents are shuffled and joined, and only documents with a hit are read on.

Memory: texts of more than ``WHOLE`` bytes are cut into pieces of ``PIECE`` words, each with the first words of the next, so a task
holds the words of one piece, however long a text is. Generated code keeps all rows that one piece gives until the last is made,
so the words of a piece are not among their columns, only the ten of a run.

Nulls: a null text has no words. Documents of one id are told apart by a hash of their text; equal rows get equal results.
A null ``doc_id`` is a value like others. Items with a null id are left out; rows that repeat an item's id are that
item's windows together, and equal items each count. Empty tables give no rows, or no hits. Other columns are not read.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotable.sources.workspace import materialize

WINDOW = 10
GRAM = 5
PIECE = 8_192
WHOLE = 65_536
_RUN = WINDOW - GRAM + 1  # k-grams in a window
_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _lower(word: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    """The words, in whatever letter case."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BREAKS), "")


def _in_pieces(rows: DataFrame, size: int, *keep: str) -> DataFrame:
    """(at, last, piece) of every text, with the columns to keep; ``at`` is the number of words before.

    Each run of so many words is in the piece it begins in.
    """

    def some(most: int) -> str:  # possessive, so that no stack grows with the number of words
        return f"(?:{_WORD}+{_BREAKS[:-1]}*+){{1,{most}}}+"

    def piece(part: Column, i: Column) -> Column:
        more = F.regexp_extract(F.get("parts", i + 1), f"^{some(size - 1)}", 0) if size > 1 else F.lit("")
        return F.struct((i * PIECE).alias("at"), (i == F.size("parts") - 1).alias("last"), F.concat(part, F.coalesce(more, F.lit(""))).alias("piece"))

    parts = F.when(F.octet_length("text") > WHOLE, F.regexp_extract_all("text", F.lit(f"{_BREAKS[:-1]}*+{some(PIECE)}"), F.lit(0)))
    whole = F.array(F.struct(F.lit(0).alias("at"), F.lit(True).alias("last"), F.col("text").alias("piece")))
    cut = rows.select(*keep, "text", parts.alias("parts"))
    return cut.select(*keep, F.inline(F.when(F.get("parts", F.lit(0)).isNotNull(), F.transform("parts", piece)).otherwise(whole)))


def _with_hashes(rows: DataFrame, size: int, *keep: str) -> DataFrame:
    """Pieces with ``words``, in lower case, and their ``hashes``."""
    lower = F.transform(words_of(F.col("piece")), _lower)
    return _in_pieces(rows, size, *keep).select(*keep, "at", "last", lower.alias("words")).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _with_grams(rows: DataFrame, *keep: str) -> DataFrame:
    """With ``grams`` beside them, the hashes of all k-grams."""
    hashed = _with_hashes(rows, WINDOW, *keep)

    def gram(i: Column) -> Column:
        return F.xxhash64(*[F.get("hashes", i + j) for j in range(GRAM)])

    starts = F.sequence(F.lit(0), F.size("hashes") - GRAM)
    grams = F.when(F.size("hashes") >= WINDOW, F.transform(starts, gram)).otherwise(F.array().cast("array<bigint>"))
    return hashed.withColumn("grams", grams)


def _long_runs(rows: DataFrame, *keep: str, first: int = 0) -> DataFrame:
    """(at, start, fingerprint) of every run of ten words, with the columns to keep and ``words``; ``start`` counts from ``at``.

    With ``first=-1`` there is one more row for each text, in its last piece, of start -1, without a fingerprint.
    """
    last = F.size("grams") - _RUN
    least = F.when(F.col("last"), F.lit(first)).otherwise(F.lit(0))
    alone = F.when(F.col("last"), F.array(*[F.lit(-1)] * -first).cast("array<int>")).otherwise(F.array().cast("array<int>"))
    starts = F.when(last >= 0, F.sequence(least, last)).otherwise(alone)
    exploded = _with_grams(rows, *keep).select(*keep, "at", "words", "grams", F.explode(starts).alias("start"))
    least = F.least(*[F.get("grams", F.col("start") + j) for j in range(_RUN)])
    return exploded.select(*keep, "at", "words", "start", F.when(F.col("start") >= 0, least).alias("fingerprint"))


def _short_runs(rows: DataFrame, size: int, *keep: str) -> DataFrame:
    """The same for runs of fewer words; the fingerprint is the hash of them all."""
    hashed = _with_hashes(rows, size, *keep)
    starts = F.when(F.size("hashes") >= size, F.sequence(F.lit(0), F.size("hashes") - size)).otherwise(F.array().cast("array<int>"))
    exploded = hashed.select(*keep, "at", "words", "hashes", F.explode(starts).alias("start"))
    fingerprint = F.xxhash64(F.lit(size), *[F.get("hashes", F.col("start") + j) for j in range(size)])
    return exploded.select(*keep, "at", "words", "start", fingerprint.alias("fingerprint"))


def _runs(rows: DataFrame, size: int, *keep: str) -> DataFrame:
    return _long_runs(rows, *keep) if size == WINDOW else _short_runs(rows, size, *keep)


def _as_text(size: int) -> Column:
    """The words of a run. Without a lambda, so that it is made where the run is found and ``words`` goes no further."""
    return F.array_join(F.slice("words", F.col("start") + 1, size), " ")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, size, window, fingerprint) of all items."""
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    sized = materialize(items.withColumn("n_words", F.size(words_of(F.col("text")))).where("n_words > 0"))
    found = []
    short = [r.n_words for r in sized.where(F.col("n_words") < WINDOW).select("n_words").distinct().collect()]  # at most nine numbers
    for size in [WINDOW, *sorted(short)]:
        rows = sized.where(F.col("n_words") >= WINDOW) if size == WINDOW else sized.where(F.col("n_words") == size)
        found.append(_runs(rows, size, "item_id").select("item_id", F.lit(size).alias("size"), _as_text(size).alias("window"), "fingerprint"))
    windows = found[0]
    for more in found[1:]:
        windows = windows.unionByName(more)
    return materialize(windows.distinct())


def _candidates(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(doc_id, mark, start, window) of runs whose fingerprint the benchmark has, by way of the documents that have any of them."""
    own = _runs(documents, size, "doc_id", "mark").select("doc_id", "mark", "fingerprint").distinct()
    with_hit = own.join(wanted, "fingerprint", "left_semi").select("doc_id", "mark").distinct()
    with_hit = with_hit.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    rows = documents.join(with_hit, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left_semi")
    runs = _runs(rows, size, "doc_id", "mark").select("doc_id", "mark", (F.col("at") + F.col("start")).alias("start"), _as_text(size).alias("window"), "fingerprint")
    return runs.join(wanted, "fingerprint", "left_semi").drop("fingerprint")


def _scanned(documents: DataFrame, windows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, start, size, window) of every occurrence of a window, and (doc_id, mark, n_words) of every row."""
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # ten at most
    fingerprints = materialize(windows.select("size", "fingerprint").distinct())
    few = fingerprints.limit(most + 1).count() <= most
    texts = windows.select("size", "window").distinct()
    counts = documents.select("doc_id", "mark", F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words"))
    found = [documents.select("doc_id", "mark", F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit("").alias("window")).limit(0)]
    start = F.col("at") + F.col("start")
    for size in sizes:
        wanted = fingerprints.where(F.col("size") == size).select("fingerprint")
        if few and size == WINDOW:
            # One scan gives the runs to look at, and beside them the number of words of each text.
            runs = _long_runs(documents, "doc_id", "mark", first=-1)
            runs = runs.join(F.broadcast(wanted.withColumn("found", F.lit(True))), "fingerprint", "left").where("found OR start = -1")
            n_words = F.when(F.col("start") == -1, F.col("at") + F.size("words")).cast("long")
            both = materialize(runs.select("doc_id", "mark", start.alias("start"), F.when(F.col("found"), _as_text(size)).alias("window"), n_words.alias("n_words")))
            counts = both.where("n_words IS NOT NULL").select("doc_id", "mark", "n_words")
            runs = both.where("n_words IS NULL")
        elif few:
            runs = _runs(documents, size, "doc_id", "mark").join(F.broadcast(wanted), "fingerprint", "left_semi").select("doc_id", "mark", start.alias("start"), _as_text(size).alias("window"))
        else:
            runs = _candidates(documents, wanted, size)
        found.append(runs.select("doc_id", "mark", "start", F.lit(size).alias("size"), "window"))
    hits = reduce(DataFrame.unionByName, found)
    return materialize(hits.distinct().join(texts, ["size", "window"], "left_semi")), counts


def find_contamination(documents: DataFrame, benchmark: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Words, hit words and the items of every document; ``mark`` is a hash of its text."""
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.xxhash64("text").alias("mark"))
    windows = item_windows(benchmark)
    hits, counted = _scanned(rows, windows, most)
    key = ["doc_id", "mark"]
    before = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    stretches = hits.select(*key, F.col("start").cast("long"), (F.col("start") + F.col("size")).cast("long").alias("end")).distinct()
    done = F.coalesce(F.max("end").over(before), F.lit(0))
    fresh = stretches.select(*key, F.greatest(F.col("end") - F.greatest("start", done), F.lit(0)).alias("fresh"))
    hit_words = fresh.groupBy(*key).agg(F.sum("fresh").alias("n_hit"))
    items = hits.select(*key, "size", "window").distinct().join(windows.select("size", "window", "item_id"), ["size", "window"]).select(*key, "item_id").distinct()
    ids = items.groupBy(*key).agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    one = hit_words.join(ids, [hit_words.doc_id.eqNullSafe(ids.doc_id), hit_words.mark.eqNullSafe(ids.mark)]).select(hit_words.doc_id.alias("_id"), hit_words.mark.alias("_mark"), "n_hit", "items")
    joined = counted.join(one, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("mark").eqNullSafe(F.col("_mark")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        *key,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
