"""Packs the token ids of documents into sequences of a fixed capacity with next to no padding.

1. Every document is encoded and gets its end id. Each ``capacity`` ids of a long document are a full sequence;
   what remains is a piece shorter than that.
2. The pieces are counted by length class, rounded up to ``unit`` ids. On this histogram cutting-stock column
   generation (``cutting_stock``) finds the patterns of classes that fill sequences best, in whole numbers.
3. Pieces are ranked within their class, by counts of blocks of rows, so that a class may hold any share of
   all pieces; a piece's rank decides its pattern, sequence and slot.
4. Rounding and patterns leave small gaps. A share of the documents, chosen by a hash of the row and as large as the gaps need, is held
   back and cut freely: their ids form one stream that fills gap after gap, then full sequences.
5. A sequence that still lacks more than ``spare`` ids is divided into sequences of powers of two, which need no padding.

Only the histogram, some hundred numbers whatever the size of the table, is brought to the driver.

Nulls: a null text is encoded as the empty one, which is the end id alone. A null ``doc_id`` stays; rows that
repeat an id are packed each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, give_back, in_slices, texts
from chronotable.llm.cutting_stock import cut
from chronotable.llm.encoding import ChunkEncoder
from chronotable.sources.workspace import materialize, work_folder

_BLOCK_BITS = 16
_SHARES = 1_000_000
_TOKENS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary()), ("n", pa.int64())])


@functools.cache
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path, "dropped")


def _encoding(path: str, end_id: int, keep: bool) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path) if keep else ChunkEncoder(path, "dropped", limit=30_000)
        ending = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            at = 0
            for part in in_slices(batch.column(2), 20_000_000 if keep else 3_000_000):
                ids, bounds = encoder.encode(part)
                data, places = ids.tobytes(), (bounds * encoder.dtype.itemsize).tolist()
                rows = [data[b:e] + ending for b, e in zip(places, places[1:], strict=False)]
                counts = bounds[1:] - bounds[:-1] + 1
                keys = (batch.column(i).slice(at, len(part)) for i in (0, 1))
                yield batch_of(_TOKENS, (*keys, rows, pa.array(counts)))
                at += len(part)
        if not keep:
            del encoder
            give_back()

    return encode


def encode_documents(documents: DataFrame, tokenizer: str, end_id: int, keep: bool = True) -> DataFrame:
    """A written table of (row, doc_id, ids, n); ``row`` numbers the rows."""
    rows = texts(documents).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    encoded = rows.mapInArrow(_encoding(tokenizer, end_id, keep), "row long, doc_id long, ids binary, n long")
    path = work_folder(documents.sparkSession)
    encoded.write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema("row long, doc_id long, ids binary, n long").parquet(path)


def running_total(rows: DataFrame, order: str, value: str, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """With the sum of ``value`` over all rows before a row, by ``order`` (a long, without ties).

    Sums are taken within blocks of ``order`` and over the blocks, so no task sees more than a block's rows or
    one row per block and key.
    """
    blocked = rows.withColumn("_block", F.shiftright(order, _BLOCK_BITS))
    blocks = blocked.groupBy(*by, "_block").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*by, "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = blocked.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(offsets, [*by, "_block"]).withColumn(name, F.col("_offset") + F.col("_inside")).drop("_block", "_offset", "_inside")


def _class_of(unit: int) -> Column:
    return F.ceil(F.col("rest") / unit).cast("int")


def _histogram(pieces: DataFrame) -> tuple[dict[int, int], int]:
    """Pieces by class, at most ``capacity / unit`` numbers, and their ids."""
    rows = pieces.where("rest > 0").groupBy("size").agg(F.count("*").alias("n"), F.sum("rest").alias("ids")).collect()
    return {r["size"]: r["n"] for r in rows}, sum(r["ids"] for r in rows)


def _held_back(lengths: DataFrame, capacity: int, unit: int) -> Column:
    """The documents to be cut freely: just more ids than the gaps that the others will leave."""
    histogram, ids = _histogram(lengths)
    total = lengths.agg(F.sum("n")).first()[0] or 0
    gaps = capacity * sum(times for times, _ in cut(histogram, capacity // unit)) - ids
    share = 1.1 * gaps / max(total + gaps, 1)
    return F.pmod(F.xxhash64(F.lit(11), "row"), F.lit(_SHARES)) < int(share * _SHARES) + 1


def _slots(lengths: DataFrame, capacity: int, unit: int) -> tuple[DataFrame, int]:
    """Pieces with their sequence, and the number of sequences."""
    histogram, _ = _histogram(lengths)
    slots, used, base = [], dict.fromkeys(histogram, 0), 0
    for times, pattern in cut(histogram, capacity // unit):
        for size, each in pattern.items():
            slots.append((size, used[size], used[size] + times * each, each, base))
            used[size] += times * each
        base += times
    spark = lengths.sparkSession
    table = spark.createDataFrame(slots, "size int, low long, high long, each long, base long")  # patterns x classes, some hundred rows
    ranked = running_total(lengths.where("rest > 0").withColumn("one", F.lit(1)), "row", "one", "rank", ("size",))
    placed = ranked.join(F.broadcast(table), "size").where("low <= rank AND rank < high")
    sequence = F.col("base") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))
    return placed.select("row", (F.col("n") - F.col("rest")).alias("start"), F.col("rest").alias("length"), sequence.alias("sequence"), (-F.col("size")).cast("long").alias("turn"), F.col("rank").alias("next")), base


def _poured(held: DataFrame, gaps: DataFrame, capacity: int) -> DataFrame:
    """Lays the stream of held documents over the gaps; both have their first id in the stream as ``at``.

    Two stretches of the stream meet if they share a bucket of it, and overlap there.
    """
    width = 2 * capacity

    def bucketed(rows: DataFrame, size: str) -> DataFrame:
        return rows.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("at") / width), F.floor((F.col("at") + F.col(size) - 1) / width))))

    left = bucketed(held, "n").select("bucket", "row", "at", "n")
    right = bucketed(gaps, "gap").select("bucket", "sequence", F.col("at").alias("gap_at"), "gap")
    low = F.greatest("at", "gap_at", F.col("bucket") * width)
    high = F.least(F.col("at") + F.col("n"), F.col("gap_at") + F.col("gap"), (F.col("bucket") + 1) * width)
    met = left.join(right, "bucket").where(low < high)
    return met.select("row", (low - F.col("at")).alias("start"), (high - low).alias("length"), "sequence", F.lit(1).cast("long").alias("turn"), low.alias("next"))


def _in_powers(pieces: DataFrame, capacity: int, spare: int, sequences: int) -> DataFrame:
    """Divides sequences that lack too much into sequences of powers of two, by the binary digits of their length."""
    lacking = (F.col("filled") < capacity - spare) & (F.bit_count("filled") > 1)
    bits = capacity.bit_length()
    digits = F.filter(F.sequence(F.lit(0), F.lit(bits)), lambda b: F.getbit(F.col("filled"), b) == 1)
    parts = pieces.where(lacking).withColumn("digit", F.explode(digits))
    power = F.pow(F.lit(2), F.col("digit")).cast("long")
    first = F.col("filled") - F.col("filled") % (2 * power)
    low = F.greatest(F.col("offset"), first)
    high = F.least(F.col("offset") + F.col("length"), first + power)
    divided = parts.where(low < high).select(
        "row",
        (F.col("start") + low - F.col("offset")).alias("start"),
        (high - low).alias("length"),
        (F.lit(sequences) + F.col("sequence") * (bits + 1) + F.col("digit")).alias("sequence"),
        (low - first).alias("offset"),
    )
    return pieces.where(~lacking).select("row", "start", "length", "sequence", "offset").unionByName(divided)


def place(lengths: DataFrame, capacity: int = 4096, unit: int = 32, spare: int = 40) -> DataFrame:
    """(row, start, length, sequence, offset) of every piece, from (row, n)."""
    lengths = lengths.select("row", "n", (F.col("n") % capacity).alias("rest")).withColumn("size", _class_of(unit))
    marked = materialize(lengths.withColumn("held", _held_back(lengths, capacity, unit)))
    held, others = marked.where("held"), marked.where("NOT held")
    slots, patterned = _slots(others, capacity, unit)
    slots = materialize(slots)
    long = running_total(others.withColumn("whole", F.floor(F.col("n") / capacity)).where("whole > 0"), "row", "whole", "first")
    whole = materialize(long.select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("k"), "first").select("row", (F.col("k") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"), (F.lit(patterned) + F.col("first") + F.col("k")).alias("sequence")))
    n_whole = whole.count()
    gaps = slots.groupBy("sequence").agg((F.lit(capacity) - F.sum("length")).alias("gap")).where("gap > 0")
    gaps = materialize(running_total(gaps, "sequence", "gap", "at"))
    n_gap = gaps.agg(F.sum("gap")).first()[0] or 0
    n_held = held.agg(F.sum("n")).first()[0] or 0
    more = max(0, -(-(n_held - n_gap) // capacity))
    base = patterned + n_whole
    extra = held.sparkSession.range(more).select((F.lit(base) + F.col("id")).alias("sequence"), F.lit(capacity).cast("long").alias("gap"), (F.lit(n_gap) + F.col("id") * capacity).alias("at"))
    poured = _poured(running_total(held, "row", "n", "at"), gaps.select("sequence", "gap", "at").unionByName(extra), capacity)
    mixed = slots.unionByName(poured)
    of_sequence = Window.partitionBy("sequence")  # at most `capacity` pieces
    before = of_sequence.orderBy("turn", "next").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    mixed = mixed.select("row", "start", "length", "sequence", offset.alias("offset"), F.sum("length").over(of_sequence).alias("filled"))
    mixed = _in_powers(mixed, capacity, spare, base + more)
    return mixed.unionByName(whole.withColumn("offset", F.lit(0).cast("long")))


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def _cutting(dtype: str, with_ids: bool) -> Callable:
    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _PIECES if with_ids else pa.schema(list(_PIECES)[:-1])
        for batch in batches:
            out = []
            for doc_id, data, n, pieces in zip(batch.column(0), batch.column(1), batch.column(2), batch.column(3).to_pylist(), strict=True):
                ids, doc_id, n = np.frombuffer(data.as_buffer(), dtype), doc_id.as_py(), n.as_py()
                for p in sorted(pieces, key=lambda p: p["start"]):
                    own = ids[p["start"] : p["start"] + p["length"]]
                    row = (doc_id, p["start"], p["length"], zlib.crc32(own.astype("<u4").tobytes()), n, p["sequence"], p["offset"])
                    out.append((*row, own.tobytes()) if with_ids else row)
            yield batch_of(schema, list(zip(*out, strict=True)) or ([],) * len(schema))

    return cut_rows


def pack_documents(documents: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, with_ids: bool = False, keep: bool = True) -> DataFrame:
    """The pieces of all documents, with their place and checksum, and with their ids as bytes if wanted.

    Workers ``keep`` the words they have encoded for their next task; without, they give that memory back, which other
    stages of the same application may need.
    """
    tokens = encode_documents(documents, tokenizer, end_id, keep)
    pieces = place(tokens.select("row", "n"), capacity)
    by_row = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence", "offset")).alias("pieces"))
    joined = tokens.join(by_row, "row").select("doc_id", "ids", "n", "pieces")
    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return joined.mapInArrow(_cutting(ChunkEncoder(tokenizer, "dropped").dtype.str, with_ids), columns + ", ids binary" * with_ids)
