"""Language-model scores of texts by context-tree weighting over bytes.

A text is lower-cased (A-Z), and its UTF-8 bytes are followed by one end byte that no text holds. A byte is eight binary
decisions, each with the bits before it in the byte; every decision has a tree of contexts, the last 0 to ``DEPTH``
bytes. At each node counts a and b of zeros and ones in the training texts give a Krichevsky-Trofimov estimate, and the
weighted probability of a node is half its own estimate and half the product of those of its children
(the deepest keep their own). The score of a text is the sum of log10 of what the weighted tree, as it stands after
all training texts, predicts for each of its bytes; with ``bits_per_byte`` it is also given as a code length.

1. One scan counts, in tasks, all words and all grams of ``DEPTH + 1`` bytes. Grams of texts that are not trained on are
   counted with 0, so every gram that any text needs has its place in the trees; an empty context predicts evenly.
2. Grams are dealt out by their two bytes before the last, so all deeper contexts are in one place. There the
   trees are weighted bottom up. What is above, contexts of one byte and none, are at most 256 times 255 nodes.
3. A second scan scores texts. The commonest ``hot`` grams and words are sent to all tasks, in number bounded by the parameter;
   what a text has of others is written beside its partial sums, each once with its count, joined with the tables
   by a shuffle, and added. If there are no more than ``hot`` of a kind, nothing of it is left to join.

The base score is that of single words with one added to each count, the end of a text being a word.

Nulls: a null text is empty, and is scored by its end alone. A null ``doc_id`` is trained on and not held out. Rows may repeat.
Without training texts every bit costs one. An empty table gives no rows. Texts of any length are scored whole. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, give_back
from chronotable.sources.workspace import materialize

DEPTH = 4
HOT = 250_000  # grams and words sent to all tasks
_START, _END = 0xFE, 0xFF  # no bytes of UTF-8
_GRAM = 8 * (DEPTH + 1)
_SLICE = 1 << 20  # bytes of texts looked at together
_HELD = 300_000  # grams, and words, that a task counts before it hands them out
_WORD_END = b"\xff"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _bytes_of(text: str) -> bytes:
    return text.encode("utf-8", "replace").translate(_LOWER)


class Piece(NamedTuple):
    """A text, or a part of a long one, which is cut after white space; ``lead`` are the bytes before it."""

    row: int
    text: bytes
    lead: bytes
    last: bool


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces_of(rows: Iterable[tuple[int, bytes]], size: int = _SLICE) -> Iterator[list[Piece]]:
    """The pieces of texts in order, in groups of about ``size`` bytes."""
    group: list[Piece] = []
    held = 0
    for row, text in rows:
        start, lead = 0, bytes([_START]) * DEPTH
        while start >= 0:
            space = _SPACE.search(text, start + size) if len(text) - start > size else None
            stop = space.end() if space else len(text)
            group.append(Piece(row, text[start:stop], lead, space is None))
            held += stop - start
            if held >= size:
                yield group
                group, held = [], 0
            lead = text[max(0, stop - DEPTH) : stop]
            start = stop if space else -1
    if group:
        yield group


def grams_of(pieces: list[Piece]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the pieces, and the end of each text, with the ``DEPTH`` bytes before it; and the piece's number."""
    whole = np.frombuffer(b"".join([p.lead + p.text + _WORD_END[: p.last] for p in pieces]), np.uint8)
    grams = np.zeros(len(whole) - DEPTH, np.uint64)
    for step in range(DEPTH + 1):
        grams = grams << np.uint64(8) | whole[step : step + len(grams)]
    lengths = np.array([len(p.text) + p.last for p in pieces], np.int64)
    # The places of the bytes of each piece, without those of the lead-in of the next one.
    place = np.arange(lengths.sum()) + np.repeat(np.arange(len(pieces)) * DEPTH, lengths)
    return grams[place], np.repeat(np.arange(len(pieces)), lengths)


# Training

_COUNTED = pa.schema([("kind", pa.int32()), ("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])
_COUNTED_DDL = "kind int, gram long, word binary, n long"
_GRAMS, _WORDS = 0, 1


class _Counts:
    """Grams and words of a task's texts."""

    def __init__(self) -> None:
        self.grams = np.empty(0, np.uint64)
        self.counts = np.empty(0, np.int64)
        self.words: Counter[bytes] = Counter()

    def add(self, pieces: list[Piece], trained: list[bool]) -> None:
        grams, owner = grams_of(pieces)
        # The lowest bit says whether the text is trained on, so that one sort counts both kinds.
        marked = grams << np.uint64(1) | np.array(trained, np.uint64)[owner]
        found, times = np.unique(marked, return_counts=True)
        fresh, counts = found >> np.uint64(1), times * (found & np.uint64(1)).astype(np.int64)
        every = np.concatenate([self.grams, fresh])
        self.grams, place = np.unique(every, return_inverse=True)
        self.counts = np.bincount(place, np.concatenate([self.counts, counts]), len(self.grams)).astype(np.int64)
        for piece, learnt in zip(pieces, trained, strict=True):
            if learnt:
                self.words.update(piece.text.split())
                self.words[_WORD_END] += piece.last

    def hand_out(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.grams) > least:
            for at in range(0, len(self.grams), 100_000):
                part = self.grams[at : at + 100_000].astype(np.int64)
                yield batch_of(_COUNTED, (np.full(len(part), _GRAMS, np.int32), part, pa.nulls(len(part), pa.binary()), self.counts[at : at + 100_000]))
            self.grams, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        if len(self.words) > least:
            words = list(self.words.items())
            self.words = Counter()
            for at in range(0, len(words), 100_000):
                part = words[at : at + 100_000]
                yield batch_of(_COUNTED, (np.full(len(part), _WORDS, np.int32), pa.nulls(len(part), pa.int64()), [w for w, _ in part], [n for _, n in part]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        learnt = batch.column(0).to_pylist()
        for pieces in pieces_of((i, _bytes_of(text.as_py())) for i, text in enumerate(batch.column(1))):
            counts.add(pieces, [learnt[piece.row] for piece in pieces])
            yield from counts.hand_out(_HELD)
    yield from counts.hand_out(0)
    del counts
    give_back()


# The trees


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function, by Stirling's series from 8 on and the recurrence below."""
    shift = np.zeros_like(x)
    x = x.copy()
    for _ in range(8):
        low = x < 8
        if not low.any():
            break
        shift[low] -= np.log(x[low])
        x[low] += 1
    inverse = 1 / x
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square / 1188))))
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series + shift


def kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a zeros and b ones in any order."""
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1) - math.log(math.pi)


def _nodes(byte: np.ndarray, bit: int) -> np.ndarray:
    """The decision about a bit, the highest first: 1 to 255, by the bits before it."""
    return (1 << bit) | byte >> (8 - bit)


def _weighted(own: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of the weighted probability, and the share of a node's own estimate in it."""
    if below is None:
        return own, np.ones_like(own)
    total = np.logaddexp(own, below) - math.log(2)
    return total, np.exp(own - math.log(2) - total)


class _Level:
    """Nodes of all contexts of one length; ``context`` and ``byte`` are those of each gram."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, counts: np.ndarray, bit: int):
        key = context * 256 + _nodes(byte, bit)
        self.keys, self.place = np.unique(key, return_inverse=True)
        ones = (byte >> (7 - bit) & 1).astype(bool)
        self.a = np.bincount(self.place, np.where(ones, 0, counts), len(self.keys))
        self.b = np.bincount(self.place, np.where(ones, counts, 0), len(self.keys))
        # Of a one.
        self.estimate = (self.b + 0.5) / (self.a + self.b + 1)


def below_two(grams: np.ndarray, counts: np.ndarray) -> tuple[list[np.ndarray], tuple[np.ndarray, ...]]:
    """For whole groups of grams of the same two bytes before the last, weighted bottom up to contexts of two bytes.

    Returns, for each bit, the probability of a one at each gram; and of the nodes of two bytes the last byte, the decision, the counts
    and the logarithm of the weighted probability.
    """
    grams = grams.astype(np.int64)
    byte = grams & 0xFF
    ones: list[np.ndarray] = []
    tops: list[tuple[np.ndarray, ...]] = []
    for bit in range(8):
        weight = None
        mixed = None
        for depth in range(DEPTH, 1, -1):
            context = grams >> 8 & (1 << 8 * depth) - 1
            level = _Level(context, byte, counts, bit)
            own = kt(level.a, level.b)
            if weight is None:
                weight, share = _weighted(own, None)
            else:
                # Each deeper node once, to the node that its context ends in.
                first = np.zeros(len(deeper.keys), np.int64)
                first[deeper.place] = level.place
                below = np.bincount(first, weight, len(level.keys))
                weight, share = _weighted(own, below)
            at = level.place
            mixed = level.estimate[at] if mixed is None else share[at] * level.estimate[at] + (1 - share[at]) * mixed
            deeper = level
        ones.append(mixed)
        tops.append((level.keys >> 8 & 0xFF, level.keys & 0xFF, level.a, level.b, weight))
    return ones, tuple(np.concatenate(column) for column in zip(*tops, strict=True))


def above_two(context: np.ndarray, node: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums by last byte and decision, mixed over the contexts of one byte and none.

    Returns, by last byte and decision, what these two give and the share that is left to longer contexts.
    """
    one = np.zeros((3, 256, 256))
    for sums, values in zip(one, (a, b, weight), strict=True):
        np.add.at(sums, (context, node), values)
    own = kt(one[0], one[1])
    below, share = _weighted(own, one[2])
    root_a, root_b = one[0].sum(axis=0), one[1].sum(axis=0)
    _, root_share = _weighted(kt(root_a, root_b), below.sum(axis=0))
    root = (root_b + 0.5) / (root_a + root_b + 1)
    estimate = (one[1] + 0.5) / (one[0] + one[1] + 1)
    return root_share * root + (1 - root_share) * share * estimate, (1 - root_share) * (1 - share)


def _group_ends(grams: np.ndarray) -> np.ndarray:
    """Where the two bytes before the last change."""
    key = grams >> 8 & 0xFFFF
    return np.flatnonzero(key[1:] != key[:-1]) + 1


def _whole_groups(batches: Iterator[pa.RecordBatch], size: int = 300_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted grams and counts in parts that cut no group; the memory of a part is bounded by ``size`` and the largest group."""
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for batch in batches:
        waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        held += batch.num_rows
        if held >= size:
            grams, counts = (np.concatenate(c) for c in zip(*waiting, strict=True))
            ends = _group_ends(grams)
            if len(ends):
                yield grams[: ends[-1]], counts[: ends[-1]]
                grams, counts = grams[ends[-1] :], counts[ends[-1] :]
            waiting, held = [(grams, counts)], len(grams)
    if held:
        yield tuple(np.concatenate(c) for c in zip(*waiting, strict=True))


_TREE = pa.schema([("gram", pa.int64()), ("n", pa.int64()), ("ones", pa.binary()), ("byte", pa.int32()), ("node", pa.int32()), ("a", pa.float64()), ("b", pa.float64()), ("weight", pa.float64())])
_TREE_DDL = "gram long, n long, ones binary, byte int, node int, a double, b double, weight double"


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each gram, and after those of a part the nodes of two bytes, summed by last byte and decision."""
    for grams, counts in _whole_groups(batches):
        ones, (byte, node, a, b, weight) = below_two(grams, counts)
        mixed = np.stack(ones, axis=1).astype("<f8")
        n = len(grams)
        for at in range(0, n, 20_000):
            m = min(20_000, n - at)
            blobs = pa.FixedSizeBinaryArray.from_buffers(pa.binary(64), m, [None, pa.py_buffer(np.ascontiguousarray(mixed[at : at + m]))]).cast(pa.binary())
            yield batch_of(_TREE, (grams[at : at + m], counts[at : at + m], blobs, *(pa.nulls(m, f.type) for f in list(_TREE)[3:])))
        key, place = np.unique(byte * 256 + node, return_inverse=True)
        sums = [np.bincount(place, column, len(key)) for column in (a, b, weight)]
        yield batch_of(_TREE, (*(pa.nulls(len(key), f.type) for f in list(_TREE)[:3]), (key >> 8).astype(np.int32), (key & 0xFF).astype(np.int32), *sums))
    give_back()


_PRICED = pa.schema([("gram", pa.int64()), ("n", pa.int64()), ("log_p", pa.float64())])


def _pricer(given: np.ndarray, left: np.ndarray) -> Callable:
    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """log10 of the probability of each gram's last byte after the others."""
        for batch in batches:
            grams = batch.column(0).to_numpy()
            ones = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<f8").reshape(-1, 8)
            byte, last = grams & 0xFF, grams >> 8 & 0xFF
            total = np.zeros(len(grams))
            for bit in range(8):
                node = _nodes(byte, bit)
                one = given[last, node] + left[last, node] * ones[:, bit]
                total += np.log10(np.where(byte >> (7 - bit) & 1, one, 1 - one))
            yield batch_of(_PRICED, (grams, batch.column(1), total))

    return price


def train_context_tree(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables of (gram, n, log_p) and of (word, n) from ``texts`` (trained, text), as written tables."""
    counted = materialize(texts.select("trained", "text").mapInArrow(_count, _COUNTED_DDL))
    grams = counted.where(F.col("kind") == _GRAMS).groupBy("gram").agg(F.sum("n").alias("n"))
    words = counted.where(F.col("kind") == _WORDS).groupBy("word").agg(F.sum("n").alias("n"))
    group = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    dealt = grams.repartition(group).sortWithinPartitions(group, "gram")
    tree = materialize(dealt.mapInArrow(_grow, _TREE_DDL))
    # At most 256 last bytes and 255 decisions.
    nodes = tree.where("gram IS NULL").groupBy("byte", "node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("weight").alias("weight")).toPandas()
    given, left = above_two(nodes["byte"].to_numpy(np.int64), nodes["node"].to_numpy(np.int64), nodes["a"].to_numpy(float), nodes["b"].to_numpy(float), nodes["weight"].to_numpy(float))
    priced = tree.where("gram IS NOT NULL").select("gram", "n", "ones").mapInArrow(_pricer(given, left), "gram long, n long, log_p double")
    return materialize(priced), materialize(words)


# Scoring


def _commonest(table: DataFrame, most: int) -> DataFrame:
    """Rows of at most ``most`` keys, the commonest: the least count is read off a histogram of counts."""
    steps = F.floor(F.log2(F.col("n") + 1) * 8).cast("int")
    classes = sorted(table.groupBy(steps.alias("step")).count().collect(), reverse=True)  # a few hundred
    room, least = most, None
    for step, count in classes:
        if count > room:
            break
        room, least = room - count, step
    return table.where(steps >= least) if least is not None else table.limit(0)


_PART = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("log_c", pa.float64()), ("log_p", pa.float64()), ("grams", pa.binary()), ("gram_counts", pa.list_(pa.int64())), ("words", pa.list_(pa.binary())), ("word_counts", pa.list_(pa.int64()))]
)
_PART_DDL = "row long, doc_id long, n_bytes long, n_tokens long, n_known long, log_c double, log_p double, grams binary, gram_counts array<long>, words array<binary>, word_counts array<long>"


class _Sums:
    """What the pieces of a text add up to, and what of it is left to the joins."""

    def __init__(self) -> None:
        self.n_bytes = self.n_tokens = self.n_known = 0
        self.log_c = self.log_p = 0.0
        self.grams: list[np.ndarray] = []
        self.times: list[int] = []
        self.words: list[bytes] = []
        self.counts: list[int] = []

    def add_words(self, piece: Piece, known: dict[bytes, float]) -> None:
        counts = Counter(piece.text.split())
        if piece.last:
            counts[_WORD_END] = 1
        for word, n in counts.items():
            value = known.get(word)
            if value is None:
                self.words.append(word)
                self.counts.append(n)
            else:
                self.log_c += n * value
                self.n_known += n
        self.n_tokens += counts.total()
        self.n_bytes += len(piece.text)

    def row(self) -> tuple:
        grams = b"".join(part.astype("<i8").tobytes() for part in self.grams)
        return self.n_bytes, self.n_tokens, self.n_known, self.log_c, self.log_p, grams, self.times, self.words, self.counts


def _scorer(hot: Broadcast) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prices, words = hot.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            sums = _Sums()
            for pieces in pieces_of((i, _bytes_of(text.as_py())) for i, text in enumerate(batch.column(1))):
                grams, owner = grams_of(pieces)
                # One sort brings equal grams of a piece together; the number of a piece takes the bits that a gram leaves.
                bits = np.uint64(64 - _GRAM)
                found, times = np.unique(grams << bits | owner.astype(np.uint64), return_counts=True)
                found, owner = found >> bits, (found & np.uint64((1 << (64 - _GRAM)) - 1)).astype(np.int64)
                at = np.searchsorted(keys, found)
                at[at == len(keys)] = 0
                known = keys[at] == found
                log_p = np.bincount(owner[known], prices[at[known]] * times[known], len(pieces))
                order = np.flatnonzero(~known)
                order = order[np.argsort(owner[order], kind="stable")]
                cuts = np.searchsorted(owner[order], np.arange(len(pieces) + 1))
                out = []
                for j, piece in enumerate(pieces):
                    sums.add_words(piece, words)
                    sums.log_p += float(log_p[j])
                    cold = order[cuts[j] : cuts[j + 1]]
                    sums.grams.append(found[cold])
                    sums.times += times[cold].tolist()
                    if piece.last:
                        out.append((row, batch.column(0)[piece.row].as_py(), *sums.row()))
                        sums = _Sums()
                        row += 1
                if out:
                    yield batch_of(_PART, zip(*out, strict=True))
        give_back()

    return score


_GRAM_ROWS = pa.schema([("row", pa.int64()), ("gram", pa.int64()), ("times", pa.int64())])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            grams = np.frombuffer(batch.column(1)[i].as_py(), "<i8")
            yield batch_of(_GRAM_ROWS, (np.full(len(grams), batch.column(0)[i].as_py()), grams, batch.column(2)[i].values))


def score_texts(rows: DataFrame, grams: DataFrame, words: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_known, log_c, log_p) of every row (doc_id, text).

    ``log_c`` sums log10(c + 1) over tokens, ``log_p`` is the model's log10 probability of the bytes and the end.
    """
    common = _commonest(grams, hot).select("gram", "log_p").toArrow()
    keys, prices = common.column(0).to_numpy().astype(np.uint64), common.column(1).to_numpy()
    order = np.argsort(keys)
    hot_words = _commonest(words, hot).toArrow()
    known = dict(zip(hot_words.column(0).to_pylist(), np.log10(hot_words.column(1).to_numpy() + 1.0).tolist(), strict=True))
    # A key that is no gram keeps the look-up simple where there is none.
    keys, prices = np.append(keys[order], np.uint64(1 << 63)), np.append(prices[order], 0.0)
    sent = rows.sparkSession.sparkContext.broadcast((keys, prices, known))
    parts = materialize(rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scorer(sent), _PART_DDL))
    rare_grams = parts.where(F.octet_length("grams") > 0).select("row", "grams", "gram_counts").mapInArrow(_spread, "row long, gram long, times long")
    by_gram = rare_grams.join(grams, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("log_p")).alias("more_p"))
    rare_words = parts.where(F.size("words") > 0).select("row", F.inline(F.arrays_zip("words", "word_counts")))
    met = rare_words.join(words, rare_words["words"] == words["word"]).groupBy("row")
    by_word = met.agg(F.sum("word_counts").alias("more_known"), F.sum(F.col("word_counts") * F.log10(F.col("n") + 1)).alias("more_c"))
    joined = parts.drop("grams", "gram_counts", "words", "word_counts").join(by_gram, "row", "left").join(by_word, "row", "left")

    def plus(column: str, more: str) -> Column:
        return (F.col(column) + F.coalesce(more, F.lit(0))).alias(column)

    return joined.select("doc_id", "n_bytes", "n_tokens", plus("n_known", "more_known"), plus("log_c", "more_c"), plus("log_p", "more_p"))


def score_documents(documents: DataFrame, hot: int = HOT, folds: int = 7, fold: int = 2) -> DataFrame:
    """Base score and model score of every document, learnt from those whose crc32(doc_id) mod ``folds`` is not ``fold``."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grams, words = train_context_tree(rows.select((~held).alias("trained"), "text"))
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    base = F.col("log_c") - F.col("n_tokens") * F.lit(math.log10(total + distinct + 1))
    return score_texts(rows, grams, words, hot).select(
        "doc_id",
        held.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        F.col("log_p").alias("score"),
        (F.col("log_p") * -math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
