"""Collocations: phrases of two or three words that stand together more often than their parts explain, per language.

Phrases are counted one length after the other, in a trie of word ids whose lower parts are hash containers (a
HAT-trie): the root branches on the first word, a container holds the rest of a phrase with its count, and one that
grows past ``BURST`` entries bursts into a branch on the next word. A task that holds more than ``HELD`` entries
spills its largest subtrees, whole, as runs that are sorted by first word. A run belongs to a prefix partition, given by
the first word and, for the few thousand most frequent ones, also by one of ``FAN`` parts of the second. Spark brings the runs of
a partition together, where they are merged, one first word after the other, and only phrases of at least ``least`` occurrences stay.

A phrase is never more frequent than a phrase within it. So words below ``least`` are left out of pairs and pairs below it out
of triples, which loses nothing. What is frequent goes to the tasks as a bit map of hashes of a fixed size, however
large the corpus: a chance hit costs work in a container and no more.

Lower-casing is of A-Z alone. ``.,;:!?``, line feeds and the three control characters after it end a piece; spaces and tabs part the
words of one. Occurrences may overlap.

Nulls: a null language is ``und``, a null text has no words. Repeated rows count as often as they come. Ties go by
phrase, in the order of UTF-8 bytes. Texts of any length are counted whole, in overlapping stretches. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import gc
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, give_back
from chronotable.sources.workspace import materialize

BURST = 4_096
HELD = 800_000
FAN = 16
BITS = 26  # of a position in the map of frequent hashes: 8 MB
_HOT = 4_096  # a word with more than this part of all occurrences begins phrases in FAN partitions
_MASK = (1 << BITS) - 1
_PIECE = 1 << 15  # bits of a row of the map
_TURN = 20  # the second hash of a pair is turned by so many bits
_ID = 21  # bits of a word's id
_STRETCH = 400_000  # words of a text looked at together
_TOGETHER = 1_000_000  # words sorted together; with a stretch more and _KNOWN, fewer than there are ids
_KNOWN = 600_000  # words after which a task begins with new ids
_BYTES = 4 << 20  # of text behind a prefix partition

_END = b"\xff"  # no byte of UTF-8
_LOWERED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _END * 10)


def words_of(text: str) -> list[bytes]:
    """The words of a text in order, with ``_END`` between pieces."""
    return text.encode("utf-8", "replace").translate(_LOWERED).replace(_END, b" \xff ").split()


class _Branch(dict):
    """A burst container: the next id leads to a container of its own."""


class HatTrie:
    """Counts of phrases of one length, given as a first id and the packed ids of the rest."""

    def __init__(self, length: int, burst: int = BURST):
        self.length, self.burst = length, burst
        self.root: dict[int, dict] = {}
        self.sizes: Counter[int] = Counter()
        self.entries = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds sorted packed keys."""
        if not len(keys):
            return
        shift = np.uint64(_ID * (self.length - 1))
        firsts = keys >> shift
        rests = (keys - (firsts << shift)).tolist()
        starts = np.flatnonzero(np.concatenate([[True], firsts[1:] != firsts[:-1]]))
        stops = np.append(starts[1:], len(keys)).tolist()
        numbers = counts.tolist()
        for first, start, stop in zip(firsts[starts].tolist(), starts.tolist(), stops, strict=True):
            node = self.root.get(first)
            if node is None:
                node = self.root[first] = dict(zip(rests[start:stop], numbers[start:stop], strict=True))
                grown = stop - start
            else:
                grown = self._into(node, rests[start:stop], numbers[start:stop])
            self.sizes[first] += grown
            self.entries += grown
            if self.length > 2 and len(node) > self.burst and not isinstance(node, _Branch):
                self.root[first] = self._burst(node)

    @staticmethod
    def _into(node: dict, rests: list[int], counts: list[int]) -> int:
        grown = 0
        if not isinstance(node, _Branch):
            before = len(node)
            for rest, count in zip(rests, counts, strict=True):
                node[rest] = node.get(rest, 0) + count
            return len(node) - before
        for rest, count in zip(rests, counts, strict=True):
            child = node.setdefault(rest >> _ID, {})
            rest &= (1 << _ID) - 1
            if rest in child:
                child[rest] += count
            else:
                child[rest] = count
                grown += 1
        return grown

    @staticmethod
    def _burst(node: dict) -> _Branch:
        branch = _Branch()
        for rest, count in node.items():
            branch.setdefault(rest >> _ID, {})[rest & ((1 << _ID) - 1)] = count
        return branch

    def spill(self, keep: int) -> Iterator[tuple[int, list[int], list[int]]]:
        """Takes whole subtrees out, the largest first, until ``keep`` entries stay: first id, packed rests and counts."""
        if keep:
            chosen, left = [], self.entries
            for first, size in self.sizes.most_common():
                if left <= keep:
                    break
                left -= size
                chosen.append((first, self.root.pop(first)))
                del self.sizes[first]
            self.entries = left
        else:
            chosen = list(self.root.items())
            self.root, self.sizes, self.entries = {}, Counter(), 0
        for first, node in chosen:
            if isinstance(node, _Branch):
                rests = [child << _ID | last for child, inner in node.items() for last in inner]
                yield first, rests, [n for inner in node.values() for n in inner.values()]
            else:
                yield first, list(node), list(node.values())


class _Words:
    """Ids of the words a task has met, each of one language. A word that is not frequent gets none."""

    def __init__(self, frequent: np.ndarray | None):
        self.words: list[bytes] = []
        self.langs: list[str] = []
        self.hashes: list[int] = []
        self.frequent = frequent
        self.by_lang: dict[str, _OfLang] = {}
        self.array = np.zeros(0, np.uint64)

    def of(self, lang: str) -> _OfLang:
        if lang not in self.by_lang:
            self.by_lang[lang] = _OfLang(self, lang)
        return self.by_lang[lang]

    def hashed(self) -> np.ndarray:
        """The hashes by id."""
        if len(self.array) < len(self.hashes):
            fresh = self.hashes[len(self.array) :]
            self.array = np.concatenate([self.array, np.fromiter(fresh, np.uint64, len(fresh))])
        return self.array


class _OfLang(dict):
    def __init__(self, every: _Words, lang: str):
        super().__init__()
        self.every, self.lang = every, lang
        self.mark = lang.encode("utf-8", "replace") + b"\x00"
        self[_END] = -1

    def __missing__(self, word: bytes) -> int:
        every = self.every
        value = xxhash.xxh64_intdigest(self.mark + word, 42)
        if every.frequent is not None:
            at = value & _MASK
            if not every.frequent[at >> 3] >> (at & 7) & 1:
                return -1
        number = self[word] = len(every.words)
        every.words.append(word)
        every.langs.append(self.lang)
        every.hashes.append(value)
        return number


def _set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of these hashes are set."""
    at = hashes & np.uint64(_MASK)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


_RUN = pa.schema([("part", pa.int64()), ("lang", pa.string()), ("phrases", pa.binary()), ("counts", pa.binary()), ("total", pa.int64())])
_RUN_DDL = "part long, lang string, phrases binary, counts binary, total long"


class _Filters(NamedTuple):
    """What is known of shorter phrases: bit maps of frequent words and pairs, and the hashes of very frequent words."""

    words: np.ndarray | None = None
    pairs: np.ndarray | None = None
    hot: frozenset[int] = frozenset()


class _Counting:
    """Counts phrases of one length in the texts of a task and hands out sorted runs."""

    def __init__(self, length: int, parts: int, filters: _Filters, held: int):
        self.length, self.parts, self.filters, self.held = length, parts, filters, held
        self.words = _Words(filters.words)
        self.trie = HatTrie(length)
        self.single = np.zeros(0, np.int64)  # counts of single words by id: a root without anything below
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: str) -> Iterator[pa.RecordBatch]:
        tokens = words_of(text)
        reach = _STRETCH + self.length - 1
        for start in range(0, len(tokens), _STRETCH):
            part = tokens[start : start + reach]
            self.waiting.append(np.fromiter(map(self.words.of(lang).__getitem__, part), np.int64, len(part)))
            self.size += len(part)
            # A stretch that goes on overlaps the next one; its last phrases begin before that.
            self.waiting.append(np.full(1, -1))
            if self.size >= _TOGETHER:
                self._take()
                if self.trie.entries > self.held:
                    yield from self._runs(self.held // 2)
                if len(self.words.words) > _KNOWN:
                    yield from self.end()
                    self.words = _Words(self.filters.words)

    def _take(self) -> None:
        """Phrases of the waiting stretches go into the trie."""
        if not self.waiting:
            return
        ids = np.concatenate(self.waiting)
        self.waiting, self.size = [], 0
        good = ids >= 0
        if self.length == 1:
            counts = np.bincount(ids[good], minlength=len(self.words.words))
            counts[: len(self.single)] += self.single
            self.single = counts
            return
        places = np.flatnonzero(good[: len(ids) - self.length + 1])
        for step in range(1, self.length):
            places = places[good[places + step]]
        if self.length > 2:
            hashes = self.words.hashed()
            for step in range(self.length - 1):
                left, right = hashes[ids[places + step]], hashes[ids[places + step + 1]]
                places = places[_set(self.filters.pairs, left ^ (right >> np.uint64(_TURN)))]
        keys = np.zeros(len(places), np.uint64)
        for step in range(self.length):
            keys = keys << np.uint64(_ID) | ids[places + step].astype(np.uint64)
        self.trie.add(*np.unique(keys, return_counts=True))

    def end(self) -> Iterator[pa.RecordBatch]:
        self._take()
        yield from self._runs(0)

    def _fanned(self, value: int, rests: list[int]) -> Iterator[tuple[int, list[int]]]:
        """The prefix partitions of a hot word's subtree, and which of its entries go there."""
        second = np.array(rests, np.int64) >> _ID * (self.length - 2)
        fan = self.words.hashed()[second] % np.uint64(FAN)
        for branch in np.unique(fan).tolist():
            yield (value + branch) % self.parts, np.flatnonzero(fan == branch).tolist()

    def _subtrees(self, keep: int) -> Iterator[tuple[int, bytes, int, list[int]]]:
        """Partition, line, first word and counts of what is spilled."""
        words, hashes = self.words.words, self.words.hashes
        if self.length == 1:
            counts = self.single.tolist()
            self.single = np.zeros(0, np.int64)
            for i in sorted(range(len(counts)), key=words.__getitem__):
                if counts[i]:
                    yield hashes[i] % self.parts, words[i], i, counts[i : i + 1]
            return
        low = (1 << _ID) - 1
        subtrees = self.trie.spill(keep)
        for first, rests, counts in sorted(subtrees, key=lambda subtree: words[subtree[0]]):
            found = [words[i] for i in rests] if self.length == 2 else [words[i >> _ID] + b" " + words[i & low] for i in rests]
            value = hashes[first]
            if value not in self.filters.hot:
                yield value % self.parts, words[first] + b"\t" + b"\t".join(found), first, counts
                continue
            for part, chosen in self._fanned(value, rests):
                yield part, b"\t".join([words[first], *[found[i] for i in chosen]]), first, [counts[i] for i in chosen]

    def _runs(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Subtrees as lines of a first word and what follows it, sorted by first word in each partition and language."""
        langs = self.words.langs
        runs: dict[tuple[int, str], tuple[list[bytes], list[int]]] = defaultdict(lambda: ([], []))
        for part, line, first, counts in self._subtrees(keep):
            lines, numbers = runs[part, langs[first]]
            lines.append(line)
            numbers += counts
        out, size = [], 0
        for (part, lang), (lines, counts) in sorted(runs.items(), key=itemgetter(0)):
            numbers = np.array(counts, "<i8")
            out.append((part, lang, b"\n".join(lines), numbers.tobytes(), int(numbers.sum())))
            size += len(numbers)
            if size > 50_000:
                yield batch_of(_RUN, zip(*out, strict=True))
                out, size = [], 0
        if out:
            yield batch_of(_RUN, zip(*out, strict=True))


def _counter(length: int, parts: int, filters: _Filters, held: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = _Counting(length, parts, filters, held)
        gc.disable()  # very many small containers, none in a cycle
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                yield from counting.add(lang.as_py(), text.as_py())
        yield from counting.end()
        del counting
        gc.enable()
        give_back()

    return count


_PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def _lines(runs: pa.Table, lang: str) -> list[tuple[bytes, list[bytes], list[int]]]:
    """First word, rests and counts of the subtrees of a language, sorted by first word."""
    lines = []
    for i in range(runs.num_rows):
        if runs.column("lang")[i].as_py() != lang:
            continue
        counts = np.frombuffer(runs.column("counts")[i].as_py(), "<i8").tolist()
        at = 0
        for line in runs.column("phrases")[i].as_py().split(b"\n"):
            first, _, more = line.partition(b"\t")
            rests = more.split(b"\t")  # of a single word: one empty rest
            lines.append((first, rests, counts[at : at + len(rests)]))
            at += len(rests)
    # Each run is sorted, and Python's sort merges what is.
    lines.sort(key=itemgetter(0))
    return lines


def _merger(least: int) -> Callable:
    def merge(runs: pa.Table) -> pa.Table:
        """Sums of equal phrases of a partition's runs, one first word after the other; phrases below ``least`` go."""
        gc.disable()
        out: list[tuple[str, str, int]] = []
        for lang in sorted(set(runs.column("lang").to_pylist())):
            for first, same in groupby(_lines(runs, lang), itemgetter(0)):
                sums: dict[bytes, int] = {}
                for _, rests, counts in same:
                    for rest, n in zip(rests, counts, strict=True):
                        sums[rest] = sums.get(rest, 0) + n
                for rest, n in sums.items():
                    if n >= least:
                        phrase = first + b" " + rest if rest else first
                        out.append((lang, phrase.decode("utf-8", "replace"), n))
        gc.enable()
        columns = list(zip(*out, strict=True)) or ([], [], [])
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _PHRASES, strict=True)], schema=_PHRASES)

    return merge


def _runs(rows: DataFrame, length: int, parts: int, filters: _Filters, held: int) -> DataFrame:
    return rows.mapInArrow(_counter(length, parts, filters, held), _RUN_DDL)


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of phrases with at least so many occurrences."""
    merged = runs.select("part", "lang", "phrases", "counts").groupBy("part").applyInArrow(_merger(least), "lang string, phrase string, n long")
    return materialize(merged)


def _hash(lang: str, word: Column) -> Column:
    return F.xxhash64(F.concat(F.col(lang).cast("binary"), F.lit(b"\x00"), word.cast("binary")))


def _bits(hashes: DataFrame) -> np.ndarray:
    """The map of a column ``h``: at most 2,048 rows of 4 KB come to the driver."""
    at = F.col("h").bitwiseAND(F.lit(_MASK).cast("long"))
    placed = hashes.select(F.floor(at / _PIECE).cast("int").alias("row"), (at % _PIECE).alias("bit"))
    out = np.zeros((_MASK + 1) // 8, np.uint8)
    for row in placed.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        start = row.row * _PIECE // 8
        out[start : start + len(row.bits)] = np.frombuffer(bytes(row.bits), np.uint8)
    return out


def _score(a: str, left: str, right: str) -> Column:
    """floor(1,000,000 a² / (l r)) in whole numbers of up to 38 digits."""
    wide = "cast({} as decimal(19,0))".format
    return F.expr(f"({wide(a)} * {wide(a)} * 1000000BD) div ({wide(left)} * {wide(right)})")


def find_collocations(documents: DataFrame, least: int = 10, top: int = 2_000, contained: int = 50, held: int = HELD) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the lowest-scoring cut, ``n`` all words of the language.
    A phrase is left out if a longer candidate holds it and has at least ``contained`` hundredths of its count.
    """
    rows = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(64, size // _BYTES)
    runs = materialize(_runs(rows, 1, parts, _Filters(), held))
    totals = materialize(runs.groupBy("lang").agg(F.sum("total").alias("words")))
    words = _merged(runs, least)
    hashes = words.select(_hash("lang", F.col("phrase")).alias("h"), "n")
    # Fewer than _HOT words can be that frequent, however many there are.
    every = totals.agg(F.sum("words")).first()[0] or 0
    hot = frozenset(row.h % (1 << 64) for row in hashes.where(F.col("n") * _HOT > every).select("h").collect())
    filters = _Filters(_bits(hashes.select("h")), None, hot)
    pairs = _merged(_runs(rows, 2, parts, filters, held), least)
    both = [F.split_part("phrase", F.lit(" "), F.lit(k)) for k in (1, 2)]
    pair_hash = _hash("lang", both[0]).bitwiseXOR(F.shiftrightunsigned(_hash("lang", both[1]), _TURN))
    triples = _merged(_runs(rows, 3, parts, filters._replace(pairs=_bits(pairs.select(pair_hash.alias("h")))), held), least)
    return _ranked(words, pairs, triples, totals, top, contained)


def _ranked(words: DataFrame, pairs: DataFrame, triples: DataFrame, totals: DataFrame, top: int, contained: int) -> DataFrame:
    def counted(rows: DataFrame, part: str, by: DataFrame, name: str) -> DataFrame:
        side = by.select(F.col("lang"), F.col("phrase").alias(part), F.col("n").alias(name))
        return rows.join(side, ["lang", part])

    # The parts of a candidate are at least as frequent as it is, so each has its row.
    cut = [F.split_part("phrase", F.lit(" "), F.lit(k)) for k in (1, 2, 3)]
    two = pairs.select("lang", "phrase", F.col("n").alias("a"), cut[0].alias("w1"), cut[1].alias("w2"))
    inner = triples.select("lang", F.col("n").alias("f"), F.explode(F.array(F.concat_ws(" ", *cut[:2]), F.concat_ws(" ", *cut[1:]))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    two = two.join(longer, ["lang", "phrase"], "left").where(F.expr(f"f IS NULL OR 100 * f < {contained} * a")).drop("f")
    two = counted(counted(two, "w1", words, "l"), "w2", words, "r")
    two = two.select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score"))
    three = triples.select("lang", "phrase", F.col("n").alias("a"), cut[0].alias("w1"), F.concat_ws(" ", *cut[1:]).alias("w23"), F.concat_ws(" ", *cut[:2]).alias("w12"), cut[2].alias("w3"))
    for part, by, name in (("w1", words, "l1"), ("w23", pairs, "r1"), ("w12", pairs, "l2"), ("w3", words, "r2")):
        three = counted(three, part, by, name)
    three = three.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", "phrase", "a", *[F.when(early, F.col(x)).otherwise(F.col(y)).alias(name) for x, y, name in (("l1", "l2", "l"), ("r1", "r2", "r"), ("s1", "s2", "score"))])
    scored = two.unionByName(three)
    # The limit is applied before the shuffle too, so a task sends no more than ``top`` rows of a language.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
