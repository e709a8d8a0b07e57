"""Documents whose sets of word shingles have a Jaccard similarity of at least a threshold, by a MinHash LSH forest.

1. Every text becomes its set of hashed five-word shingles (lower-cased ``\\w+`` words; a text of fewer words is one
   shingle). Texts of equal sets are one class; only classes go on, so copies never meet in pairs.
2. The forest: ``TREES`` tries over the sorted MinHash signatures, each with ``DEEPEST`` values on a path. Every class
   starts with its whole paths and shortens the prefix it matches, tree by tree, until a pair at the threshold is met with a
   probability of at least ``recall``: first where the node it comes to holds at most ``large`` classes, and where it holds more only
   while the recall is still short, the smallest node first (``prefix_lengths``). So one class may match four values in one tree and five in
   another. A class meets all classes under the nodes it stops at, those that stopped deeper included. Nodes of the same members are kept once.
3. Within a node, signatures estimate the similarity; classes well above noise are joined, which leaves out
   those that merely share a common passage. Nodes of many classes are compared as pairs of blocks; a block pair
   returns a spanning forest, never its pairs.
4. Components of those edges are candidate groups. Shingle sets are built again for their members alone, once
   each, and all pairs of a group are verified exactly, again by pairs of blocks bounded by classes and by
   shingles. A block pair returns the number of links of each class and a spanning forest of the links.
5. Components of the links are the groups; ``class_id`` is the least ``doc_id`` of a group, ``class_mark`` the least
   mark of that id in it (both together name the group, also where ids repeat), and ``n_links`` counts the other documents
   at or above the threshold, copies included.

The number of links needs every pair of different texts in a group to be looked at, so the work of step 4 grows with
the square of a group's different texts; it is spread over block pairs, and what is written grows with the texts.

Nulls: a null text, or one without a word, is alone: its own id, no links. Rows with a null ``doc_id`` are left
alone too, with a null class. Rows that repeat an id are documents like others; ``mark`` is a hash of the text
that tells them apart. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, give_back
from chronotable.llm.components import components
from chronotable.sources.workspace import materialize

SHINGLE = 5
TREES = 20
DEEPEST = 5
_VALUES = TREES * DEEPEST
_LARGE = 1024  # classes of a node that its classes come to only if they must
_BLOCK = 1024  # classes of a node or group compared at a time with as many others
_SHINGLES = 400_000  # and shingles of a block
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x100000001B3)


def depth_for(similarity: float, recall: float, trees: int = TREES, deepest: int = DEEPEST) -> int:
    """The longest prefix that finds a pair of this similarity with the probability wanted."""
    for depth in range(deepest, 1, -1):
        if 1 - (1 - similarity**depth) ** trees >= recall:
            return depth
    return 1


def prefix_lengths(large: dict[tuple[int, int], int], similarity: float, recall: float) -> list[int]:
    """How many values of its path a class matches in each tree.

    ``large`` holds the sizes of its large nodes by (tree, length). Matching the shortest useful length everywhere reaches the recall, so
    a tree is never shortened further; what that leaves over lets large nodes stay deep.
    """
    shortest = depth_for(similarity, recall)
    lengths = [next((d for d in range(shortest, DEEPEST) if (t, d) not in large), DEEPEST) for t in range(TREES)]
    missed = math.prod(1 - similarity**d for d in lengths)
    while missed > 1 - recall and max(lengths) > shortest:
        tree = min((t for t in range(TREES) if lengths[t] > shortest), key=lambda t: (large.get((t, lengths[t] - 1), 0), t))
        missed *= (1 - similarity ** (lengths[tree] - 1)) / (1 - similarity ** lengths[tree])
        lengths[tree] -= 1
    return lengths


class _Hashes(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, hashes: dict[str, int]) -> np.ndarray:
    """The sorted set of hashed shingles; empty without a word."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(values))
    total = np.full(len(values) - size + 1, size, np.uint64)
    for j in range(size):
        total = total * _BASE + values[j : j + len(total)]
    return np.unique(_mix(total))


@functools.cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(42)
    return random.integers(1, 1 << 63, _VALUES, np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 1 << 63, _VALUES, np.uint64)


def signature(values: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value."""
    factor, shift = _multipliers()
    least = np.full(_VALUES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 512):
        part = values[start : start + 512]
        np.minimum(least, (part[:, None] * factor + shift).min(axis=0), out=least)
    return (_mix(least) & np.uint64(0xFFFF)).astype(">u2")


_SIGNED = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary())])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    known: dict[bytes, bytes] = {}  # copies often come together
    for batch in batches:
        counts, digests, signatures = [], [], []
        for value in batch.column(2):
            own = shingles(value.as_py() or "", hashes)
            digest = xxhash.xxh3_128_digest(own.tobytes())
            if digest not in known:
                if len(known) > 1_000:
                    known.clear()
                known[digest] = signature(own).tobytes()
            counts.append(len(own))
            digests.append(digest)
            signatures.append(known[digest])
        yield batch_of(_SIGNED, (batch.column(0), batch.column(1), counts, digests, signatures))
    del hashes, known
    give_back()


class _Forest:
    """Union of small integers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, pairs: Iterator[tuple[int, int]]) -> None:
        for x, y in pairs:
            a, b = self.root(x), self.root(y)
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, r) for x in range(len(self.parent)) if (r := self.root(x)) != x]


def _spanning(similar: np.ndarray, forest: _Forest, rows: np.ndarray, columns: np.ndarray) -> None:
    """Joins what a matrix of booleans connects. Whole rows go at once to the row's first partner."""
    for i in np.flatnonzero(similar.any(axis=1)):
        partners = columns[np.flatnonzero(similar[i])]
        forest.join((int(rows[i]), int(p)) for p in partners)


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows, of which each may be large, without all of them at once as Python values."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _estimating(least: float) -> Callable:
    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges between classes of a node whose signatures agree in a share of at least ``least``."""
        for batch in batches:
            found: list[tuple[int, int]] = []
            for row in _one_by_one(batch):
                members = row["members"]
                ids = np.array([m["cid"] for m in members])
                sides = np.array([m["side"] for m in members])
                seeks = np.array([m["seeks"] for m in members])
                values = np.frombuffer(b"".join(m["signature"] for m in members), ">u2").reshape(len(ids), _VALUES).astype(np.uint16)
                forest = _Forest(len(ids))
                across = row["i"] != row["j"]
                left = np.flatnonzero(sides == row["i"])
                right = np.flatnonzero(sides == row["j"]) if across else left
                needed = least * _VALUES
                for x in left:
                    others = right if across else right[right > x]
                    others = others if seeks[x] else others[seeks[others]]
                    if len(others):
                        close = others[(values[others] == values[x]).sum(axis=1) >= needed]
                        forest.join((int(x), int(y)) for y in close)
                found += [(int(ids[x]), int(ids[y])) for x, y in forest.edges()]
            yield batch_of(_EDGES, list(zip(*found, strict=True)) or ([], []))
        give_back()

    return estimate


_VERIFIED = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("linked", pa.int64())])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    if n == 2:
        both = np.concatenate(sets)
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        return np.array([[len(sets[0]), common], [common, len(sets[1])]], np.float64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    everywhere, several = seen == n, (seen > 1) & (seen < n)
    total = np.full((n, n), float(everywhere.sum()), np.float64)
    column = np.cumsum(several) - 1
    used = several[place]
    owner, place = owner[used], column[place[used]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for start in range(0, int(several.sum()), 4096):
        lo, hi = np.searchsorted(place, [start, start + 4096])
        dense = np.zeros((n, 4096), np.float32)
        dense[owner[lo:hi], place[lo:hi] - start] = 1
        total += dense @ dense.T
    return total


def _verifying(threshold: float) -> Callable:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of every class of a block pair, weighted by copies, and what it hangs together with."""
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for row in _one_by_one(batch):
                members = {m["cid"]: m for m in row["members"]}  # a repeated row brings a class twice
                members = sorted(members.values(), key=lambda m: m["cid"])
                ids = [m["cid"] for m in members]
                sets = [np.frombuffer(m["shingles"], np.uint64) for m in members]
                copies = np.array([m["copies"] for m in members], np.int64)
                sizes = np.array([len(s) for s in sets], np.float64)
                if len(ids) < 2:
                    continue
                common = _overlaps(sets)
                union = sizes[:, None] + sizes[None, :] - common
                # The threshold with room for the rounding of a quotient.
                similar = common >= threshold * union - 1e-9
                np.fill_diagonal(similar, False)
                if row["i"] != row["j"]:
                    sides = np.array([m["side"] for m in members])
                    similar &= sides[:, None] != sides[None, :]
                forest = _Forest(len(ids))
                every = np.arange(len(ids))
                _spanning(np.triu(similar), forest, every, every)
                links = similar @ copies
                out += [(ids[x], int(links[x]), ids[forest.root(x)]) for x in np.flatnonzero(links)]
            yield batch_of(_VERIFIED, list(zip(*out, strict=True)) or ([], [], []))
        give_back()

    return verify


def _in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """Deals a group's rows out to blocks; each row goes to every pair (i, j) of blocks that has its own ``side``."""
    dealt = rows.withColumn("blocks", blocks).withColumn("side", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    return spread.withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")).drop("other", "blocks")


def _node(tree: int, length: int) -> Column:
    """Name of the node that a class's path passes at this length."""
    return F.xxhash64(F.lit(tree), F.lit(length), F.substring("signature", 1 + 2 * DEEPEST * tree, 2 * length))


def _choosing(similarity: float, recall: float) -> Callable:
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = ({(m["tree"], m["length"]): m["n"] for m in row} for row in batch.column(1).to_pylist())
            lengths = [prefix_lengths(large, similarity, recall) for large in sizes]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.list_(pa.int32()))], ["cid", "lengths"])

    return choose


def _chosen_lengths(classes: DataFrame, similarity: float, recall: float, large: int) -> DataFrame | None:
    """The prefix lengths (cid, lengths) of classes that come to a large node; None if there is no such node."""
    shortest = depth_for(similarity, recall)
    at_shortest = classes.select("cid", "signature", F.inline(F.array(*[F.struct(F.lit(t).alias("tree"), _node(t, shortest).alias("node")) for t in range(TREES)])))
    sizes = materialize(at_shortest.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > large))
    if sizes.isEmpty():
        return None
    # Of the longer prefixes only those below a large node can be large, and all their classes are here.
    hit = at_shortest.join(sizes, "node")
    flagged = hit.select("cid", "tree", F.lit(shortest).alias("length"), "n")
    if shortest < DEEPEST - 1:
        trees = [F.array(*[F.struct(F.lit(d).alias("length"), _node(t, d).alias("node")) for d in range(shortest + 1, DEEPEST)]) for t in range(TREES)]
        longer = materialize(hit.select("cid", "tree", F.inline(F.element_at(F.array(*trees), F.col("tree") + 1))))
        deeper = longer.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > large)
        flagged = flagged.unionByName(longer.join(deeper, "node").select("cid", "tree", "length", "n"))
    by_class = flagged.groupBy("cid").agg(F.collect_list(F.struct("tree", "length", "n")).alias("large"))  # some entries for each tree
    return materialize(by_class.mapInArrow(_choosing(similarity, recall), "cid long, lengths array<int>"))


def _stops(classes: DataFrame, similarity: float, recall: float, large: int) -> DataFrame:
    """The nodes (tree, node) where a class stops (``seeks``), and those above it, where others may stop that it must meet."""
    shortest = depth_for(similarity, recall)

    def stop(tree: int, length: int, seeks: Column) -> Column:
        return F.struct(F.lit(tree).alias("tree"), _node(tree, length).alias("node"), seeks.alias("seeks"))

    plain = F.inline(F.array(*[stop(t, shortest, F.lit(True)) for t in range(TREES)]))
    lengths = _chosen_lengths(classes, similarity, recall, large)
    if lengths is None:
        return classes.select("cid", plain)
    own = [F.element_at("lengths", t + 1) for t in range(TREES)]
    passed = [F.when(own[t] >= d, stop(t, d, own[t] == d)) for t in range(TREES) for d in range(shortest, DEEPEST + 1)]
    chosen = classes.join(lengths, "cid").select("cid", F.inline(F.filter(F.array(*passed), lambda s: s.isNotNull())))
    return classes.join(lengths, "cid", "left_anti").select("cid", plain).unionByName(chosen)


def _candidate_edges(classes: DataFrame, threshold: float, recall: float, large: int) -> DataFrame:
    paths = _stops(classes, threshold, recall, large)
    members = F.sum(F.xxhash64("cid", "seeks").cast("decimal(20,0)")).alias("members")
    nodes = paths.groupBy("tree", "node").agg(F.count("*").alias("n"), members, F.min("cid").alias("head"), F.max("seeks").alias("sought")).where("n > 1 AND sought")
    once = nodes.groupBy("n", "members", "head").agg(F.min(F.struct("tree", "node")).alias("first")).select("first.tree", "first.node", "n")
    inside = paths.join(once, ["tree", "node"]).join(classes.select("cid", "signature"), "cid")
    dealt = _in_blocks(inside, F.ceil(F.col("n") / _BLOCK))
    blocks = dealt.groupBy("tree", "node", "i", "j").agg(F.collect_list(F.struct("cid", "side", "seeks", "signature")).alias("members")).where(F.size("members") > 1)
    # Noise of an estimate from so many values: 0.04; three fifths are five deviations below the threshold 0.8.
    least = max(0.0, threshold - 5 * (threshold * (1 - threshold) / _VALUES) ** 0.5)
    return blocks.select("i", "j", "members").mapInArrow(_estimating(least), "a long, b long")


_SETS = pa.schema([("cid", pa.int64()), ("root", pa.int64()), ("copies", pa.int64()), ("shingles", pa.binary())])


def _build_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the texts that stand for a class; a row of the same id but another text is passed over."""
    hashes = _Hashes()
    for whole in batches:
        for start in range(0, whole.num_rows, 200):
            batch, out = whole.slice(start, 200), []
            for *key, digest, text in zip(*batch.columns, strict=True):
                own = shingles(text.as_py() or "", hashes).tobytes()
                if xxhash.xxh3_128_digest(own) == digest.as_py():
                    out.append((*(k.as_py() for k in key), own))
            yield batch_of(_SETS, list(zip(*out, strict=True)) or ([],) * 4)
    del hashes
    give_back()


def _verified(documents: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float, most: int) -> DataFrame:
    candidates = materialize(
        classes.join(groups.select(F.col("node").alias("cid"), "root"), "cid").select("cid", "root", "copies", "digest", "n_shingles", F.col("first_doc").alias("doc_id"))
    )
    sized = candidates.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    sized = sized.select("root", F.ceil(F.greatest(F.col("n") / _BLOCK, F.col("total") / _SHINGLES)).alias("blocks"))
    few = candidates.limit(most + 1).count() <= most
    wanted = candidates.select("cid", "root", "copies", "digest", "doc_id")
    texts = documents.join(F.broadcast(wanted) if few else wanted, "doc_id").select("cid", "root", "copies", "digest", "text")
    sets = texts.mapInArrow(_build_sets, "cid long, root long, copies long, shingles binary")
    dealt = _in_blocks(sets.join(sized, "root"), F.col("blocks"))
    blocks = dealt.groupBy("root", "i", "j").agg(F.collect_list(F.struct("cid", "side", "copies", "shingles")).alias("members")).where(F.size("members") > 1)
    return materialize(blocks.select("i", "j", "members").mapInArrow(_verifying(threshold), "cid long, links long, linked long"))


def join_similar(documents: DataFrame, threshold: float = 0.8, recall: float = 0.9999, most: int = 400_000, large: int = _LARGE) -> DataFrame:
    """``class_id`` and ``n_links`` of every document (doc_id, mark); see ``similar_groups``."""
    return similar_groups(documents, threshold, recall, most, large).drop("class_mark")


def similar_groups(documents: DataFrame, threshold: float = 0.8, recall: float = 0.9999, most: int = 400_000, large: int = _LARGE) -> DataFrame:
    """``class_id``, ``n_links`` and ``class_mark`` of every document (doc_id, mark).

    ``most`` is the number of candidate classes (some 60 bytes each) up to which they are sent to all tasks
    that read texts; beyond it texts and candidates are joined by a shuffle. ``large`` is the number
    of classes of a node above which its classes try to do without it.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), F.col("text").cast("string").alias("text"))
    signed = materialize(rows.mapInArrow(_sign, "doc_id long, mark long, n_shingles long, digest binary, signature binary"))
    real = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy("digest").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.count("*").alias("copies"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
    classes = materialize(classes.select("digest", "first.doc_id", "first.mark", "copies", "signature", "n_shingles").toDF("digest", "first_doc", "first_mark", "copies", "signature", "n_shingles").withColumn("cid", F.monotonically_increasing_id()))
    groups = components(_candidate_edges(classes, threshold, recall, large))
    verified = _verified(rows.select("doc_id", "text"), classes, groups, threshold, most)
    links = verified.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(verified.select(F.col("cid").alias("a"), F.col("linked").alias("b")))
    rooted = materialize(classes.select("cid", "digest", "first_doc", "first_mark", "copies").join(joined.withColumnRenamed("node", "cid"), "cid", "left").join(links, "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    least = rooted.groupBy("root").agg(F.min(F.struct("first_doc", "first_mark")).alias("first")).select("root", F.col("first.first_doc").alias("class_id"), F.col("first.first_mark").alias("class_mark"))
    by_digest = rooted.join(least, "root").select("digest", "class_id", "class_mark", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = real.select("doc_id", "mark", "digest").join(by_digest, "digest").select("doc_id", "mark", "class_id", "n_links", "class_mark")
    alone = signed.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "mark", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("mark").alias("class_mark"))
    return known.unionByName(alone)
