"""The prefix trie of conversations: which share their first turns, and what is saved by keeping those once.

1. Turns are ordered by turn (null first), then role and text, and numbered. A turn, its role and text, gets a
   dictionary id (a long) by a written table of all different turns, so texts are shuffled once, for that.
2. Every conversation is rebuilt: the first ``h`` turns of its base conversation, then its own from there on.
3. Conversations are cut into segments of ``span`` ids, so no row grows with a conversation. Those with the same ids up to
   a segment share its ``parent``, the least of their numbers; equal segments of one parent are one row, with its members,
   so thousands of copies are one. Segments are worked off from the last to the first, each taking from
   the one below what hangs under its full rows. Most corpora have one round.
4. In a round rows are dealt out to range shards by parent and ids. A shard builds, for each parent, a ternary search
   tree over the ids: its rows come sorted, and inserting the median first keeps it balanced. An iterative traversal from the
   leaves up adds members, leaves and savings to every node of the trie.
5. Nodes on the paths of the first and last row of a shard may go on in the next one. They are handed out with
   what the shard knows of them, and merged by parent and path; their sums run over merged nodes and over the
   whole subtrees that hang under them.

Members are conversations that begin with a node's turns, each counted once. ``ends_sha256`` runs over the sorted numbers
of those that end there: sorted stretches are joined to text in their own tasks, and one task per node only hashes them in order.

Nulls: a null turn comes first, a null role or text is empty; rows without ``conv_id`` belong to no conversation and are
left out. Rows that repeat are turns like others. An empty table gives no rows, not even the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, give_back
from chronotable.sources.workspace import materialize

SPAN = 256
_GROUP, _HEADS = 5, 9  # conversations of a base, and numbers of turns taken from it
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, id, bytes) of every turn, places from 0."""
    text = {name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("role", "text")}
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *text.values())
    turns = turns.withColumn("mark", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = turns.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "mark", F.octet_length("text").cast("long").alias("bytes"))
    placed = materialize(placed)
    # Aggregated values, so that the join below shuffles both sides and a common turn can be split.
    words = placed.groupBy("mark").agg(F.any_value("mark").alias("known"), F.any_value("bytes").alias("bytes"))
    words = materialize(words.select("known", "bytes").withColumn("id", F.monotonically_increasing_id()))
    return placed.drop("bytes").join(words, F.col("mark") == F.col("known")).select("conv_id", "place", "id", "bytes")


def _rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, place, id, bytes) of rebuilt conversations, and a row with null id for those without a turn."""
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(_HEADS))
    counted = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    wanted = counted.select("conv_id", "own", heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % _GROUP).alias("base"))
    # A base has at most eight turns to give.
    first = turns.where(F.col("place") < _HEADS - 1).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "id", "bytes"))).alias("given"))
    wanted = materialize(wanted.join(first.withColumnRenamed("conv_id", "base"), "base", "left").select("conv_id", "own", "h", F.slice(F.coalesce("given", F.array().cast(first.schema["given"].dataType)), F.lit(1), F.col("h").cast("int")).alias("given")))
    given = wanted.select("conv_id", F.inline("given"))
    taken = wanted.select(F.col("conv_id").alias("c"), "h", F.size("given").cast("long").alias("n"))
    own = turns.join(taken, F.col("conv_id") == F.col("c")).where("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("n")).alias("place"), "id", "bytes")
    empty = wanted.where("own <= h AND size(given) = 0").select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("bytes"))
    return given.unionByName(own).unionByName(empty)


def _segments(rebuilt: DataFrame, span: int) -> DataFrame:
    """(conv_id, segment, ids, bytes, last): at most ``span`` turns in a row."""
    turn = F.struct("place", "id", "bytes")
    cut = rebuilt.groupBy("conv_id", F.floor(F.col("place") / span).alias("segment")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # A conversation without a turn holds one row of nulls.
    real = F.filter("turns", lambda t: t["id"].isNotNull())
    cut = cut.select("conv_id", "segment", F.transform(real, lambda t: t["id"]).alias("ids"), F.transform(real, lambda t: t["bytes"]).alias("bytes"))
    return cut.withColumn("last", F.col("segment") == F.max("segment").over(Window.partitionBy("conv_id")))


# A shard


class _Tree:
    """Ternary search trees of the rows of one parent; every node of the trie is the middle link of a tree node."""

    def __init__(self) -> None:
        self.key: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.first: list[int] = [-1]  # root of the search tree below a trie node; trie node 0 is the parent itself
        self.up: list[int] = [-1]
        self.row: list[int] = [-1]  # the row that ends here
        self.depth: list[int] = [0]

    def _new(self, key: int, up: int) -> int:
        self.key.append(key)
        self.low.append(-1)
        self.high.append(-1)
        self.first.append(-1)
        self.up.append(up)
        self.row.append(-1)
        self.depth.append(self.depth[up] + 1)
        return len(self.key)  # of trie node i the search node is i - 1

    def insert(self, ids: list[int], row: int) -> None:
        at = 0
        for key in ids:
            node, side, before = self.first[at], None, 0
            while node > 0 and self.key[node - 1] != key:
                before = node - 1
                side = self.low if key < self.key[before] else self.high
                node = side[before]
            if node <= 0:
                node = self._new(key, at)
                if side is None:
                    self.first[at] = node
                else:
                    side[before] = node
            at = node
        self.row[at] = row

    def along(self, ids: list[int]) -> Iterator[tuple[int, list[int]]]:
        """The nodes on a path, the parent first, and their own paths."""
        at = 0
        yield at, []
        for step, key in enumerate(ids, 1):
            node = self.first[at]
            while self.key[node - 1] != key:
                node = (self.low if key < self.key[node - 1] else self.high)[node - 1]
            at = node
            yield at, ids[:step]


def _medians(n: int) -> Iterator[int]:
    """0 to n - 1, the median of each half before its sides."""
    stack = [(0, n)]
    while stack:
        lo, hi = stack.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            stack += [(lo, mid), (mid + 1, hi)]


_NODE = pa.schema(
    [
        ("parent", pa.int64()),
        ("depth", pa.int64()),
        ("path", pa.list_(pa.int64())),  # of nodes that may go on in another shard, else null
        ("above", pa.list_(pa.int64())),  # path of the node above, if that may go on
        ("above_conv_id", pa.int64()),  # else its least member
        ("conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved", pa.int64()),
        ("bytes", pa.int64()),
        ("item", pa.int64()),
    ]
)
_NODE_DDL = "parent long, depth long, path array<long>, above array<long>, above_conv_id long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, bytes long, item long"


def _tree_nodes(rows: list[dict], goes_on: list[list[int]]) -> Iterator[tuple]:
    """The trie nodes of sorted rows of one parent. On the paths of ``goes_on`` nodes may go on in another shard.

    Such a node carries its own share only: members here, and the children, leaves and savings of subtrees that lie
    whole here. All others are complete.
    """
    tree = _Tree()
    for at in _medians(len(rows)):
        tree.insert(rows[at]["ids"], at)
    n = len(tree.up)
    least, members, children, leaves, saved, size = ([0] * n for _ in range(6))
    for node, at in enumerate(tree.row):
        if at >= 0:
            row = rows[at]
            least[node], members[node] = row["least"], row["n"]
            children[node], leaves[node], saved[node] = row["children"], row["leaves"], row["saved"]
            up = node
            while up > 0 and not size[up]:
                size[up] = row["bytes"][tree.depth[up] - 1]
                up = tree.up[up]
    paths = {}
    for ids in goes_on:
        for node, path in tree.along(ids):
            paths[node] = path
    # A node is made after the one above it, so from the end on all below a node come before it.
    for node in range(n - 1, -1, -1):
        whole = node not in paths
        if whole:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * size[node]
        up = tree.up[node]
        if up >= 0:
            least[up] = min(least[up], least[node]) if members[up] else least[node]
            members[up] += members[node]
            if whole:
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
    for node, up in enumerate(tree.up):
        at = tree.row[node]
        yield (
            rows[0]["parent"],
            tree.depth[node],
            paths.get(node),
            paths.get(up),
            None if up < 0 or up in paths else least[up],
            least[node],
            members[node],
            children[node],
            leaves[node],
            saved[node],
            size[node],
            rows[at]["item"] if at >= 0 else None,
        )


def _sharding(most: int) -> Callable:
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nodes of the rows of a range shard; what has more than ``most`` rows of one parent is cut like shards are."""
        rows: list[dict] = []
        open_left = True
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if rows and (rows[0]["parent"] != row["parent"] or len(rows) >= most):
                    cut = rows[0]["parent"] == row["parent"]
                    out += _tree_nodes(rows, [rows[0]["ids"]] * open_left + [rows[-1]["ids"]] * cut)
                    rows, open_left = [], cut
                rows.append(row)
            if out:
                yield batch_of(_NODE, zip(*out, strict=True))
        if rows:
            yield batch_of(_NODE, zip(*_tree_nodes(rows, [rows[0]["ids"]] * open_left + [rows[-1]["ids"]]), strict=True))
        give_back()

    return shards


def _merged(nodes: DataFrame) -> DataFrame:
    """Nodes that go on in several shards, once each and with all that hangs under them."""
    key = ["parent", "path"]
    once = nodes.where("path IS NOT NULL").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.max("bytes").alias("bytes"),
        F.min("item").alias("item"),
    )
    once = materialize(once)
    above = F.slice("path", F.lit(1), F.size("path") - 1)
    inner = once.where(F.size("path") > 0)
    born = inner.groupBy("parent", above.alias("path")).agg(F.count("*").alias("born"))
    grown = once.join(born, key, "left").withColumn("n_children", F.col("n_children") + F.coalesce("born", F.lit(0))).drop("born")
    grown = grown.withColumns({"n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"), "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")})
    grown = materialize(grown)
    # Every node hands its share to all nodes on its path; their number is bounded by shards and the span.
    to = F.explode(F.transform(F.sequence(F.lit(0), F.size("path")), lambda k: F.slice("path", F.lit(1), k)))
    sums = grown.select("parent", to.alias("path"), "n_leaves", "saved").groupBy(*key).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    firsts = grown.select("parent", F.col("path").alias("above"), F.col("conv_id").alias("above_conv_id"))
    joined = grown.drop("n_leaves", "saved").join(sums, key).withColumn("above", F.when(F.size("path") > 0, above))
    return materialize(joined.join(firsts, ["parent", "above"], "left"))


_COLUMNS = ["parent", "depth", "above_conv_id", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "item"]


def _round(rows: DataFrame, most: int) -> DataFrame:
    """The nodes of one segment's rows (parent, ids, bytes, least, n, item, children, leaves, saved)."""
    dealt = rows.repartitionByRange("parent", "ids").sortWithinPartitions("parent", "ids")
    nodes = materialize(dealt.mapInArrow(_sharding(most), _NODE_DDL))
    merged = _merged(nodes)
    whole = nodes.where("path IS NULL")
    firsts = merged.select(F.col("parent").alias("p"), F.col("path").alias("q"), F.col("conv_id").alias("c"))
    hanging = whole.where("above IS NOT NULL").join(firsts, (F.col("parent") == F.col("p")) & (F.col("above") == F.col("q")))
    inside = whole.where("above IS NULL").select(*_COLUMNS)
    return materialize(inside.unionByName(hanging.withColumn("above_conv_id", F.col("c")).select(*_COLUMNS)).unionByName(merged.select(*_COLUMNS)))


# Members that end at a node

_CHUNK = pa.schema([("depth", pa.int64()), ("item", pa.int64()), ("first", pa.int64()), ("numbers", pa.string())])
_DIGEST = pa.schema([("depth", pa.int64()), ("item", pa.int64()), ("ends", pa.string())])


def _joined(batches: Iterator[pa.RecordBatch], size: int = 4_000) -> Iterator[pa.RecordBatch]:
    """Sorted numbers of a node as texts of at most ``size`` numbers."""
    key, numbers = None, []
    for batch in batches:
        out = []
        for depth, item, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (depth, item) != key or len(numbers) >= size:
                if numbers:
                    out.append((*key, numbers[0], ",".join(map(str, numbers))))
                key, numbers = (depth, item), []
            numbers.append(conv_id)
        if out:
            yield batch_of(_CHUNK, zip(*out, strict=True))
    if numbers:
        yield batch_of(_CHUNK, ([key[0]], [key[1]], [numbers[0]], [",".join(map(str, numbers))]))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's texts, which come in order."""
    key, digest = None, None
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            own = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
            numbers = batch.column(3)[i].as_py().encode()
            if own == key:
                digest.update(b"," + numbers)
                continue
            if key is not None:
                out.append((*key, digest.hexdigest()))
            key, digest = own, hashlib.sha256(numbers)
        if out:
            yield batch_of(_DIGEST, zip(*out, strict=True))
    if key is not None:
        yield batch_of(_DIGEST, ([key[0]], [key[1]], [digest.hexdigest()]))


def _ends(members: DataFrame) -> DataFrame:
    """(depth, item, ends) from (depth, item, conv_id)."""
    key = ["depth", "item"]
    sorted_ = members.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    chunks = sorted_.mapInArrow(_joined, "depth long, item long, first long, numbers string")
    return chunks.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(_digested, "depth long, item long, ends string")


def conversation_trie(conversations: DataFrame, span: int = SPAN, most: int = 20_000) -> DataFrame:
    """A row for every node: its least member, depth, least member of the node above, and what is summed below it.

    ``span`` bounds the turns of a row and ``most`` the rows of a tree; neither changes the result.
    """
    segments = materialize(_segments(_rebuilt(_numbered_turns(conversations)), span))
    last = segments.agg(F.max("segment")).first()[0]
    if last is None:
        last = -1
    # Down: the rows of each segment, and which row each conversation is in.
    rows: list[DataFrame] = []
    ended = []
    parents = segments.where("segment = 0").select("conv_id", F.lit(0).cast("long").alias("parent"))
    for number in range(int(last) + 1):
        own = segments.where(F.col("segment") == number).join(parents, "conv_id")
        own = materialize(own)
        grouped = own.groupBy("parent", "ids").agg(F.min("conv_id").alias("least"), F.count("*").alias("n"), F.max("last").alias("ends"), F.min("bytes").alias("bytes"))
        rows.append(materialize(grouped))
        named = rows[-1].select(F.col("parent").alias("p"), F.col("ids").alias("i"), "least")
        placed = materialize(own.join(named, (F.col("parent") == F.col("p")) & (F.col("ids") == F.col("i"))).select("conv_id", "least", "last", (F.size("ids") + number * span).cast("long").alias("depth")))
        ended.append(placed.where("last").select("depth", F.col("least").alias("item"), "conv_id"))
        parents = placed.where("NOT last").select("conv_id", F.col("least").alias("parent"))
    # Up: what hangs under a full row is known from the round before.
    below = None
    found: list[DataFrame] = []
    for number in reversed(range(int(last) + 1)):
        own = rows[number].withColumn("item", F.when(F.col("ends"), F.col("least")))
        if below is None:
            own = own.withColumns({c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")})
        else:
            own = own.join(below, "least", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("children", "leaves", "saved")})
        nodes = _round(own.select("parent", "ids", "bytes", "least", "n", "item", "children", "leaves", "saved"), most)
        tops = nodes.where("depth = 0")
        below = tops.select(F.col("parent").alias("least"), F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), "saved")
        if number:
            nodes = nodes.where("depth > 0").withColumn("above_conv_id", F.when(F.col("depth") == 1, F.col("parent")).otherwise(F.col("above_conv_id")))
        found.append(nodes.withColumn("depth", F.col("depth") + number * span))
    if not found:
        return _result(None, segments.sparkSession.createDataFrame([], _RESULT))
    every, ends = found[0], ended[0]
    for more in found[1:]:
        every = every.unionByName(more)
    for more in ended[1:]:
        ends = ends.unionByName(more)
    return _result(every, _ends(ends))


_RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _result(nodes: DataFrame | None, ends: DataFrame) -> DataFrame:
    if nodes is None:
        return ends
    ends = materialize(ends)
    return nodes.join(ends, ["depth", "item"], "left").select(
        "conv_id",
        "depth",
        F.col("above_conv_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
