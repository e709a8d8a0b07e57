"""The conversation trie against brute force and its SQL, whatever the size of segments and trees."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from compare import compare, connect

from chronotable.llm.conversation_trie import _medians, _Tree, conversation_trie
from chronotable.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(rows):
    whole = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in whole.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(c)
    children = defaultdict(set)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].add(prefix)
    out = []
    for prefix, convs in members.items():
        under = [p for p in members if p[: len(prefix)] == prefix]
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(prefix))
        out.append(
            (
                min(convs),
                len(prefix),
                min(members[prefix[:-1]]) if prefix else None,
                len(convs),
                len(children[prefix]),
                sum(not children[p] for p in under),
                sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in under if p),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=lambda r: (r[1], r[0]))


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=lambda r: (r[1], r[0]))


def made(spark, rows):
    return spark.createDataFrame([(*row, 1.5) for row in rows], "conv_id long, turn long, role string, text string, depth double")


ROWS = (
    [(c, t, "user" if t % 2 == 0 else "bot", f"turn {t if t < 4 else c % 7} ü") for c in range(60) for t in range(1 + c % 11)]
    # Copies, a long one and one that goes on after it, empty texts, nulls and ties.
    + [(100 + c, t, "user", "same") for c in range(40) for t in range(12)]
    + [(c, t, "user", f"t{t}") for c in (200, 205, 210) for t in range(30 + c % 200)]
    + [(300, None, None, "first"), (300, 1, "user", None), (300, 1, "user", "b"), (300, 1, "user", "a"), (300, 1, "user", "a"), (None, 0, "user", "lost")]
    + [(403, 0, "u", "short")]
)


@pytest.mark.parametrize(("span", "most"), [(256, 20_000), (2, 20_000), (5, 3), (256, 1), (1, 2)])
def test_against_brute_force(spark, span, most):
    assert found(conversation_trie(made(spark, ROWS), span, most)) == brute(ROWS)


def test_one_conversation_of_no_turn_is_the_root(spark):
    # No base, and h is past its only turn.
    lone = next(c for c in range(1, 1_000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(lone, 0, "u", "x")]
    assert found(conversation_trie(made(spark, rows))) == brute(rows)
    assert len(brute(rows)) == 1


def test_empty_table(spark):
    assert conversation_trie(made(spark, [])).collect() == []
    assert conversation_trie(made(spark, [(None, 0, "u", "x")])).collect() == []


def test_query_against_sql(spark):
    assert compare(spark, connect(SF), QUERIES["op12_conversation_trie"], SQL["op12_conversation_trie"], SF) == []


def test_search_trees_are_balanced():
    tree = _Tree()
    for at in _medians(1_000):
        tree.insert([at], at)
    deepest = 0
    for key in range(1_000):
        node, steps = tree.first[0], 1
        while tree.key[node - 1] != key:
            node = (tree.low if key < tree.key[node - 1] else tree.high)[node - 1]
            steps += 1
        deepest = max(deepest, steps)
    assert deepest <= 10
