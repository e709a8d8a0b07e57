"""Scores of the context tree against the same model written out node by node, and the base score by hand."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from chronotable.llm.common import read
from chronotable.llm.context_tree import DEPTH, Piece, grams_of, kt, pieces_of, score_documents

SF = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def bits_of(text):
    """(context, decision, bit) of every binary decision of a text."""
    whole = b"\xfe" * DEPTH + (text or "").encode().translate(LOWER) + b"\xff"
    for i in range(DEPTH, len(whole)):
        for bit in range(8):
            yield whole[i - DEPTH : i], (1 << bit) | whole[i] >> (8 - bit), whole[i] >> (7 - bit) & 1


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Brute:
    def __init__(self, texts):
        self.counts, self.children = {}, {}
        for text in texts:
            for context, node, bit in bits_of(text):
                for depth in range(DEPTH + 1):
                    key = (context[DEPTH - depth :], node)
                    self.counts.setdefault(key, [0, 0])[bit] += 1
                    if depth:
                        self.children.setdefault((key[0][1:], node), set()).add(key)
        self.weights = {}

    def weight(self, key):
        if key not in self.weights:
            own = log_kt(*self.counts.get(key, (0, 0)))
            if len(key[0]) < DEPTH:
                below = sum(self.weight(child) for child in self.children.get(key, ()))
                self.weights[key] = (np.logaddexp(own, below) - math.log(2), math.exp(own - np.logaddexp(own, below)))
            else:
                self.weights[key] = (own, 1.0)
        return self.weights[key][0]

    def one(self, context, node, depth=0):
        key = (context[DEPTH - depth :], node)
        a, b = self.counts.get(key, (0, 0))
        self.weight(key)
        share = self.weights[key][1]
        own = (b + 0.5) / (a + b + 1)
        return own if depth == DEPTH else share * own + (1 - share) * self.one(context, node, depth + 1)

    def score(self, text):
        return sum(math.log10(p if bit else 1 - p) for context, node, bit in bits_of(text) for p in [self.one(context, node)])


def brute(rows):
    learnt = [text for doc_id, text in rows if not held_out(doc_id)]
    model = Brute(learnt)
    tokens = Counter()
    for text in learnt:
        tokens.update([*(text or "").encode().translate(LOWER).split(), None])
    total, distinct = sum(tokens.values()), len(tokens)
    out = []
    for doc_id, text in rows:
        own = [*(text or "").encode().translate(LOWER).split(), None]
        base = sum(math.log10((tokens[t] + 1) / (total + distinct + 1)) for t in own)
        out.append((doc_id, held_out(doc_id), len(own), sum(tokens[t] > 0 for t in own), total, base, model.score(text)))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0, row[2], row[6])


def check(frame, rows):
    actual = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in frame.collect()), key=key)
    expected = sorted(brute(rows), key=key)
    assert [a[:5] for a in actual] == [e[:5] for e in expected]
    np.testing.assert_allclose([a[5:] for a in actual], [e[5:] for e in expected], rtol=1e-9)


TEXTS = ["The cat sat on the mat.", "the cat ate the rat", "a cat, a mat", "Ünïcode – ünïcode", "", None, " \t\n", "the cat sat on the mat", "zebra\x0bquartz\x1cx", "the the the " * 20, "İI", "cat"]


@pytest.mark.parametrize("hot", [1_000_000, 40, 0])
def test_against_brute_force(spark, hot):
    """All grams and words sent, some of them, and none."""
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(30)] + [(None, "no id"), (3, "the cat sat"), (3, "the cat sat")]
    documents = spark.createDataFrame([(i, text, 0.5) for i, text in rows], "doc_id long, text string, score double")
    check(score_documents(documents, hot=hot), rows)


def test_nothing_to_learn_from(spark):
    only = next(i for i in range(100) if held_out(i))
    documents = spark.createDataFrame([(only, "abc"), (only, None)], "doc_id long, text string")
    for row in score_documents(documents).collect():
        assert (row.train_tokens, row.n_known, row.base_score) == (0, 0, 0.0)
        assert row.bits_per_byte == pytest.approx(8)


def test_empty_table(spark):
    assert score_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pieces_of_long_texts_are_whole():
    text = b"word and another " * 50 + b"x" * 300 + b" tail"
    groups = list(pieces_of([(0, b""), (1, text), (2, b"short")], size=64))
    pieces = [p for group in groups for p in group]
    assert b"".join(p.text for p in pieces if p.row == 1) == text
    assert sum((p.text.split() for p in pieces if p.row == 1), []) == text.split()
    assert [sum(p.last for p in pieces if p.row == row) for row in range(3)] == [1, 1, 1]
    cut = np.concatenate([grams_of([p])[0] for p in pieces if p.row == 1])
    whole = grams_of([Piece(1, text, b"\xfe" * DEPTH, True)])[0]
    assert (cut == whole).all()
    assert (np.concatenate([grams_of(group)[0] for group in groups if any(p.row == 1 for p in group)])).size >= whole.size


def test_kt_is_the_estimator():
    a, b = np.array([0.0, 1, 3, 250, 0]), np.array([0.0, 0, 2, 1, 9_000])
    np.testing.assert_allclose(kt(a, b), [log_kt(x, y) for x, y in zip(a, b, strict=True)], atol=1e-9)


def test_whole_table_predicts_held_out_texts(spark):
    rows = score_documents(read(spark, SF, "documents")).where("held_out").collect()
    assert rows
    assert np.median([r.bits_per_byte for r in rows]) < 2.6
    long = [r for r in rows if r.n_tokens > 20]
    assert np.corrcoef([r.score for r in long], [r.base_score for r in long])[0, 1] > 0.95
