"""Cutting stock and packing: every id once, gapless sequences, little padding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronotable.llm.cutting_stock import cut, relaxed
from chronotable.llm.packing import pack_documents, place, running_total
from chronotable.llm.queries import op10_packing

SF = "/root/testdata/sf0.01"
WORDS = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 300), max_size=12))
def test_rolls_hold_exactly_the_pieces(histogram):
    rolls = cut(histogram, 40)
    pieces = Counter()
    for times, pattern in rolls:
        assert times > 0
        assert sum(s * c for s, c in pattern.items()) <= 40
        for s, c in pattern.items():
            pieces[s] += times * c
    assert pieces == Counter({s: n for s, n in histogram.items() if n})
    bound = sum(x for x, _ in relaxed(histogram, 40))
    assert sum(t for t, _ in rolls) <= bound + len(histogram) + 1


def test_the_textbook_example():
    # Rolls of 100: 97 of 45, 610 of 36, 395 of 31 and 211 of 14 need 452.25 rolls as fractions.
    histogram = {45: 97, 36: 610, 31: 395, 14: 211}
    assert sum(x for x, _ in relaxed(histogram, 100)) == pytest.approx(452.25)
    assert sum(t for t, _ in cut(histogram, 100)) == 453


def test_running_total(spark):
    rows = [(i * 40_000 + i % 3, i % 4, (i * 7) % 11) for i in range(50)]
    got = running_total(spark.createDataFrame(rows, "o long, k long, v long"), "o", "v", "t", ("k",)).collect()
    seen = defaultdict(int)
    for r in sorted(got, key=lambda r: r.o):
        assert r.t == seen[r.k]
        seen[r.k] += r.v
    assert len(got) == 50


def check(pieces, capacity, expected):
    """pieces: (key, start, length, sequence, offset); expected: ids by key. Returns the padded ids."""
    by_key, by_sequence = defaultdict(list), defaultdict(list)
    for key, start, length, sequence, offset in pieces:
        assert length > 0
        by_key[key].append((start, length))
        by_sequence[sequence].append((offset, length))
    assert {k: sum(n for _, n in v) for k, v in by_key.items()} == expected
    for parts in by_key.values():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


@pytest.mark.parametrize("kind", ["mixed", "just over half", "one", "tiny", "long", "equal"])
def test_places(spark, kind):
    rng = np.random.default_rng(7)
    sizes = {
        "mixed": rng.lognormal(6, 1.3, 3000).astype(int) + 1,
        "just over half": np.full(400, 2100),
        "one": [5000],
        "tiny": [1, 2, 3],
        "long": [100_000, 4096, 4097, 4095, 1],
        "equal": np.full(3000, 900),
    }[kind]
    rows = [(int(i) + (i % 3 << 33), int(n)) for i, n in enumerate(sizes)]
    pieces = [(r.row, r.start, r.length, r.sequence, r.offset) for r in place(spark.createDataFrame(rows, "row long, n long")).select("row", "start", "length", "sequence", "offset").collect()]
    padding = check(pieces, 4096, dict(rows))
    assert padding <= 0.01 * sum(sizes)


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    encoded = Tokenizer.from_file(WORDS).encode_batch(list(texts.values()), add_special_tokens=False)
    ids = {k: np.array([*e.ids, 2], "<u4") for k, e in zip(texts, encoded, strict=True)}
    rows = op10_packing(spark, SF).collect()
    pieces = [(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in rows]
    assert check(pieces, 4096, {k: len(v) for k, v in ids.items()}) <= 0.01 * sum(map(len, ids.values()))
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())


def test_odd_rows(spark, documents):
    table = documents([None, "", "a b c", "word " * 9000]).withColumn("row", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("start", F.lit(1))
    table = table.unionByName(table).unionByName(table.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    rows = pack_documents(table, WORDS, 2, capacity=64, with_ids=True).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.doc_id] += r.length
        assert zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32
    assert tokens == {None: 1, 0: 2, 1: 2, 2: 8, 3: 18002}
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert len({p[:2] for p in places}) == len(places)
    assert pack_documents(documents([]), WORDS, 2).count() == 0
