"""Token files and token counts against the libraries themselves."""

import functools
import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronotable.llm.encoding import ChunkEncoder
from chronotable.llm.queries import op2_token_files, op3_token_counts
from chronotable.llm.token_counts import TokenCounter, count_tokens
from chronotable.llm.token_files import SequenceFile, read_documents, write_token_files

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
AWKWARD = [
    "", " ", "   ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n\n b", "\ta", "it's  's 's", "x  y", "a ́b", "é ́",
    "<|endoftext|> a<|endoftext|> <|startoftext|>", "<s> </s> <unk>", "▁", "a▁ b", "▁▁a", "a\x1c b \x1cc", "日本 語", "A İ ΑΣ Σ", "0" * 500, "né " * 300, "\x00 \x00",
    "a\u0085 b", "1 2  3", "...  ...", "ﬁ ﬁ", "﻿ a", "a\r\n b",
]
text = st.text(st.one_of(st.sampled_from("ab '\n\t 1.▁é́ <|s>"), st.characters(codec="utf-8")), max_size=40)


@functools.cache
def library_of(path):
    return Tokenizer.from_file(path)


def library_ids(path, texts):
    return [e.ids for e in library_of(path).encode_batch(list(texts), add_special_tokens=False)]


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, "kept"), (WORDS, "dropped")])
def test_chunks_give_the_ids_of_whole_texts(path, spaces):
    encoder = ChunkEncoder(path, spaces, limit=5)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(text, max_size=4))
    def check(texts):
        ids, bounds = encoder.encode(pa.array(texts, pa.string()))
        assert [ids[b:e].tolist() for b, e in pairwise(bounds.tolist())] == library_ids(path, texts)

    check()
    for _ in range(2):
        check.hypothesis.inner_test(AWKWARD)
        check.hypothesis.inner_test([f"{t} {t}\n{t}" for t in AWKWARD])


def test_counts_are_those_of_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = TokenCounter(PIECES, limit=5)
    assert len(counter.whole) > 10_000

    @settings(max_examples=300, deadline=None)
    @given(st.lists(text, max_size=4))
    def check(texts):
        assert counter.count(texts) == [len(x) for x in library.encode(texts)]

    check()
    assert counter.count(AWKWARD) == [len(x) for x in library.encode(AWKWARD)]


def expected_places(rows):
    """Places of (doc_id, text) rows by the library alone."""
    start, out = 0, []
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for (doc_id, _), ids in zip(rows, library_ids(BYTES, [t or "" for _, t in rows]), strict=True):
        ids = np.array([*ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op2_token_files(spark, SF).collect()
    assert sorted(map(tuple, got)) == expected_places(rows)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {tuple(r) for r in op3_token_counts(spark, SF).collect()}
    assert got == {(i, len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t in rows}


@pytest.mark.parametrize("length", [4, 64])
def test_files(spark, documents, length):
    table = documents([*AWKWARD, None, "word " * 3000]).withColumn("start", F.lit("clash")).withColumn("ids", F.lit(1))
    table = table.unionByName(table.limit(3)).unionByName(table.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    rows = [(r.doc_id, r.text) for r in table.collect()]
    manifest = write_token_files(table, BYTES, length=length, rows=3)
    assert [tuple(r) for r in read_documents(manifest).orderBy("start").collect()] == expected_places(rows)
    everything = []
    for shard in manifest.orderBy("shard").collect():
        with SequenceFile(shard.ids_path) as file:
            for number in reversed(range(shard.n_sequences)):
                ids, mask = file.sequence(number)
                mask = mask.to_numpy(zero_copy_only=False)
                assert len(ids) == len(mask) == length
                assert not ids[~mask].any()
                assert mask.all() or number == shard.n_sequences - 1
            everything += file.ids(0, shard.n_tokens).tolist()
    whole = [x for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")) for x in [*library_ids(BYTES, [t or ""])[0], 0]]
    assert everything == whole


def test_reading_a_sequence_does_not_copy(spark, documents):
    shard = write_token_files(documents(["some words " * 500]), BYTES, length=16).first()
    with SequenceFile(shard.ids_path) as file:
        ids, mask = file.sequence(3)
        assert not ids.flags.owndata and ids.base is not None
        # The bits of the mask are those of the batch, which is mapped.
        whole = file.batch(0)["mask"].flatten()
        assert mask.type == pa.bool_() and mask.buffers()[1].address == whole.buffers()[1].address
        assert len(mask) == 16 and all(mask.to_pylist())


def test_an_id_that_most_rows_share_is_dealt_out(spark, documents):
    """Rows without an id, half of the table, lie in several shards, in one order, and none is lost."""
    table = documents([f"text number {i} of many" for i in range(400)])
    table = table.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    together = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(together, "false")
    try:
        manifest = write_token_files(table, BYTES)
    finally:
        spark.conf.unset(together)
    assert manifest.count() > 2
    assert max(r.n_documents for r in manifest.collect()) < 150
    found = read_documents(manifest).orderBy("start").collect()
    ids = [r.doc_id for r in found]
    assert ids == [None] * 200 + list(range(0, 400, 2))


def test_no_documents_and_odd_rows(spark, documents):
    empty = documents([])
    assert write_token_files(empty, BYTES).count() == 0
    assert read_documents(write_token_files(empty, BYTES)).count() == 0
    assert count_tokens(empty, PIECES).count() == 0
    table = documents([None, "a", "a"]).withColumn("n_tokens", F.lit("clash"))
    got = [tuple(r) for r in count_tokens(table.unionByName(table), PIECES, most=0).collect()]
    assert sorted(got) == [(0, 0, 0, False)] * 2 + [(1, 1, 1, True)] * 2 + [(2, 1, 1, True)] * 2
