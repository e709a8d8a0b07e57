"""Exact token counts with a shortcut for words that are one token.

The model merges pairs of symbols by rank, and a space is the mark that starts a word. If no piece of the
vocabulary holds a mark after another character, no merge can cross from one word into the next, so a text
falls into segments (marks, then visible characters) that are encoded independently. ``whole_words`` checks
that property over the whole vocabulary and then proves by encoding it alone, string by string, which words
are exactly one token. Those count one each by a look-up; only the other words are merged, by the library,
each distinct one once per worker. If the property fails for a model, texts are encoded whole.

Nulls: a null text counts as empty: no bytes, no tokens. A null ``doc_id`` stays null. Repeated rows give a row
each, an empty table none. Other columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, in_groups, texts

_MARK = "▁"
_SEGMENT = re.compile(" +[^ ]*")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def whole_words(model: sentencepiece.SentencePieceProcessor) -> set[str] | None:
    """Words that alone are one token; None if words of this model are not independent."""
    pieces = [(i, model.id_to_piece(i)) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    if any(_MARK in piece.lstrip(_MARK) for _, piece in pieces) or _MARK not in {p for _, p in pieces}:
        return None
    # The model must leave text as it is, but for the mark it puts in front.
    if model.normalize(" \tA ﬁ  b ") != f"{_MARK}{_MARK}\tA ﬁ{_MARK}{_MARK}b{_MARK}":
        return None
    marked = [(i, piece[1:]) for i, piece in pieces if piece.startswith(_MARK) and piece.count(_MARK) == 1 and len(piece) > 1]
    alone = model.encode([word for _, word in marked], num_threads=1)
    return {word for (i, word), ids in zip(marked, alone, strict=True) if ids == [i]}


class TokenCounter:
    """``count(texts)`` gives the number of tokens of each; ``limit`` bounds the remembered words."""

    def __init__(self, path: str, limit: int = 300_000):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.whole = whole_words(self.model)
        self.limit = limit
        self.known = self._fresh()

    def _fresh(self) -> dict[str, int]:
        return dict.fromkeys([*(self.whole or ()), ""], 1)  # the empty segment is a mark alone

    def count(self, texts: list[str]) -> list[int]:
        if self.whole is None:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        cut = [self._segments(text) for text in texts]
        if len(self.known) > self.limit:
            self.known = self._fresh()
        missing = [s for s in set().union(*cut) if s not in self.known]
        for segment, ids in zip(missing, self.model.encode(missing, num_threads=1), strict=True):
            self.known[segment] = len(ids)
        return [sum(map(self.known.__getitem__, segments)) for segments in cut]

    @staticmethod
    def _segments(text: str) -> list[str]:
        if not text:
            return []
        if _MARK in text:  # a written mark is a space to the model
            text = text.replace(_MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [segment[1:] for segment in _SEGMENT.findall(" " + text)]
        return text.split(" ")


@functools.cache
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def _counting(model: str, most: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for batch in batches:
            counts: list[int] = []
            for group in in_groups(batch.column(2)):
                counts += counter.count(group)
            yield batch_of(_SCHEMA, (batch.column(0), batch.column(1), counts, [n > most for n in counts]))

    return count


def count_tokens(documents: DataFrame, model: str, most: int = 4096) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has more than ``most`` tokens."""
    rows = texts(documents).select(F.col("doc_id").cast("long"), F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow(_counting(model, most), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
