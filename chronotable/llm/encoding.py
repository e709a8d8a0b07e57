"""Token ids of whole texts, with each distinct chunk of text encoded once.

The pre-tokenizers of the two JSON vocabularies never let a token cross certain spaces, so a text can
be cut there and the chunks encoded on their own by the library, with the same ids:

* ``kept`` (byte-level pattern): before a space that a visible character follows. A run of white space
  gives its last space to the next pre-token, so a pre-token always starts there. A line feed
  between visible characters is a pre-token of its own.
* ``dropped`` (white space is thrown away): at every space. No pre-token holds one, and neither
  normalization nor lower-casing looks across it.

Special strings hold no space, so they are never cut. Both patterns also end a pre-token between a letter and a
symbol, so a word that ends in punctuation is put together from the word and the punctuation.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Python's white space includes all that the patterns of the vocabularies know, so these cut too little, never too much.
_RARE_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_BEFORE_WORD = re.compile(r"(?= \S)")
# Letters that every version of Unicode knows as letters, then symbols.
_PUNCTUATED = re.compile("([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\\[-`{-~]+)")
_NOT_LOWERED = r"[^\x00-\x{02FF}]|<\|"
_AT_ONCE = 64  # words; long encodings cost more for each word
_PLACED = 500_000  # words put together at a time
_SPACE = "\u0120"  # fixed: how byte-level vocabularies write the byte of a space


def _unusual(text: str) -> bool:
    """Whether white space stands anywhere else than alone between two visible characters."""
    return text[:1] == "\n" or text[-1:] in (" ", "\n") or any(pair in text for pair in ("  ", " \n", "\n ", "\n\n")) or any(c in text for c in _RARE_SPACES)


class ChunkEncoder:
    """``encode(texts)`` gives the ids of an array of texts, as ``dtype``.

    Chunks that are new are encoded together, in one text, and told apart by the ids that start them. Those met
    lately are remembered: up to ``limit`` of them, and those used among the ``limit`` before.
    """

    def __init__(self, path: str, spaces: str, limit: int = 220_000):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.kept = {"kept": True, "dropped": False}[spaces]
        self.limit = limit
        self.starts = np.zeros(size, bool)
        self.separator = ""
        if self.kept:
            self.starts[[i for token, i in vocabulary.items() if token.startswith(_SPACE)]] = True
        else:
            # A digit between spaces is one token, which no other character gives.
            self.separator = "0"
            [i] = self.library.encode(self.separator, add_special_tokens=False).ids
            self.starts[i] = True
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.feed = self._alone("\n")

    def _alone(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _unknown(self, pieces: list[str]) -> list[str]:
        """Those that are not remembered; what only the older generation has moves to the new one."""
        words, older = self.words, self.older
        unknown = [p for p in pieces if p not in words]
        back = older.keys() & unknown
        words.update({p: older[p] for p in back})
        return [p for p in unknown if p not in back] if back else unknown

    def _learn(self, missing: list[str]) -> None:
        whole, composed = [], []
        for word, match in zip(missing, map(_PUNCTUATED.fullmatch, missing), strict=True):
            if match:
                composed.append((word, *match.groups()))
            else:
                whole.append(word)
        cores = self._unknown(list({core for _, core, _ in composed}))
        unknown = list(dict.fromkeys(whole + cores))
        for start in range(0, len(unknown), _AT_ONCE):
            self._encode_words(unknown[start : start + _AT_ONCE])
        words, tails = self.words, self.tails
        for word, core, tail in composed:
            if tail not in tails:
                if len(tails) > 10_000:
                    tails.clear()
                tails[tail] = self._alone(tail)
            words[word] = words[core] + tails[tail]

    def _encode_words(self, fresh: list[str]) -> None:
        if not self.kept:
            for word in [w for w in fresh if self.separator in w]:
                self.words[word] = self._alone(word)
            fresh = [w for w in fresh if self.separator not in w]
        if not fresh:
            return
        mark = " " if self.kept else f" {self.separator} "
        encoded = self.library.encode_batch_fast([mark + mark.join(fresh)], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, self.dtype)
        first = np.flatnonzero(self.starts[ids])
        if len(first) != len(fresh):
            self.words.update((w, self._alone(" " + w if self.kept else w)) for w in fresh)
            return
        size = self.dtype.itemsize
        ends = [*(first[1:] * size).tolist(), len(ids) * size]
        begins = ((first if self.kept else first + 1) * size).tolist()
        data = ids.tobytes()
        self.words.update((w, data[b:e]) for w, b, e in zip(fresh, begins, ends, strict=True))

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of strings that stand after a space; those with line feeds are put together from their lines."""
        missing = self._unknown(pieces)
        lines = {p: p.split("\n") for p in missing if "\n" in p}
        words = [p for p in missing if p not in lines] if lines else missing
        in_lines = {w for cut in lines.values() for w in (cut[:1] if self.kept else cut)}
        self._learn(list(dict.fromkeys(words + self._unknown(list(in_lines)))))
        for piece, (first, *rest) in lines.items():
            after = [self.feed + self._head(w) for w in rest] if self.kept else [self.words[w] for w in rest]
            self.words[piece] = b"".join([self.words[first], *after])
        return list(map(self.words.__getitem__, pieces))

    def _head(self, word: str) -> bytes:
        """Ids of a word that starts a line."""
        known = self.heads.get(word)
        if known is None:
            if len(self.heads) > self.limit // 4:
                self.heads.clear()
            known = self.heads[word] = self._alone(word)
        return known

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the place where each begins and, last, where they end.

        The library sees each different piece of the array at most once; all else is array work.
        """
        if len(self.words) > self.limit:
            self.words, self.older = {}, self.words
        texts = texts.fill_null("")
        if not self.kept:
            # The vocabulary knows lower case only. What combines with a letter, or is special, is left as it is.
            as_is = pc.match_substring_regex(texts, _NOT_LOWERED)
            texts = pc.if_else(as_is, texts, pc.ascii_lower(texts))
        begins: dict[int, bytes] = {}
        if self.kept:
            odd = [_unusual(t) for t in texts.to_pylist()]
            begins = {i: self._alone(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
            texts = pc.if_else(pa.array(odd, pa.bool_()), "", texts)
        lists = pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = lists.flatten().dictionary_encode()
        place = coded.indices.to_numpy()
        pieces = coded.dictionary.to_pylist()
        del lists, coded
        known = np.ones(len(pieces), bool)
        if self.kept:
            # A text's first piece has no space before it.
            first = bounds[:-1]
            starts = [begins[i] if i in begins else self._line(pieces[p]) for i, p in enumerate(place[first].tolist())]
            known = np.zeros(len(pieces), bool)
            inner = np.ones(len(place), bool)
            inner[first] = False
            known[place[inner]] = True
            place = place.copy()
            place[first] = len(pieces) + np.arange(len(first))
            del inner
        used = np.flatnonzero(known).tolist()
        table = [b""] * len(pieces)
        for i, ids in zip(used, self._pieces([pieces[i] for i in used]), strict=True):
            table[i] = ids
        if self.kept:
            table += starts
        flat = np.frombuffer(b"".join(table), self.dtype)
        sizes = np.fromiter(map(len, table), np.int32, len(table)) // self.dtype.itemsize
        del pieces, table
        begin = np.cumsum(sizes, dtype=np.int64) - sizes
        # An Arrow array of strings has fewer than 2 ** 31 bytes, and no more ids than bytes.
        each = sizes[place]
        after = np.zeros(len(place) + 1, np.int32)
        np.cumsum(each, out=after[1:])
        ids = np.empty(after[-1], self.dtype)
        for start in range(0, len(place), _PLACED):
            some = slice(start, start + _PLACED)
            low, high = after[start], after[min(start + _PLACED, len(place))]
            ids[low:high] = flat[np.repeat(begin[place[some]] - after[:-1][some], each[some]) + np.arange(low, high)]
        return ids, after[bounds].astype(np.int64)

    def _line(self, piece: str) -> bytes:
        return self.feed.join(map(self._head, piece.split("\n"))) if piece else b""
