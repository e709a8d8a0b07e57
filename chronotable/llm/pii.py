"""Personal data: fixed patterns, and a skip-chain conditional random field that carries their labels on.

``base_spans`` finds e-mail addresses, IP addresses, card and phone numbers by the patterns; those spans always
stay. The field then looks at the tokens (runs of visible characters) that hold a digit or an at sign; all
others are O by definition, so the graph of a text has only clue tokens as nodes, and what a plain neighbour
contributes is a constant. Edges join neighbouring clue tokens (the chain) and tokens that say the same or
nearly the same (the skips). Strong skips join the same name before an at sign, the same seven digits or more, also as the end of
a whole phone or card number, and the same first three parts of an address; weak ones the same four to six digits or the same
mixed word. Each occurrence is joined to the next one, so a token that recurs a thousand times costs a thousand edges. Tokens inside base spans are
observed; loopy sum-product message passing finds the beliefs of the rest, and tokens that are ``certain`` to be
personal data become further spans, unless they touch a base span.

Training is distant supervision with hidden mentions. In a sample every base span is mentioned once more in a shortened form
that no pattern finds: in its own text, as a hidden token of its kind that a skip joins to it, and in another
text, as a hidden token that is O. So the form alone tells nothing and the skips must. Other tokens are O if no strong skip joins them to a base span;
those that one does join have no label. The weights maximise the pseudo-likelihood of the hidden tokens. Sampling: at most ``most``
documents with clues, in the order of a hash of the id, and of those the ones whose clues take no more than ``_MOST_CLUES`` bytes; only clue tokens are gathered, never texts.

Offsets count code points, ends are exclusive. All passes over a text are linear in its length.

Nulls: a null text is empty and has no spans; a null ``doc_id`` stays. Rows may repeat. An empty table gives no
rows; without a span to learn from no spans are added. Other columns are not read by ``find_personal_data`` and
kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, first_by_hash, give_back, in_groups, texts
from chronotable.sources.workspace import materialize

KINDS = ("email", "ip", "card", "phone")
_LABELS = len(KINDS) + 1  # 0 is O

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of these can only begin where a run of digits begins.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CLUE = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_NOT_WORD = re.compile(r"[^0-9a-z]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)  # fixed: a doubled digit's sum of digits

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    numbers = list(map(int, reversed(digits)))
    return (sum(numbers[::2]) + sum(_DOUBLED[d] for d in numbers[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
        # Neither a name nor the search for the next one reaches back over this at sign.
        done = match.end() if match else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, leftmost and not overlapping within a kind, by kind and then start."""
    spans: list[Span] = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    if "." in text:
        spans += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m.group().split("."))]
    for match in _CARD.finditer(text):
        if 13 <= match.end() - match.start():
            digits = match.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *match.span()))
    if "+" in text:
        spans += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return spans


class Tokens(NamedTuple):
    """Clue tokens of one text."""

    starts: list[int]
    ends: list[int]
    words: list[str]
    before: list[int]  # position among the clues of a neighbour on the left, -1 for a plain one, -2 at the text's start
    last: list[bool]  # at the text's end


def clue_tokens(text: str) -> Tokens:
    tokens = Tokens([], [], [], [], [])
    if not _CLUE.search(text):
        return tokens
    previous, match = -2, None
    for match in _TOKEN.finditer(text):
        word = match.group()
        if _CLUE.search(word):
            tokens.starts.append(match.start())
            tokens.ends.append(match.end())
            tokens.words.append(word)
            tokens.before.append(previous)
            tokens.last.append(False)
            previous = len(tokens.words) - 1
        else:
            previous = -1
    if previous >= 0:
        tokens.last[-1] = True
    return tokens


def _features(word: str) -> list[float]:
    digits = sum("0" <= c <= "9" for c in word)
    letters = sum(c.isalpha() for c in word)
    at = word.count("@")
    tail = word[word.find("@") + 1 :]
    core = word.strip(".,;:!?\"'")
    return [
        1.0,
        float(at == 1 and bool(word[: word.find("@")])),
        float(at == 1 and "." in tail.strip(".,")),
        float(digits == 1),
        float(2 <= digits <= 3),
        float(4 <= digits <= 8),
        float(9 <= digits <= 12),
        float(13 <= digits <= 19),
        float(digits > 19),
        float(letters > 0),
        float(letters > 0 and at == 0),
        float(core.isdigit()),
        float(core.count(".") == 3 and letters == 0),
        float(0 < core.count(".") < 3),
        float(word[0] == "+"),
        float("-" in core),
        float(word[0] == "(" and ")" in word),
        float("=" in word or '"' in word or "_" in word),
    ]


_WIDTH = len(_features("0"))


_STRONG, _WEAK = 0, 1
_SKIPS = 2


def _skip_keys(word: str) -> list[tuple[str, int]]:
    """Tokens that share a key are joined, by an edge of that kind."""
    core = word.strip(".,;:!?\"'()[]<>")
    plain = _NOT_WORD.sub("", core.lower())
    if "@" in core:
        name, _, domain = core.lower().partition("@")
        name = name or domain
        return [(f"n{name}", _STRONG)] if len(name) >= 4 else []
    digits = _NOT_DIGIT.sub("", core)
    if any(c.isalpha() for c in core):
        return [(f"w{plain}", _STRONG if len(digits) >= 7 else _WEAK)] if len(plain) >= 4 else []
    keys = []
    if len(digits) >= 4:
        keys.append((f"d{digits}", _STRONG if len(digits) >= 7 else _WEAK))
    parts = core.split(".")
    if len(parts) >= 3 and all(0 < len(p) <= 3 and p.isascii() and p.isdigit() for p in parts[:3]):
        keys.append((f"p{'.'.join(parts[:3])}", _STRONG))
    return keys


def _span_keys(kind: int, text: str) -> list[str]:
    """Strong keys of a base span as a whole."""
    if kind == 0:
        name = text.lower().partition("@")[0]
        return [f"n{name}"] if len(name) >= 4 else []
    if kind == 1:
        return [f"p{'.'.join(text.split('.')[:3])}"]
    digits = _NOT_DIGIT.sub("", text)
    return [f"d{digits[-n:]}" for n in range(7, len(digits) + 1)]


def _hidden_form(kind: int, text: str) -> str:
    """A mention of a base span that the patterns do not find."""
    if kind == 0:
        name, _, domain = text.partition("@")
        return f"{name}@{domain.partition('.')[0]}"
    if kind == 1:
        return ".".join(text.split(".")[:3])
    digits = _NOT_DIGIT.sub("", text)
    return f"{digits[-7:-4]}-{digits[-4:]}" if kind == 3 else ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))


class Graph:
    """Clue tokens of many texts side by side."""

    def __init__(self) -> None:
        self.features: list[list[float]] = []
        self.observed: list[int] = []  # -1 where no base span covers the token
        self.open_left: list[bool] = []  # a plain token stands on that side
        self.open_right: list[bool] = []
        self.chain: list[tuple[int, int]] = []
        self.skips: list[tuple[int, int]] = []
        self.skip_kinds: list[int] = []
        self.hidden: list[tuple[int, int]] = []  # planted tokens and their labels
        self.spans: list[tuple[int, int, str]] = []  # last token, kind and text of base spans

    def add(self, tokens: Tokens, spans: list[Span]) -> int:
        """Adds a text; returns the place of its first token."""
        first = len(self.features)
        ordered = sorted((s, e, k) for k, s, e in spans)
        at, seen = 0, {}
        count = len(tokens.words)
        for i, word in enumerate(tokens.words):
            self.features.append(_features(word))
            while at < len(ordered) and ordered[at][1] <= tokens.starts[i]:
                at += 1
            inside = at < len(ordered) and ordered[at][0] < tokens.ends[i]
            self.observed.append(ordered[at][2] + 1 if inside else -1)
            before = tokens.before[i]
            if before >= 0:
                self.chain.append((first + before, first + i))
            self.open_left.append(before == -1)
            self.open_right.append(not tokens.last[i] and not (i + 1 < count and tokens.before[i + 1] == i))
            keys = _skip_keys(word)
            if inside and ordered[at][1] <= tokens.ends[i]:  # the last token of a span stands for all of it
                start, end, kind = ordered[at]
                whole = _covered(tokens, i, start, end)
                self.spans.append((first + i, kind, whole))
                keys += [(key, _STRONG) for key in _span_keys(kind, whole)]
            joined = set()
            for key, kind in sorted(set(keys), key=lambda pair: pair[1]):
                if key in seen and seen[key] not in joined:
                    joined.add(seen[key])
                    self.skips.append((first + seen[key], first + i))
                    self.skip_kinds.append(kind)
                seen[key] = i
        return first

    def plant(self, word: str, label: int, partner: int | None) -> None:
        """A hidden token between plain ones, joined to ``partner`` by a strong skip."""
        self.hidden.append((len(self.features), label))
        if partner is not None:
            self.skips.append((partner, len(self.features)))
            self.skip_kinds.append(_STRONG)
        self.features.append(_features(word))
        self.observed.append(-1)
        self.open_left.append(True)
        self.open_right.append(True)

    def plant_mentions(self) -> None:
        """Each base span once more, shortened, beside itself and where it has no partner."""
        for partner, kind, text in self.spans:
            form = _hidden_form(kind, text)
            self.plant(form, kind + 1, partner)
            self.plant(form, 0, None)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        features = np.array(self.features, np.float64).reshape(-1, _WIDTH)
        pairs = (np.array(edges, np.int64).reshape(-1, 2) for edges in (self.chain, self.skips))
        return features, np.array(self.observed, np.int64), *pairs, np.array(self.skip_kinds, np.int64)


def _covered(tokens: Tokens, last: int, start: int, end: int) -> str:
    """The text of a span that ends in a token, as far as clue tokens hold it."""
    parts = []
    i = last
    while i >= 0 and tokens.ends[i] > start:
        parts.append(tokens.words[i][max(0, start - tokens.starts[i]) : max(0, end - tokens.starts[i])])
        i -= 1
    return " ".join(reversed(parts))


class Weights(NamedTuple):
    unary: np.ndarray
    chain: np.ndarray  # by left and right label
    skip: np.ndarray  # by kind of skip; symmetric


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def train(graph: Graph, steps: int = 400, rate: float = 0.1, decay: float = 2e-5) -> Weights:
    """Pseudo-likelihood of the hidden tokens, by Adam over the whole sample; planted ones weigh as much as all others."""
    features, observed, chain, skips, kinds = graph.arrays()
    n = len(features)
    labels = np.where(observed < 0, 0, observed)
    planted = np.zeros(n, bool)
    for place, label in graph.hidden:
        labels[place], planted[place] = label, True
    known = observed >= 0
    # What a strong skip joins to a base span may be anything.
    strong = skips[kinds == _STRONG]
    unclear = np.zeros(n, bool)
    for a, b in (strong.T, strong.T[::-1]):
        unclear[a[known[b]]] = True
    unclear &= ~known & ~planted
    weight = (~known & ~unclear & ~planted).astype(float)
    weight[planted] = max(weight.sum(), 1.0) / max(planted.sum(), 1)
    weight /= max(weight.sum(), 1.0)
    hot = np.eye(_LABELS)[labels]
    hot[unclear] = 0
    left, right = (np.zeros((n, _LABELS)) for _ in range(2))
    left[chain[:, 1]] = hot[chain[:, 0]]
    right[chain[:, 0]] = hot[chain[:, 1]]
    left[np.array(graph.open_left, bool), 0] = 1
    right[np.array(graph.open_right, bool), 0] = 1
    beside = np.zeros((_SKIPS, n, _LABELS))
    np.add.at(beside, (kinds, skips[:, 1]), hot[skips[:, 0]])
    np.add.at(beside, (kinds, skips[:, 0]), hot[skips[:, 1]])
    shapes = [(_WIDTH, _LABELS), (_LABELS, _LABELS), (_SKIPS, _LABELS, _LABELS)]
    values = [np.zeros(s) for s in shapes]
    means, squares = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for step in range(1, steps + 1):
        unary, pair, skip = values
        off = _softmax(features @ unary + left @ pair + right @ pair.T + np.einsum("knl,klm->nm", beside, skip)) - np.eye(_LABELS)[labels]
        off *= weight[:, None]
        by_skip = np.einsum("knl,nm->klm", beside, off)
        gradients = [features.T @ off, left.T @ off + (right.T @ off).T, (by_skip + by_skip.transpose(0, 2, 1)) / 2]
        for value, mean, square, gradient in zip(values, means, squares, gradients, strict=True):
            gradient = gradient + decay * value
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return Weights(*values)


def beliefs(graph: Graph, weights: Weights, rounds: int = 30, damping: float = 0.3, enough: float = 1e-4) -> np.ndarray:
    """Marginals of all tokens by damped loopy message passing over all texts at once."""
    features, observed, chain, skips, kinds = graph.arrays()
    unary = features @ weights.unary
    unary[np.array(graph.open_left, bool)] += weights.chain[0]
    unary[np.array(graph.open_right, bool)] += weights.chain[:, 0]
    known = observed >= 0
    unary[known] = -1e4
    unary[known, observed[known]] = 0
    edges = np.concatenate([chain, skips])
    if not len(edges):
        return _softmax(unary)
    m = len(edges)
    potentials = np.concatenate([np.repeat(weights.chain[None], len(chain), 0), weights.skip[kinds]])
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    potentials = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    messages = np.zeros((2 * m, _LABELS))
    for _ in range(rounds):
        total = unary + np.stack([np.bincount(target, messages[:, y], len(unary)) for y in range(_LABELS)], axis=1)
        inner = (total[source] - messages[back])[:, :, None] + potentials
        peak = inner.max(axis=1, keepdims=True)
        fresh = (np.log(np.exp(inner - peak).sum(axis=1, keepdims=True)) + peak)[:, 0]
        fresh -= fresh.max(axis=1, keepdims=True)
        fresh = damping * messages + (1 - damping) * fresh
        moved = np.abs(fresh - messages).max()
        messages = fresh
        if moved < enough:
            break
    total = unary + np.stack([np.bincount(target, messages[:, y], len(unary)) for y in range(_LABELS)], axis=1)
    return _softmax(total)


def _added(tokens: Tokens, spans: list[Span], marginals: np.ndarray, observed: list[int], certain: float) -> list[Span]:
    """Spans of the unobserved tokens that are certain enough; neighbours of one label make one span."""
    out: list[Span] = []
    joined_to = -1
    for i, word in enumerate(tokens.words):
        label = int(marginals[i].argmax())
        if observed[i] >= 0 or label == 0 or marginals[i, label] < certain:
            continue
        start = tokens.starts[i] + len(word) - len(word.lstrip("\"'<[,;:"))
        end = tokens.ends[i] - (len(word) - len(word.rstrip(".,;:!?\"'>]")))
        if start >= end or any(s < end and start < e for _, s, e in spans):
            continue
        if out and joined_to >= 0 and tokens.before[i] == joined_to and out[-1][0] == label - 1:
            out[-1] = (label - 1, out[-1][1], end)
        else:
            out.append((label - 1, start, end))
        joined_to = i
    return out


class Finder:
    """Base and all spans of many texts at a time."""

    def __init__(self, weights: Weights | None, certain: float = 0.95):
        self.weights, self.certain = weights, certain

    def find(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        graph, found = Graph(), []
        for text in texts:
            base = base_spans(text)
            tokens = clue_tokens(text)
            found.append((base, tokens, graph.add(tokens, base)))
        if self.weights is None or not graph.features:
            return [(base, base) for base, _, _ in found]
        marginals = beliefs(graph, self.weights)
        out = []
        for base, tokens, first in found:
            here = slice(first, first + len(tokens.words))
            more = _added(tokens, base, marginals[here], graph.observed[here], self.certain)
            out.append((base, sorted(base + more)))
        return out


_MOST_CLUES = 20_000  # bytes
_CLUES = pa.schema([("doc_id", pa.int64()), ("clues", pa.string())])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clue tokens and base spans of texts, in place of the texts."""
    for batch in batches:
        ids, out = [], []
        for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
            text = value.as_py()
            clues = json.dumps([clue_tokens(text), base_spans(text)])
            if len(clues) <= _MOST_CLUES:
                ids.append(doc_id.as_py())
                out.append(clues)
        yield batch_of(_CLUES, (ids, out))


def train_personal_data(documents: DataFrame, most: int = 4_000) -> Weights | None:
    """Weights of the field from the base spans of a bounded sample; None if there is no clue to learn from."""
    clues = texts(documents).where(F.col("text").rlike("[0-9@]") & F.col("doc_id").isNotNull())
    ids = materialize(clues.select(F.col("doc_id").cast("long")).distinct())
    chosen = materialize(first_by_hash(ids, most))
    sample = clues.withColumn("doc_id", F.col("doc_id").cast("long")).join(F.broadcast(chosen), "doc_id")  # at most `most` ids
    gathered = sample.select("doc_id", "text").mapInArrow(_gather, "doc_id long, clues string")
    # Ids that repeat bring more rows.
    bounded = gathered.orderBy(F.xxhash64("doc_id", "clues"), "doc_id", "clues").limit(most)
    trained = bounded.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_fit, "part int, value array<double>").collect()
    if not trained:
        return None
    parts = {row.part: np.array(row.value) for row in trained}
    return Weights(parts[0].reshape(_WIDTH, _LABELS), parts[1].reshape(_LABELS, _LABELS), parts[2].reshape(_SKIPS, _LABELS, _LABELS))


def _fit(sample: pa.Table) -> pa.Table:
    graph = Graph()
    for clues in sorted(sample.column("clues").to_pylist()):
        tokens, spans = json.loads(clues)
        graph.add(Tokens(*tokens), [tuple(span) for span in spans])
    graph.plant_mentions()
    weights = train(graph)
    return pa.table({"part": pa.array(range(3), pa.int32()), "value": pa.array([w.ravel() for w in weights], pa.list_(pa.float64()))})


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


_FOUND = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])


def _finding(weights: Weights | None) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(weights)
        for batch in batches:
            out = [found for group in in_groups(batch.column(1), 4_000_000) for found in finder.find(group)]
            counts = [[sum(k == kind for k, _, _ in base) for base, _ in out] for kind in range(len(KINDS))]
            digests = [hashlib.sha256(_written(base).encode()).hexdigest() for base, _ in out]
            yield batch_of(_FOUND, (batch.column(0), *counts, digests, [_written(every) for _, every in out]))

    return find


def find_personal_data(documents: DataFrame, weights: Weights | None) -> DataFrame:
    """Numbers of base spans by kind, their digest, and all spans, of every whole text."""
    rows = texts(documents).select(F.col("doc_id").cast("long"), "text")
    columns = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_finding(weights), f"doc_id long, {columns}, base_sha256 string, spans string")


def _masked(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(documents: DataFrame, weights: Weights | None, column: str = "text") -> DataFrame:
    """The same rows with every span replaced by its kind in angle brackets; a null text stays null."""
    place = documents.columns.index(column)

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(weights)
        for batch in batches:
            out: list[str | None] = []
            for group in in_groups(batch.column(place)):
                out += [_masked(t, every) if every else t for t, (_, every) in zip(group, finder.find(group), strict=True)]
            known = batch.column(place).is_valid()
            texts_out = pc.if_else(known, pa.array(out, batch.schema.field(place).type), pa.scalar(None, batch.schema.field(place).type))
            yield batch.set_column(place, batch.schema.field(place), texts_out)
            del out, texts_out
        give_back()

    return documents.mapInArrow(masked, documents.schema)
