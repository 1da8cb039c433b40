"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels come by document, the field needs them by token: in a sample of labelled documents (``PER_CLASS`` of each label,
of at most ``LONGEST`` characters) a token of a toxic document counts as toxic if its word or the start of it is far
more frequent in toxic documents than in others (log ratio of document shares of ``LIFT`` or more, in ``SUPPORT`` of
them at least); every token of another document is clean; toxic documents that this leaves unexplained are not used.
Words are letters, digits, ``_`` and marks of any script in lower case; other punctuation and symbols stand between them,
quotation marks and dashes beyond ASCII included.
The field has two tags. Emissions are sums of hashed features: the word, its beginnings and end, and the words beside
it. Training follows the gradient of the likelihood, whose marginals come from forward-backward.

With two tags, forward and backward messages are one ratio each, and a step is a Moebius map that contracts. So all
positions of many texts are updated at once, again and again, until nothing moves: that is exact, and needs no loop over
positions. Tokens with a marginal of ``TAGGED`` or more form the spans. A document's evidence is the sum of its tagged
marginals, or the largest marginal if none is tagged; a logistic curve, fitted to a fifth of the sample that training
has not seen and shifted to the labels' own odds, makes it a score.

Defined cases: a null, empty or wordless text has evidence 0 and no spans; without labels of both kinds every score is
0. Rows are independent: null ids (held_out null) and repeated rows get a row each. Other columns are not read. Texts
of any length are read whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import fold, labelled_documents
from tidemark.llm.quality import curve
from tidemark.llm.text import Words, lower, mix64, spans, utf8

PER_CLASS, LONGEST = 1200, 6_000
LIFT, SUPPORT = 2.5, 5
BITS = 17
EPOCHS, RATE, DECAY = 40, 0.4, 1e-5
TAGGED = 0.5
ACCEPT = 0.5
_SIZE = 1 << BITS


def _bytes(point: int) -> int:
    return 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)


#: ASCII bytes that are neither letters nor digits nor ``_`` stand between words.
_BETWEEN = np.array([i < 128 and not (chr(i).isalnum() or chr(i) == "_") for i in range(256)])


#: By code point, up to the symbols and emoji: what belongs to words, and the lower case where it has as many bytes.
_POINTS = 0x20000
_IN_WORD = np.array([(c := chr(i)).isalnum() or c in "_\u00ad\u200c\u200d" or unicodedata.category(c)[0] == "M" for i in range(_POINTS)])
_LOWERED = np.array([ord(x) if len(x := chr(i).lower()) == 1 and _bytes(ord(x)) == _bytes(i) else i for i in range(_POINTS)])


def folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes in lower case, with spaces for the bytes of punctuation and symbols beyond ASCII; places stay."""
    out = lower(data)
    for least, above, size in ((0xC2, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0xF8, 4)):
        at = np.flatnonzero((data >= least) & (data < above))
        if not len(at):
            continue
        point = (data[at] & (0x7F >> size)).astype(np.int64)
        for k in range(1, size):
            point = point << 6 | (data[at + k] & 0x3F)
        known = point < _POINTS  # ideographs lie above
        point, at = point[known], at[known]
        small, apart = _LOWERED[point], ~_IN_WORD[point]
        for k in range(size):
            shifted = small >> 6 * (size - 1 - k)
            byte = (shifted & 0x3F) | 0x80 if k else shifted | (0xF00 >> size & 0xFF)
            out[at + k] = np.where(apart, 0x20, byte).astype(np.uint8)
    return out


class Tokens:
    """Words of a span, as places of their features: the word, its first 4, 5 and 6 bytes, and its last 3.

    A word too short for one has place 0 there, which weighs nothing.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        small = folded(data)
        self.words = words = Words(small, offsets, _BETWEEN)
        n, size = len(words.start), words.end - words.start
        self.places = np.zeros((n, 5), np.int64)
        if not n:
            return
        padded = np.concatenate([small, np.zeros(8, np.uint8)])
        self.places[:, 0] = self._place(words.hashes(), 1)
        gram = np.zeros(n, np.uint64)
        for k in range(6):
            gram = gram * np.uint64(257) + padded[words.start + k] + np.uint64(1)
            if k > 2:
                self.places[:, k - 2] = np.where(size > k + 1, self._place(mix64(gram), 2), 0)
        tail = np.zeros(n, np.uint64)
        for k in (3, 2, 1):
            tail = tail * np.uint64(257) + np.where(size >= k, padded[words.end - np.minimum(size, k)], 0).astype(np.uint64)
        self.places[:, 4] = self._place(mix64(tail), 3)
        self.first = np.zeros(n, bool)
        self.first[0] = True
        self.first[1:] = words.row[1:] != words.row[:-1]
        self.last = np.concatenate([self.first[1:], [True]])

    @staticmethod
    def _place(hashes: np.ndarray, kind: int) -> np.ndarray:
        return np.maximum((mix64(hashes + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64), 1)

    @staticmethod
    def of(texts: list[str]) -> Tokens:
        raw = [t.encode() for t in texts]
        return Tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


@dataclass
class Field:
    """Weights of own and neighbouring words by place, transitions (from, to), and the curve of the score."""

    own: np.ndarray
    before: np.ndarray
    behind: np.ndarray
    moves: np.ndarray
    slope: float
    offset: float


def marginals(emission: np.ndarray, first: np.ndarray, last: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Probability of the toxic tag at each token, and the odds they come from: emission, forward, backward.

    ``first`` and ``last`` mark the ends of the texts, which lie one behind the other.
    """
    a, e = np.exp(moves), np.exp(np.clip(emission, -15, 15))
    ahead, behind = e.copy(), np.ones(len(e))
    for _ in range(10_000):
        old = np.concatenate([[1.0], ahead[:-1]])
        new = e * np.where(first, 1.0, (a[0, 1] + a[1, 1] * old) / (a[0, 0] + a[1, 0] * old))
        still = np.allclose(new, ahead, rtol=1e-9, atol=0)
        ahead = new
        if still:
            break
    for _ in range(10_000):
        old = np.concatenate([(e * behind)[1:], [1.0]])
        new = np.where(last, 1.0, (a[1, 0] + a[1, 1] * old) / (a[0, 0] + a[0, 1] * old))
        still = np.allclose(new, behind, rtol=1e-9, atol=0)
        behind = new
        if still:
            break
    odds = ahead * behind
    return odds / (1 + odds), e, ahead, behind


def weak_tags(tokens: Tokens, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A tag for every token, and which documents are explained by theirs."""
    row, places = tokens.words.row, tokens.places[:, :4]
    pairs = np.unique(np.repeat(row, 4) * _SIZE + places.ravel())
    counts = np.stack([np.bincount(pairs[labels[pairs // _SIZE] == y] % _SIZE, minlength=_SIZE) for y in (0, 1)])
    share = np.log((counts + 0.5) / (np.array([[(labels == 0).sum()], [(labels == 1).sum()]]) + 1))
    telling = (counts[1] >= SUPPORT) & (share[1] - share[0] >= LIFT)
    telling[0] = False
    tags = telling[places].any(axis=1) & (labels[row] == 1)
    return tags.astype(float), (labels == 0) | (np.bincount(row, tags, len(labels)) > 0)


def emissions(tokens: Tokens, own: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    out = own[tokens.places].sum(axis=1)
    inner, name = ~tokens.first[1:], tokens.places[:, 0]
    out[1:] += before[name[:-1]] * inner
    out[:-1] += behind[name[1:]] * inner
    return out


def train(texts: list[str], labels: list[int]) -> Field:
    y = np.array(labels, int)
    if len(set(y.tolist())) < 2:
        return Field(np.zeros(_SIZE), np.zeros(_SIZE), np.zeros(_SIZE), np.zeros((2, 2)), 0.0, -30.0)
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held].tolist())) < 2:
        held[:] = False
    own = [t for t, h in zip(texts, held) if not h]
    tags, explained = weak_tags(Tokens.of(own), y[~held])
    tokens = Tokens.of([t if ok else "" for t, ok in zip(own, explained)])
    tags = tags[np.isin(Tokens.of(own).words.row, np.flatnonzero(explained))]
    n, inner, name = len(tags), ~tokens.first[1:], tokens.places[:, 0]
    model = Field(np.zeros(_SIZE), np.zeros(_SIZE), np.zeros(_SIZE), np.zeros((2, 2)), 1.0, 0.0)
    model.own[1:] = -0.5
    sums = {k: np.full(np.shape(getattr(model, k)), 1e-6) for k in ("own", "before", "behind", "moves")}
    for _ in range(EPOCHS):
        p, e, ahead, behind = marginals(emissions(tokens, model.own, model.before, model.behind), tokens.first, tokens.last, model.moves)
        delta = p - tags
        a = np.exp(model.moves)
        pair = np.stack([np.full(n - 1, a[0, 0]), a[0, 1] * e[1:] * behind[1:], ahead[:-1] * a[1, 0], ahead[:-1] * a[1, 1] * e[1:] * behind[1:]])
        pair = (pair / pair.sum(axis=0) * inner).sum(axis=1)
        seen = np.bincount((2 * tags[:-1] + tags[1:]).astype(int), inner, 4)
        grads = {
            "own": np.bincount(tokens.places.ravel(), np.repeat(delta, 5), _SIZE),
            "before": np.bincount(name[:-1], delta[1:] * inner, _SIZE),
            "behind": np.bincount(name[1:], delta[:-1] * inner, _SIZE),
            "moves": (pair - seen).reshape(2, 2),
        }
        grads["own"][0] = 0
        for k, g in grads.items():
            weight = getattr(model, k)
            g = g + DECAY * n * weight * (g != 0)
            sums[k] += g * g
            weight -= RATE * (0.3 if k in ("before", "behind") else 1.0) * g / np.sqrt(sums[k])
        np.clip(model.moves, -3, 3, out=model.moves)
    check = held if held.any() else ~held
    x = np.array([evidence(p) for p in probabilities(model, Tokens.of([t for t, c in zip(texts, check) if c]))])
    model.slope, model.offset = curve(x, y[check])
    return model


def probabilities(field: Field, tokens: Tokens) -> list[np.ndarray]:
    """The marginals of the tokens of each document."""
    bound = tokens.words.bound
    if not bound[-1]:
        return [np.zeros(0)] * (len(bound) - 1)
    p = marginals(emissions(tokens, field.own, field.before, field.behind), tokens.first, tokens.last, field.moves)[0]
    return np.split(p, bound[1:-1])


def evidence(p: np.ndarray) -> float:
    tagged = p[p >= TAGGED]
    return float(np.log(0.01 + (tagged.sum() if len(tagged) else p.max(initial=0.0))))


def spans_of(tokens: Tokens, data: np.ndarray, offsets: np.ndarray, found: list[np.ndarray]) -> list[list[dict[str, int]]]:
    """For each document the character spans of runs of tagged tokens."""
    out: list[list[dict[str, int]]] = [[] for _ in found]
    if not any((p >= TAGGED).any() for p in found):
        return out
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    words = tokens.words
    for row, p in enumerate(found):
        base, at = words.bound[row], -2
        for k in np.flatnonzero(p >= TAGGED).tolist():
            end = int(chars[words.end[base + k]] - chars[offsets[row]])
            if k == at + 1:
                out[row][-1]["end"] = end
            else:
                out[row].append({"start": int(chars[words.start[base + k]] - chars[offsets[row]]), "end": end})
            at = k
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(**shared.value)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in spans(offsets):
                part, edge = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                tokens = Tokens(part, edge)
                found = probabilities(field, tokens)
                score = [1 / (1 + np.exp(-np.clip(field.slope * evidence(p) + field.offset, -30, 30))) for p in found]
                rows = batch.slice(i, j - i)
                where = pa.array(spans_of(tokens, part, edge, found), _SPANS)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), pa.array(score, pa.float64()), where], names=["doc_id", "held_out", "score", "spans"])

    return run


def fitted(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> Field:
    """A field from labelled documents; by default those whose fold is not held out."""
    learn = fold(F.col("doc_id"), 5) != 0 if learn is None else learn
    rows = labelled_documents(docs, labels, "toxic", learn, PER_CLASS, LONGEST).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"]))
    field = train([r["text"] for r in rows], [r["label"] for r in rows])
    if len({r["label"] for r in rows}) == 2:
        whole = {r[0]: r[1] for r in labels.filter(learn).groupBy(F.col("toxic").cast("int")).count().collect()}
        drawn = sum(r["label"] for r in rows)
        field.offset += float(np.log((whole[1] / whole[0]) / (drawn / (len(rows) - drawn))))
    return field


def score(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for every row; ``spans`` are character offsets of toxic passages."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(field))
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    out = rows.mapInArrow(_scores(shared), "doc_id long, held_out boolean, score double, spans array<struct<start:int,end:int>>")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"), "spans")


def _accepted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.RecordBatch.from_arrays([batch.column("_row").field("doc_id"), pa.nulls(batch.num_rows, pa.bool_()), batch.column("_row").field("text")], names=["doc_id", "held_out", "text"])
            found = pa.Table.from_batches(list(_scores(shared)(iter([rows])))).column("score").to_numpy()
            yield batch.filter(pa.array(found < ACCEPT))

    return run


def accepted(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` without the documents that score as toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(field))
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    return rows.mapInArrow(_accepted(shared), rows.schema).select("_row.*")
