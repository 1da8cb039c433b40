"""Quality of a text by naive Bayes support vectors over n-gram indicators.

Indicators of byte trigrams (as written), of words (A-Z lower-cased) and of shares of words said twice in a row are
hashed into ``BUCKETS`` places. Each indicator is scaled by the logarithm of the ratio of its smoothed counts in the two
classes, texts are brought to length one, and a linear hinge-loss model is fitted by dual coordinate descent on a
bounded sample (``PER_CLASS`` documents of each label, of at most ``LONGEST`` characters). A logistic curve fitted
to margins of a fifth of the sample, which the model has not seen, and shifted to the labels' own odds, turns margins
into scores from 0 to 1.

Defined cases: a null or empty text has no indicators and gets the model's bias; without labels of both kinds every
score is 0.5. Rows are independent: null ids (held_out null) and repeated rows get a row each. Other columns are not
read. Texts of any length are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import fold, labelled_documents
from tidemark.llm.text import Words, spans, utf8

PER_CLASS, LONGEST = 1500, 20_000
TRIGRAM_BITS = WORD_BITS = 17
BUCKETS = (1 << TRIGRAM_BITS) + (1 << WORD_BITS)
REPEATS = (0.0, 0.02, 0.1, 0.3)
SMOOTHING, COST, EPOCHS = 1.0, 1.0, 20
ACCEPT = 0.7


def indicators(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each row of a span the sorted places of its indicators."""
    words = Words(data, offsets)
    hashes = words.hashes()
    place = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])
    place = np.maximum(place, len(REPEATS)) + (1 << TRIGRAM_BITS)
    wide = data.astype(np.uint32)
    gram = np.zeros(len(data), np.int64)
    if len(data) > 2:
        gram[:-2] = (((wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(32 - TRIGRAM_BITS)
    seen = np.zeros(BUCKETS, bool)
    for row in range(len(offsets) - 1):
        a, b = words.bound[row], words.bound[row + 1]
        seen[gram[offsets[row] : max(offsets[row], offsets[row + 1] - 2)]] = True
        seen[place[a:b]] = True
        for k, share in enumerate(REPEATS):
            seen[(1 << TRIGRAM_BITS) + k] = same[a:b].sum() > share * (b - a)
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


@dataclass
class Model:
    """Ratios by place, weights times ratios, bias of the margin, and the curve's slope and offset."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        size = float(np.sqrt((self.ratio[found] ** 2).sum()))
        return self.bias + (float(self.weight[found].sum()) / size if size else 0.0)

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.offset, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    count = np.full((2, BUCKETS), SMOOTHING)
    for found, y in zip(rows, labels):
        count[int(y), found] += 1
    count /= count.sum(axis=1, keepdims=True)
    return np.log(count[1] / count[0])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge loss with an L2 penalty; the bias is a last indicator that is always on."""
    w, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(y))
    square = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(y)):
            slope = y[i] * (float(w[rows[i]] @ values[i]) + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), COST)
            if (step := (new - alpha[i]) * y[i]) != 0:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def curve(margins: np.ndarray, labels: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with smoothed targets."""
    n1 = labels.sum()
    n0 = len(labels) - n1
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (target - p) - 1e-3 * beta
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def train(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Rows are sorted places; labels 0 or 1."""
    labels = np.asarray(labels, int)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, 0.0)
    held = np.arange(len(rows)) % 5 == 4
    if len(set(labels[held].tolist())) < 2:
        held = np.zeros(len(rows), bool)
    own = [r for r, h in zip(rows, held) if not h]
    ratio = log_count_ratios(own, labels[~held])
    values = [ratio[r] / max(1e-9, float(np.sqrt((ratio[r] ** 2).sum()))) for r in own]
    w, bias = dual_coordinate_descent(own, values, 2 * labels[~held] - 1)
    model = Model(ratio, w * ratio, bias, 1.0, 0.0)
    check = held if held.any() else ~held
    margins = np.array([model.margin(r) for r, c in zip(rows, check) if c])
    model.slope, model.offset = curve(margins, labels[check])
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for i, j in spans(offsets):
            found = [x.astype(np.uint32).tobytes() for x in indicators(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])]
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(found, pa.binary())], names=["doc_id", "label", "found"])


def fitted(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> Model:
    """A model from labelled documents; by default those whose fold is not held out."""
    learn = fold(F.col("doc_id"), 4) != 2 if learn is None else learn
    sample = labelled_documents(docs, labels, "quality", learn, PER_CLASS, LONGEST)
    rows = sample.mapInArrow(_features, "doc_id long, label int, found binary").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], bytes(r["found"])))
    own = np.array([r["label"] for r in rows], int)
    model = train([np.frombuffer(bytes(r["found"]), np.uint32).astype(np.int64) for r in rows], own)
    if len(set(own.tolist())) == 2:
        whole = {r[0]: r[1] for r in labels.filter(learn).groupBy(F.col("quality").cast("int")).count().collect()}
        model.offset += float(np.log((whole[1] / whole[0]) / (own.sum() / (1 - own).sum())))
    return model


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**model.value)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in spans(offsets):
                found = [own.score(x) for x in indicators(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(found, pa.float64())], names=["doc_id", "held_out", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row. The model travels as a broadcast of fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    out = rows.mapInArrow(_scores(shared), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
