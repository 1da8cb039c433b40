"""Language of a text by a bidirectional gated recurrent network over its UTF-8 bytes.

The network is trained in numpy by backpropagation through time on windows of a bounded sample of labelled
texts (``PER_CLASS`` rows of each language, stretches of at most ``LONGEST`` characters), and then labels every
byte of every text: texts are cut into consecutive stretches of ``STRETCH`` bytes, the state starts anew in
each, and the probabilities of all bytes of a text are averaged. Gates and candidates use the soft sign x / (1 + |x|) where the usual unit has tanh.

Defined cases: a null or letterless text is ``und`` with score 0. With nothing to learn from, every text is
``und``. Equal averages go to the language first in order. Rows are independent: null ids and repeated rows get
a row each, with held_out null for a null id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import fold
from tidemark.llm.text import spans, utf8

PER_CLASS, LONGEST = 400, 20_000
HIDDEN, STRETCH, ROWS = 6, 128, 4096
WINDOW, STEPS, BATCH, RATE = 64, 260, 256, 0.02
UNKNOWN = "und"


@dataclass
class Network:
    """Per direction: input table (256, 3H), recurrent weights (H, 3H); then output weights (2H, classes)."""

    classes: list[str]
    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(classes: list[str], seed: int = 3) -> Network:
        rng, h = np.random.default_rng(seed), HIDDEN
        shapes = {"xf": (256, 3 * h), "uf": (h, 3 * h), "xb": (256, 3 * h), "ub": (h, 3 * h), "out": (2 * h, len(classes)), "bias": (1, len(classes))}
        return Network(classes, {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in shapes.items()})


def _squash(x: np.ndarray) -> np.ndarray:
    """The soft sign, in place: a squashing function like tanh that costs a sixth of it."""
    x /= np.abs(x) + np.float32(1)
    return x


def _step(gate: np.ndarray, u: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """One gated update: new state, update gate, reset gate, candidate and the candidate's recurrent part."""
    h = HIDDEN
    back = state @ u
    both = _squash((gate[:, : 2 * h] + back[:, : 2 * h]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
    update, reset = both[:, :h], both[:, h:]
    fresh = _squash(gate[:, 2 * h :] + reset * back[:, 2 * h :])
    return fresh + update * (state - fresh), update, reset, fresh, back[:, 2 * h :]


def _run(net: Network, way: str, ids: np.ndarray, live: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States after each byte; ``ids`` and ``live`` are (time, rows). Dead places pass the state on."""
    table, u = net.weights["x" + way], net.weights["u" + way]
    times = range(len(ids)) if way == "f" else range(len(ids) - 1, -1, -1)
    out = np.empty((*ids.shape, HIDDEN), np.float32)
    state = np.zeros((ids.shape[1], HIDDEN), np.float32)
    whole = live.all(axis=1)
    for t in times:
        new, *rest = _step(table[ids[t]], u, state)
        if not whole[t]:
            new = np.where(live[t][:, None], new, state)
        if trace is not None:
            trace.append((t, state, *rest))
        state = out[t] = new
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def probabilities(net: Network, ids: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Summed over the live places of each row, (classes, rows). Features come first here, so that the steps run over
    whole rows of memory; a dead place only ever follows the live ones, so states need no care but at the start of
    the way back."""
    w, h, half = net.weights, HIDDEN, np.float32(0.5)
    scale = np.repeat([half, np.float32(1)], [2 * h, h]).astype(np.float32)[:, None]
    states = {}
    for way in "fb":
        table, u = np.ascontiguousarray(w["x" + way].T) * scale, np.ascontiguousarray(w["u" + way].T) * scale
        state = np.zeros((h, ids.shape[1]), np.float32)
        out = states[way] = np.empty((len(ids), h, ids.shape[1]), np.float32)
        for t in range(len(ids)) if way == "f" else range(len(ids) - 1, -1, -1):
            gate, back = table.take(ids[t], axis=1, mode="clip"), u @ state
            gate[: 2 * h] += back[: 2 * h]
            both = _squash(gate[: 2 * h])
            both *= half
            both += half
            back[2 * h :] *= both[h:]
            gate[2 * h :] += back[2 * h :]
            fresh = _squash(gate[2 * h :])
            state = state - fresh
            state *= both[:h]
            state += fresh
            if way == "b" and not live[t].all():
                state *= live[t]
            out[t] = state
    ahead, behind = np.ascontiguousarray(w["out"][:h].T), np.ascontiguousarray(w["out"][h:].T)
    total = np.zeros((len(net.classes), ids.shape[1]))
    for t in range(len(ids)):
        p = ahead @ states["f"][t]
        p += behind @ states["b"][t]
        p += w["bias"].T
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p *= live[t] / p.sum(axis=0)
        total += p
    return total


def gradients(net: Network, ids: np.ndarray, live: np.ndarray, wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy of the live places and its gradients, by backpropagation through time."""
    w, h, trace = net.weights, HIDDEN, {"f": [], "b": []}
    state = {way: _run(net, way, ids, live, trace[way]) for way in "fb"}
    p = _softmax(state["f"] @ w["out"][:h] + state["b"] @ w["out"][h:] + w["bias"])
    n = live.sum()
    loss = -float((np.log(p[:, np.arange(len(wanted)), wanted] + 1e-9) * live).sum() / n)
    p[:, np.arange(len(wanted)), wanted] -= 1
    p *= (live / n)[:, :, None].astype(np.float32)
    grad = {"bias": p.sum(axis=(0, 1))[None], "out": np.concatenate([np.einsum("tnh,tnk->hk", state[way], p) for way in "fb"])}
    for way, part in (("f", w["out"][:h]), ("b", w["out"][h:])):
        table, u = np.zeros_like(w["x" + way]), np.zeros_like(w["u" + way])
        later = np.zeros_like(state[way][0])
        for t, before, update, reset, fresh, back in reversed(trace[way]):
            total = later + p[t] @ part.T
            here = total * live[t][:, None]
            d_fresh = here * (1 - update) * (1 - np.abs(fresh)) ** 2
            slope = lambda gate: (1 - np.abs(2 * gate - 1)) ** 2 / 4
            d_gates = np.concatenate([here * (before - fresh) * slope(update), d_fresh * back * slope(reset)], axis=1)
            d_back = np.concatenate([d_gates, d_fresh * reset], axis=1)
            np.add.at(table, ids[t], np.concatenate([d_gates, d_fresh], axis=1))
            u += before.T @ d_back
            later = here * update + d_back @ w["u" + way].T + total * ~live[t][:, None]
        grad["x" + way], grad["u" + way] = table, u
    return loss, grad


def train(texts: list[str], languages: list[str], seed: int = 3) -> Network:
    """A network for the given languages, by Adam on windows drawn evenly over languages, texts and places."""
    net = Network.fresh(sorted(set(languages)), seed)
    rng = np.random.default_rng(seed)
    pools = [[t.encode() for t, x in zip(texts, languages) if x == c and t] for c in net.classes]
    if not net.classes or not all(pools):
        return net
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for step in range(1, STEPS + 1):
        wanted = rng.integers(len(net.classes), size=BATCH)
        ids, live = np.zeros((BATCH, WINDOW), np.uint8), np.zeros((BATCH, WINDOW), bool)
        for i, c in enumerate(wanted):
            text = pools[c][rng.integers(len(pools[c]))]
            at = rng.integers(max(1, len(text) - WINDOW + 1))
            piece = np.frombuffer(text[at : at + WINDOW], np.uint8)
            ids[i, : len(piece)], live[i, : len(piece)] = piece, True
        _, grad = gradients(net, np.ascontiguousarray(ids.T), np.ascontiguousarray(live.T), wanted)
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in grad.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
            net.weights[k] = (net.weights[k] - rate * move).astype(np.float32)
    return net


def predict(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities of each row of a span; rows without bytes get zeros."""
    size = np.diff(offsets)
    pieces = -(-size // STRETCH)
    row = np.repeat(np.arange(len(size)), pieces)
    start = offsets[row] + STRETCH * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    out = np.zeros((len(size), len(net.classes)))
    padded = np.concatenate([data, np.zeros(STRETCH, np.uint8)])
    for a in range(0, len(row), ROWS):
        at = start[a : a + ROWS] + np.arange(STRETCH)[:, None]
        live = at < offsets[row[a : a + ROWS] + 1]
        np.add.at(out, row[a : a + ROWS], probabilities(net, padded[at], live).T)
    return out / np.maximum(size, 1)[:, None]


def _predictions(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            data, offsets = utf8(column)
            for i, j in spans(offsets):
                letters = np.array([any(map(str.isalpha, x or "")) for x in column.slice(i, j - i).to_pylist()], bool)
                if net.classes:
                    mean = predict(net, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                    best = mean.argmax(axis=1)
                    names, score = [net.classes[k] if ok else UNKNOWN for k, ok in zip(best, letters)], np.where(letters, mean.max(axis=1), 0.0)
                else:
                    names, score = [UNKNOWN] * (j - i), np.zeros(j - i)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1), pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def sample(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, text`` to learn from: ``PER_CLASS`` different rows of every language, or all if it has fewer.

    Rows are drawn by a hash of id and text; a text longer than ``LONGEST`` gives a stretch of that length, from a place
    that its hash tells. Languages are counted first, so that few rows are sorted.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    counts = rows.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_n"))  # a row for each language
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1 << 62))
    rows = rows.select("doc_id", "lang", "text", draw.alias("_draw")).join(F.broadcast(counts), F.col("lang") == F.col("_lang"))
    rows = rows.filter(F.col("_draw") < F.lit(float(1 << 62)) * 2 * PER_CLASS / F.col("_n"))
    start = F.pmod("_draw", F.greatest(F.length("text") - LONGEST, F.lit(0)) + 1) + 1
    rows = rows.select("doc_id", "lang", "_draw", F.substring("text", start.cast("int"), F.lit(LONGEST)).alias("text")).dropDuplicates(["lang", "_draw"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_draw"))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= PER_CLASS).select("doc_id", "lang", "text")


def fitted(docs: DataFrame) -> Network:
    """A network from the rows with a language whose fold is not held out."""
    found = sorted(sample(docs).collect(), key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in found], [r["lang"] for r in found])


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row."""
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(_predictions(net), "doc_id long, held_out boolean, lang_pred string, score double")
