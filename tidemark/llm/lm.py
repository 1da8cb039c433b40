"""Log-probabilities of texts by a weighted backoff automaton over word n-grams counted in the whole corpus.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end. With ``c`` the counts of training texts,
a token's probability in every context is smoothed towards that in the next shorter one,

    P(w | u v) = (c(u v w) + PRIOR * P(w | v)) / (c(u v) + PRIOR),    P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)),

which sums to one at each level. Every n-gram that may be a context is a state; a state has an arc for each token seen
after it, and a failure arc to the state of its longest proper suffix, weighted ``PRIOR / (c(u v) + PRIOR)``. A text
is scored in one traversal from left to right: take the arc of the token, or failure arcs until there is one, and go
on from the state that it leads to.

The automaton of a large corpus fits no task, so each block of texts gets the part that it can reach. Texts are dealt
into blocks of about ``BLOCK_BYTES``; a block counts its n-grams and asks for the distinct ones, packed and divided
into ranges of their 64-bit hashes; one task a range adds the blocks' training counts up and answers each block. So
a frequent word costs a block one entry, like a rare one, and no task sees more than its range or its block. All texts
are counted; nothing is pruned.

N-grams are told apart by 64-bit hashes: with ten million distinct ones two are taken for one with a chance near 3 in
a million. The order is 2 by default, because the distinct trigrams of a block are nearly as many as its tokens: order
3 doubles what is shuffled. ``order`` may be raised where that is affordable.

Defined cases: a null, empty or wordless text has only the end. Rows with a null id are scored, but have no fold
(held_out null) and are not learned from. Repeated rows are learned from and scored each. Without training texts every token
has probability one. Texts of any length are scored whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import fold
from tidemark.llm.text import Words, mix64, spans, utf8

ORDER, PRIOR, ADDED = 2, 4.0, 0.1
#: Text of one block, of one partition of blocks, and of the whole for each range of hashes.
BLOCK_BYTES, PARTITION_BYTES, RANGE_BYTES = 4 << 20, 32 << 20, 16 << 20
LEAST_BLOCKS = 64
HELD = 10

_BEGIN, _END = mix64(np.array([0x5EED, 0xE0D], np.uint64))
_CHAIN = np.uint64(0xD1342543DE82EF95)
_ASKED = "block int, part long, size int, total int, keys binary, counts binary"
_ANSWERED = "block int, part long, counts binary"


def sequences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the rows of a span, each row with a begin before and an end behind; and where rows begin."""
    words = Words(data, offsets)
    start = words.bound + 2 * np.arange(len(offsets))
    out = np.empty(int(start[-1]), np.uint64)
    out[start[:-1]] = _BEGIN
    out[start[1:] - 1] = _END
    hashes = words.hashes()
    out[np.arange(len(hashes)) + 2 * words.row + 1] = hashes
    return out, start


def grams(tokens: np.ndarray, start: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each size up to ``order`` the places where n-grams end, and their hashes; no n-gram is a lone begin."""
    place = np.arange(len(tokens)) - np.repeat(start[:-1], np.diff(start))
    found = [(np.flatnonzero(place > 0), tokens[place > 0])]
    value = tokens
    for size in range(2, order + 1):
        longer = value.copy()
        longer[1:] = mix64(value[:-1] * _CHAIN + tokens[1:] + np.uint64(size))
        value = longer
        at = np.flatnonzero(place >= size - 1)
        found.append((at, value[at]))
    return found


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes apart: the upper planes are zeros, which compress to nothing."""
    return np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def ranged(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of 64-bit values begins in sorted keys, and their end."""
    bounds = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


def _asked(tokens: np.ndarray, start: np.ndarray, learned: np.ndarray, block: int, parts: int, order: int) -> Iterator[dict]:
    """A row for each size and range: the distinct n-grams of a block, and their counts in its training texts."""
    row = np.repeat(np.arange(len(start) - 1), np.diff(start))
    for size, (at, value) in enumerate(grams(tokens, start, order), 1):
        keys, own = np.unique(value, return_inverse=True)
        counts = np.bincount(own, weights=learned[row[at]], minlength=len(keys)).astype("<u4")
        edges = ranged(keys, parts)
        for part in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[part], edges[part + 1]
            yield {"block": block, "part": (size - 1) * parts + part, "size": size, "total": b - a, "keys": packed(keys[a:b]), "counts": counts[a:b].tobytes()}


_ASKED_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int64()), ("size", pa.int32()), ("total", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _requests(parts: int, order: int):
    def run(table: pa.Table) -> pa.Table:
        data, offsets = utf8(_joined(table, "text"))
        learned = _joined(table, "held_out").fill_null(True).to_numpy(zero_copy_only=False) == False  # noqa: E712
        tokens, start = sequences(data, offsets)
        rows = list(_asked(tokens, start, learned, table.column("block")[0].as_py(), parts, order))
        return pa.Table.from_pylist(rows, schema=_ASKED_ARROW)

    return run


def _joined(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _added(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each row's keys; for all rows in turn, the place of a key among the distinct ones; and the sums of those."""
    keys = [unpacked(x) for x in table.column("keys").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()])
    distinct, own = np.unique(np.concatenate(keys), return_inverse=True)
    return keys, own, np.bincount(own, weights=counts, minlength=len(distinct)).astype(np.int64)


def _answers(table: pa.Table) -> pa.Table:
    """A range's sums, in the order of each block's keys."""
    keys, own, sums = _added(table)
    edges = np.cumsum([0, *map(len, keys)])
    out = [_small(sums[own[a:b]]) for a, b in zip(edges[:-1], edges[1:])]
    return pa.table({"block": table.column("block"), "part": table.column("part"), "counts": pa.array(out, pa.binary())})


def _small(counts: np.ndarray) -> bytes:
    """Counts in 4 bytes, byte planes apart, or in 8 if one of them needs it; a first byte tells which."""
    width = 4 if counts.max(initial=0) < 1 << 32 else 8
    return bytes([width]) + np.ascontiguousarray(counts.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def _counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel().astype(np.int64)


def _vocabulary(parts: int):
    """Distinct words and ends of spans of training texts, packed like a block's requests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in spans(offsets, BLOCK_BYTES):
                tokens, start = sequences(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                rows = list(_asked(tokens, start, np.ones(j - i, bool), 0, parts, 1))
                yield pa.RecordBatch.from_pylist(rows, schema=_ASKED_ARROW)

    return run


def _sizes(table: pa.Table) -> pa.Table:
    _, _, sums = _added(table)
    return pa.table({"tokens": pa.array([int(sums.sum())], pa.int64()), "words": pa.array([int((sums > 0).sum())], pa.int64())})


class Automaton:
    """States and arcs that the n-grams of one block can reach, and the weights of both in log10.

    ``counts`` holds for each size the counts of the block's distinct n-grams, in the order of their hashes; ``places``
    and ``grams`` tell at every token which n-gram of each size ends there (-1 for none, as at the begins).
    """

    def __init__(self, tokens: np.ndarray, start: np.ndarray, counts: list[np.ndarray], total: int, words: int, prior: float = PRIOR):
        order = len(counts)
        self.start = start
        self.gram: list[np.ndarray] = []
        for at, value in grams(tokens, start, order):
            own = np.full(len(tokens), -1, np.int64)
            own[at] = np.unique(value, return_inverse=True)[1]
            self.gram.append(own)
        self.counts = counts
        normal = total + ADDED * (words + 1)
        self.base = np.log10((counts[0] + ADDED) / normal)
        # A begin is a context as often as there are ends.
        ends = self.gram[0][start[1:] - 1]
        self.begins = int(counts[0][ends[0]]) if len(ends) else 0
        self.arc, self.fail = [self.base], [np.log10(prior / (counts[0] + prior))]
        weight = 10**self.base
        for size in range(2, order + 1):
            at, _ = grams(tokens, start, size)[size - 1]
            own = self.gram[size - 1][at]
            once = np.zeros(len(counts[size - 1]), np.int64)
            once[own] = at  # one place of each n-gram
            context = self.context(size - 1, once - 1)
            weight = (counts[size - 1] + prior * weight[self.gram[size - 2][once]]) / (context + prior)
            self.arc.append(np.log10(weight))
            self.fail.append(np.log10(prior / (counts[size - 1] + prior)))
        self.begin_fail = math.log10(prior / (self.begins + prior))

    def context(self, size: int, at: np.ndarray) -> np.ndarray:
        """How often the contexts of ``size`` tokens that end at places ``at`` were seen."""
        own = self.gram[size - 1][at]
        return np.where(own >= 0, self.counts[size - 1][own], self.begins)

    def scores(self) -> np.ndarray:
        """The log10 probability of each row, by one traversal."""
        order = len(self.counts)
        arc, fail = [x.tolist() for x in self.arc], [x.tolist() for x in self.fail]
        seen = [(x > 0).tolist() for x in self.counts]
        out = np.zeros(len(self.start) - 1)
        for row, (first, end) in enumerate(zip(self.start[:-1].tolist(), self.start[1:].tolist())):
            gram = [g[first:end].tolist() for g in self.gram]
            # A state is the number of tokens in its n-gram, which ends at the token before. The begin is one of size 1.
            size, total = int(order > 1 and self.begins > 0), 0.0
            for at in range(1, end - first):
                # The root has an arc for every token; failing a state goes on with its longest proper suffix.
                while size and not ((g := gram[size][at]) >= 0 and seen[size][g]):
                    last = gram[size - 1][at - 1]
                    total += fail[size - 1][last] if last >= 0 else self.begin_fail
                    size -= 1
                g = gram[size][at]
                total += arc[size][g]
                size = min(size + 1, order - 1)
                while size and not seen[size - 1][gram[size - 1][at]]:
                    size -= 1
            out[row] = total
        return out


_SCORED = "doc_id {id}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(total: int, words: int, order: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        data, offsets = utf8(_joined(docs, "text"))
        tokens, start = sequences(data, offsets)
        counts: list[list[np.ndarray]] = [[] for _ in range(order)]
        rows = sorted(zip(answers.column("part").to_pylist(), answers.column("size").to_pylist(), answers.column("counts").to_pylist()))
        for _, size, found in rows:
            counts[size - 1].append(_counts(found))
        own = Automaton(tokens, start, [np.concatenate([np.zeros(0, np.int64), *x]) for x in counts], total, words)
        row = np.repeat(np.arange(len(start) - 1), np.diff(start))
        at = own.gram[0] >= 0
        known = own.counts[0][own.gram[0][at]] > 0
        lines = len(start) - 1
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
            "n_tokens": pa.array(np.diff(start) - 1), "n_known": pa.array(np.bincount(row[at], weights=known, minlength=lines).astype(np.int64)),
            "train_tokens": pa.array(np.full(lines, total, np.int64)),
            "base_score": pa.array(np.bincount(row[at], weights=own.base[own.gram[0][at]], minlength=lines)),
            "score": pa.array(own.scores()),
        })

    return run


def score(docs: DataFrame, held_out: Column | None = None, order: int = ORDER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``."""
    spark = docs.sparkSession
    held_out = fold(F.col("doc_id"), HELD) == 0 if held_out is None else held_out
    shape = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    parts = max(8, -(-shape["bytes"] // RANGE_BYTES))
    blocks = max(1, min(shape["n"], max(LEAST_BLOCKS, -(-shape["bytes"] // BLOCK_BYTES))))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shape["bytes"] // PARTITION_BYTES))

    learned = docs.filter(~held_out).select("text").mapInArrow(_vocabulary(parts), _ASKED)
    sizes = learned.groupBy("part").applyInArrow(_sizes, "tokens long, words long")
    sizes = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()

    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    rows = docs.select("doc_id", held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"), block.alias("block")).repartition(tasks, "block")
    asked = rows.groupBy("block").applyInArrow(_requests(parts, order), _ASKED)
    answers = asked.groupBy("part").applyInArrow(_answers, _ANSWERED)
    answers = answers.withColumn("size", (F.expr(f"part div {parts}") + 1).cast("int")).repartition(tasks, "block")
    schema = _SCORED.format(id=docs.schema["doc_id"].dataType.simpleString())
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored(sizes["tokens"], sizes["words"], order), schema)
