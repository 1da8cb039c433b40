"""Byte-level BPE: texts to token ids and back, long texts in overlapping chunks.

A text of more than ``CHUNK + OVERLAP`` characters is cut into chunks that overlap by ``OVERLAP``. Every chunk is
pre-tokenised on its own, in parallel. Two tokenisations of the overlap that share one boundary agree from there on,
so neighbours are stitched at their first common boundary, each chunk encodes the stretch between its two stitches, and
a text's ids are the chunks' ids in order, hashed as they come. A text where some overlap has no common boundary (a run
of thousands of characters without one) is encoded again as a whole. The merges of a stretch are tiktoken's; decoding
concatenates the tokens' bytes.

Defined cases: a null or empty text has no ids and decodes to nothing. Rows are told apart by their place in the
input, so repeated rows and null ids get a row each. An empty table gives no rows. The id column is carried along;
others are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import groups

CHUNK, OVERLAP = 1 << 16, 1 << 12
#: The library's own pattern engine overflows on longer runs of white space.
_RUN = re.compile(r"\s{1000}")
COLUMNS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.texts = tiktoken.Encoding("texts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.single = tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        tokens = dict(zip(ranks.values(), ranks.keys()))
        table = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]
        self.size = np.array([len(t) for t in table], np.int64)
        self.first, self.bytes = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(table), np.uint8)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if _RUN.search(text):
            ids = [i for piece in self.pattern.findall(text) for i in self.single.encode_ordinary(piece)]
        else:
            ids = self.texts.encode_ordinary(text)
        return np.frombuffer(array("I", ids), np.uint32).astype("<u4", copy=False).tobytes()

    def decode(self, ids: bytes) -> bytes:
        found = np.frombuffer(ids, "<u4")
        if not len(found):
            return b""
        size = self.size[found]
        end = np.cumsum(size)
        return self.bytes[np.repeat(self.first[found] - (end - size), size) + np.arange(end[-1])].tobytes()

    def starts(self, text: str) -> np.ndarray:
        """Where pieces start."""
        sizes = list(map(len, self.pattern.findall(text)))
        return np.fromiter(accumulate(sizes, initial=0), np.int64, len(sizes) + 1)[:-1]


def _digests(codec: Codec, pieces: Iterator[bytes]) -> tuple[int, str, str]:
    """Count and hashes of ids that come in stretches. A character may be split between two tokens, not two stretches."""
    n, ids, back = 0, hashlib.sha256(), hashlib.sha256()
    for piece in pieces:
        n += len(piece) // 4
        ids.update(piece)
        back.update(codec.decode(piece))
    return n, ids.hexdigest(), back.hexdigest()


def _whole(shared, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                ids = [codec.encode(x or "") for x in part.column("text").to_pylist()]
                yield _out(part.column("doc_id"), [_digests(codec, iter([x])) for x in ids], ids if with_ids else None)

    return run


def _out(doc_id: pa.Array, found: list[tuple[int, str, str]], ids: list[bytes] | None) -> pa.RecordBatch:
    columns = [doc_id, pa.array([x[0] for x in found], pa.int64()), *(pa.array([x[k] for x in found], pa.string()) for k in (1, 2))]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.binary())] if ids is not None else []), names=names + ["ids"] * (ids is not None))


def _boundaries(pattern: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Boundaries in the overlaps before and behind; of the last piece only the start is certain, and of a first one nothing."""
        own = regex.compile(pattern)
        for batch in batches:
            head, tail = [], []
            for text in batch.column("text").to_pylist():
                sizes = list(map(len, own.findall(text)))
                starts = np.fromiter(accumulate(sizes, initial=0), np.int64, len(sizes) + 1)[:-1]
                head.append(starts[(starts > 0) & (starts < overlap)].astype("<i4").tobytes())
                tail.append((starts[starts > chunk] - chunk).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(head, pa.binary()), pa.array(tail, pa.binary())], names=[*batch.schema.names, "head", "tail"])

    return run


def stitch(tail: bytes | None, head: bytes | None) -> int | None:
    """The first boundary that the end of one chunk and the start of the next share; 0 before the first chunk."""
    both = np.intersect1d(np.frombuffer(tail, "<i4"), np.frombuffer(head, "<i4"))
    return int(both[0]) if len(both) else None


def _stretches(shared, pattern: str, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of each chunk's own stretch; a null where a neighbour does not fit. The chunk's own text goes along with a null only."""
        codec = Codec(shared.value, pattern)
        for batch in batches:
            rows = batch.to_pylist()
            ids = []
            for r in rows:
                a = 0 if r["before"] is None else stitch(r["before"], r["head"])
                b = len(r["text"]) if r["behind"] is None else stitch(r["tail"], r["behind"])
                ids.append(None if a is None or b is None else codec.encode(r["text"][a : b if r["behind"] is None else chunk + b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("chunk"), pa.array(ids, pa.binary()), pa.array([r["text"][: None if r["behind"] is None else chunk] for r in rows], pa.string())],
                names=["row", "doc_id", "chunk", "ids", "text"],
            )

    return run


def _joined(shared, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for table in groups(batches):
            ids = table.column("ids").to_pylist()
            if any(x is None for x in ids):
                ids = [codec.encode("".join(table.column("text").to_pylist()))]
            yield _out(table.column("doc_id")[:1].combine_chunks(), [_digests(codec, iter(ids))], [b"".join(ids)] if with_ids else None)

    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, with_ids: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row, and ``ids`` (packed, little-endian) if asked for.

    The vocabulary travels as a broadcast of fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {COLUMNS}" + ", ids binary" * with_ids
    long = F.length("text") > chunk + overlap
    short = docs.filter(~long).mapInArrow(_whole(shared, pattern, with_ids), schema)

    last = F.floor((F.length("text") - 1) / chunk)
    cut = F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: F.substring(F.col("text"), i * chunk + 1, F.lit(chunk + overlap)))
    chunks = docs.filter(long).withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", F.posexplode(cut).alias("chunk", "text"))
    # What is behind the last full chunk may be shorter than the overlap and then belongs to the chunk before.
    chunks = chunks.filter((F.col("chunk") == 0) | (F.length("text") > overlap))
    found = chunks.mapInArrow(_boundaries(pattern, chunk, overlap), f"row long, doc_id {kind}, chunk int, text string, head binary, tail binary")
    order = Window.partitionBy("row").orderBy("chunk")
    found = found.repartition("row").withColumn("before", F.lag("tail").over(order)).withColumn("behind", F.lead("head").over(order))
    parts = found.mapInArrow(_stretches(shared, pattern, chunk), f"row long, doc_id {kind}, chunk int, ids binary, text string")
    broken = F.max(F.col("ids").isNull()).over(Window.partitionBy("row"))
    parts = parts.withColumn("text", F.when(broken, F.col("text"))).repartition("row").sortWithinPartitions("row", "chunk")
    return short.unionByName(parts.mapInArrow(_joined(shared, pattern, with_ids), schema))
