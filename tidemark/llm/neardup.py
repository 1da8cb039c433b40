"""Near duplicates by an LSH forest of MinHash signatures, confirmed on full shingle sets.

A document's set holds its distinct 5-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; with
fewer words the whole sequence is the one shingle; without words the set is empty and links with nothing).
Equal sets are folded into one node first, so thousands of copies cost one row.

The forest keeps every node's signature in ``TREES`` orders. Each order is range-partitioned and sorted, so a
subtree of any size is spread over tasks. Nodes with a common prefix of ``DEPTH`` values form a region; in a
region that fits a window every pair is a candidate, in a larger one a node meets the ``WINDOW`` nodes before
and behind it in signature order, which are those with the longest common prefixes: the depth adapts to the
region. A 128-bit sketch drops candidates far below the threshold, and the remaining clusters are compared
exactly, all pairs at once, on full sets read again from the texts. Only a star of confirmed links per cluster
leaves the task. A few trees go first; the others then only have to join what is still apart.

The windows of a larger region do not see all its pairs. All nodes of such regions are joined once more, without
a cap: shingles are ordered from rare to common, and two sets can only reach the threshold if the first
``n - overlap + 1`` of each have one in common, where ``overlap`` is what their sizes ask for. Text that a crowd
shares stands last in that order, so the join meets it only where the crowd is similar up to the threshold.

Defined cases: a null or word-less text has n_shingles 0, its own doc_id as component_id and is kept. A null
doc_id takes part in links; its component_id is the smallest id reachable, or null, and kept is false unless
there is none. Repeated rows are all returned. Ties cannot occur: the smallest id wins. An empty table gives no
rows. Columns other than the id and text are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import FEW, groups, hot_keys, joined, kept, small_side
from tidemark.llm.text import Words, mix64, spans, utf8

SHINGLE = 5
TREES, LENGTH, DEPTH = 16, 8, 3
FIRST_TREES = 3
WINDOW = 64
#: Of 128 sketch bits that must agree: 112 are expected at similarity 0.75, with a deviation of 3.7.
AGREE = 97
_HASHES = TREES * LENGTH
_SEEDS = np.random.default_rng(5).integers(1, 2**32, (2, _HASHES), dtype=np.uint32)
_PER_TASK = 200_000
#: Shingles are counted by this many bits of their hash; any count gives a valid order, a good one a short join.
_COUNTED = 20
_LOWS = [1]
while _LOWS[-1] < 1 << 40:
    _LOWS.append(_LOWS[-1] + max(1, _LOWS[-1] // 32))
#: The smallest size of each band of sizes.
_LOWS = np.array(_LOWS)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a span."""
    words = Words(data, offsets)
    hashes = words.hashes()
    at, value = words.windows(hashes, SHINGLE)
    edge = np.searchsorted(words.row[at], np.arange(len(offsets))) if len(at) else np.zeros(len(offsets), int)
    for row, n in enumerate(words.count):
        if n >= SHINGLE:
            yield np.unique(value[edge[row] : edge[row + 1]])
        elif n:
            short = np.uint64(n)
            for x in hashes[words.bound[row] : words.bound[row + 1]]:
                short = mix64(np.array([short ^ x], np.uint64))[0]
            yield np.array([short], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The smallest of each hash function over the set, each mixed once more so that all bits are even."""
    low = np.full(_HASHES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 1024):
        x = (short[i : i + 1024, None] ^ _SEEDS[0]) * (_SEEDS[1] | np.uint32(1))
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        low = np.minimum(low, x.min(axis=0))
    low ^= low >> np.uint32(13)
    low *= np.uint32(0x297A2D39)
    return low ^ (low >> np.uint32(16))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for i, j in spans(offsets):
            size, node, keys, sketch = [], [], [], []
            for found in shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]):
                size.append(len(found))
                if not len(found):
                    node.append(None), keys.append(None), sketch.append(None)
                    continue
                low = minhash(found)
                node.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                keys.append((low & np.uint32(0xFFFF)).astype("<u2").tobytes())
                sketch.append(np.packbits(((low >> np.uint32(20)) & np.uint32(1)).astype(bool)).tobytes())
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(size, pa.int64()), *(pa.array(x, pa.binary()) for x in (node, keys, sketch))],
                names=["doc_id", "text_hash", "n_shingles", "node", "keys", "sketch"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for i, j in spans(offsets):
            found = [x.tobytes() for x in shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])]
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(i, j - i), pa.array(found, pa.binary())], names=["node", "shingles"])


def _clusters(near: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each, given a symmetric boolean matrix."""
    label = np.arange(len(near))
    reach = near | np.eye(len(near), dtype=bool)
    while True:
        new = np.where(reach, label, len(near)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _near(sketch: np.ndarray, label: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(sketch, axis=1).astype(np.float32) * 2 - 1
    near = bits @ bits.T >= 2 * AGREE - _HASHES
    return near & (label[:, None] != label)


def _fixed(table: pa.Table, name: str) -> np.ndarray:
    data = b"".join(table.column(name).to_pylist())
    return np.frombuffer(data, np.uint8).reshape(table.num_rows, -1)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clusters of nodes to compare, from one sorted range of one or more trees; and the rows at its ends.

    Side 2 names the regions of which not all pairs are compared: those larger than a window, and one that fills
    the range and so may lie in more than two.
    """
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    task = TaskContext.get().partitionId()
    keys, sketch, ids = _fixed(table, "key"), _fixed(table, "sketch"), table.column("node").to_pylist()
    _, label = np.unique(_fixed(table, "label"), axis=0, return_inverse=True)
    label = label.reshape(-1)
    tree = table.column("tree").to_numpy()
    region = np.concatenate([tree[:, None].astype(np.uint8), keys[:, : 2 * DEPTH]], axis=1)
    edges = np.flatnonzero(np.concatenate([[True], (region[1:] != region[:-1]).any(axis=1), [True]]))
    block, node, crowds = [], [], []
    for a, b in zip(edges[:-1], edges[1:]):
        if b - a > WINDOW or len(edges) == 2:
            crowds.append(region[a].tobytes())
        if b - a < 2:
            continue
        for i in range(a, b, WINDOW):
            own = min(WINDOW, b - i)
            j = min(i + 2 * WINDOW, b)
            if j - i < 2:
                continue
            near = _near(sketch[i:j], label[i:j])
            near[own:, own:] = False
            for k in np.flatnonzero(near.any(axis=1) if near.any() else []):
                block.append(f"{task}-{i}"), node.append(ids[i + k])
    ends = []
    head = range(0, min(edges[1], WINDOW))
    tail = range(max(edges[-2], len(ids) - WINDOW), len(ids))
    for at, side, rows in ((task - 1, 1, head), (task, 0, tail)):
        ends += [(f"e{at}", side, ids[k], region[k].tobytes() + sketch[k].tobytes(), table.column("label")[int(k)].as_py()) for k in rows]
    ends += [(None, 2, None, x, None) for x in crowds]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(block + [x[0] for x in ends], pa.string()),
            pa.array([None] * len(block) + [x[1] for x in ends], pa.int32()),
            pa.array(node + [x[2] for x in ends], pa.binary()),
            pa.array([None] * len(block) + [x[3] for x in ends], pa.binary()),
            pa.array([None] * len(block) + [x[4] for x in ends], pa.binary()),
        ],
        names=["block", "side", "node", "record", "label"],
    )


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same between the last rows of one range and the first of the next."""
    for table in groups(batches):
        side = table.column("side").to_numpy()
        if len(np.unique(side)) < 2:
            continue
        record = _fixed(table, "record")
        _, label = np.unique(_fixed(table, "label"), axis=0, return_inverse=True)
        region = record[:, : 1 + 2 * DEPTH]
        near = _near(record[:, 1 + 2 * DEPTH :], label.reshape(-1)) & (side[:, None] != side)
        near &= (region[:, None] == region[None]).all(axis=2)
        found = np.flatnonzero(near.any(axis=1))
        if len(found):
            yield pa.RecordBatch.from_arrays([table.column("block").take(found).combine_chunks(), table.column("node").take(found).combine_chunks()], names=["block", "node"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    out = np.zeros((len(sets), len(sets)))
    whole, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    for a in range(0, len(whole), 8192):
        i, j = np.searchsorted(place, [a, a + 8192])
        part = np.zeros((len(sets), 8192), np.float32)
        part[owner[i:j], place[i:j] - a] = 1
        out += part @ part.T
    return out


def _confirm(threshold: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From each cluster, links from every node to the smallest of those it is confirmed to reach."""
        for table in groups(batches):
            nodes = table.column("node").to_pylist()
            if len(nodes) < 2:
                continue
            order = np.argsort(np.array(nodes, object))
            nodes = [nodes[i] for i in order]
            found = [table.column("shingles")[int(i)].as_buffer() for i in order]
            sets = [np.frombuffer(x, np.uint64) for x in found]
            size = np.array([len(s) for s in sets])
            both = overlaps(sets)
            near = 100 * both >= threshold * (size[:, None] + size - both)
            label = _clusters(near)
            linked = np.flatnonzero(label != np.arange(len(nodes)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in linked], pa.binary()), pa.array([nodes[label[i]] for i in linked], pa.binary())], names=["a", "b"])

    return confirm


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable, for every node of ``links(a, b)``.

    Large and small star steps alternate until nothing changes. Every step is a grouped minimum, combined
    before its shuffle, and a join that deals the edges of a node with many over several places; edges never outnumber
    the links given.
    """
    edges = kept(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, most = None, edges.count()
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n")).withColumn("low", F.least("a", "low"))
        met = joined(both, low.drop("n"), "a", hot_keys(low, "a", 2 * most))
        large = kept(met.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        small = joined(large, low.drop("n"), "a", hot_keys(low, "a", most)).select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        edges = kept(small.filter("a != b").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        before = now


def _read(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` of the wanted nodes, from their texts."""
    wanted = small_side(wanted.select("node", F.col("doc_id").alias("own"), F.col("text_hash").alias("own_hash")), FEW)
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("text_hash") == F.col("own_hash")))
    return texts.select("node", "text").mapInArrow(_sets, "node binary, shingles binary").dropDuplicates(["node"])


def _links(docs: DataFrame, nodes: DataFrame, trees: range, labels: DataFrame | None, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Confirmed links, and the regions of which not all pairs were compared."""
    spark = docs.sparkSession
    if labels is not None:
        nodes = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    else:
        nodes = nodes.withColumn("label", F.col("node"))
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("tree"), F.substring("keys", 1 + 2 * LENGTH * t, 2 * LENGTH).alias("key")) for t in trees)))
    rows = nodes.select("node", "sketch", "label", each.alias("t")).select("t.*", "node", "sketch", "label")
    tasks = max(1, -(-nodes.count() * len(trees) // _PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))
    forest = rows.repartitionByRange(tasks, "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    found = kept(forest.mapInArrow(_candidates, "block string, side int, node binary, record binary, label binary"), "forest")
    ends = found.filter("side < 2").repartition("block").sortWithinPartitions("block")
    blocks = found.filter("side is null").select("block", "node").unionByName(ends.mapInArrow(_across, "block string, node binary"))
    blocks = kept(blocks, "clusters")
    wanted = kept(blocks.select("node").distinct().join(nodes.select("node", "doc_id", "text_hash"), "node"), "wanted")
    pieces = blocks.join(_read(docs, wanted), "node").select("block", "node", "shingles").repartition("block").sortWithinPartitions("block")
    return pieces.mapInArrow(_confirm(threshold), "a binary, b binary"), found.filter("side = 2").select("record").distinct()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << _COUNTED, np.int64)
    for batch in batches:
        for found in batch.column("shingles"):
            total += np.bincount(np.frombuffer(found.as_buffer(), np.uint64) >> np.uint64(64 - _COUNTED), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["at", "n"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in one."""
    for batch in batches:
        at, n = (batch.column(c).to_numpy() for c in ("at", "n"))
        pair = [pa.array([x.tobytes()], pa.binary()) for x in (at.astype("<u4"), np.minimum(n, 0xFFFFFFFF).astype("<u4"))]
        yield pa.RecordBatch.from_arrays(pair, names=["at", "n"])


def prefixes(found: np.ndarray, count: np.ndarray, threshold: int) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    """``band, larger, shingles, reach`` of one set: what it has in common with any set that it is near to.

    For each band of sizes it may be the larger of a pair with, and once for its own band as the smaller one.
    ``reach`` is the largest size of the other set for which the shingle belongs to the prefix.
    """
    size = len(found)
    often = count[found >> np.uint64(64 - _COUNTED)]
    order = np.lexsort((found, often))
    found, single = found[order], often[order] < 2
    reach = (size - np.arange(size)) * (100 + threshold) // threshold - size
    own = int(np.searchsorted(_LOWS, size, "right")) - 1
    least = int(np.searchsorted(_LOWS, -(-threshold * size // 100), "right")) - 1
    for band, larger, low in ((own, False, size), *((b, True, _LOWS[b]) for b in range(least, own + 1))):
        use = np.flatnonzero((reach >= low) & ~single)
        yield band, larger, found[use], reach[use]


def _prefixes(count: np.ndarray, threshold: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = np.frombuffer(batch.column("shingles")[i].as_buffer(), np.uint64)
                parts = [x for x in prefixes(found, count, threshold) if len(x[2])]
                if not parts:
                    continue
                n = [len(x[2]) for x in parts]
                at = pa.array(np.full(sum(n), i))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([x[2] for x in parts]).view(np.int64)),
                        pa.array(np.repeat([x[0] for x in parts], n), pa.int32()),
                        pa.array(np.repeat([x[1] for x in parts], n)),
                        pa.array(np.full(sum(n), len(found)), pa.int64()),
                        pa.array(np.concatenate([x[3] for x in parts]), pa.int64()),
                        batch.column("node").take(at),
                        batch.column("label").take(at),
                    ],
                    names=["shingle", "band", "larger", "size", "reach", "node", "label"],
                )

    return each


def _near_pairs(threshold: int):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_set"), batch.column("b_set")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return near


def _crowd_links(docs: DataFrame, nodes: DataFrame, crowds: DataFrame, labels: DataFrame, threshold: int) -> DataFrame | None:
    """All links between nodes of the crowded regions whose labels differ."""
    if crowds.isEmpty():
        return None
    places = F.explode(F.array(*(F.concat(F.lit(bytes([t])), F.substring("keys", 1 + 2 * LENGTH * t, 2 * DEPTH)) for t in range(TREES))))
    inside = nodes.select("node", places.alias("record")).join(small_side(crowds), "record", "left_semi").select("node").distinct()
    wanted = kept(nodes.select("node", "doc_id", "text_hash").join(inside, "node", "left_semi"), "crowd")
    sets = kept(_read(docs, wanted).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "crowd-sets")
    count = np.zeros(1 << _COUNTED, np.uint32)
    counted = sets.select("shingles").mapInArrow(_counted, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    for r in counted.mapInArrow(_packed, "at binary, n binary").collect():  # at most 8 bytes for each of the counters
        count[np.frombuffer(r.at, "<u4")] = np.frombuffer(r.n, "<u4")
    rows = "shingle long, band int, larger boolean, size long, reach long, node binary, label binary"
    rows = kept(sets.mapInArrow(_prefixes(count, threshold), rows), "prefixes")
    key = ["shingle", "band"]
    smaller, larger = F.when(~F.col("larger"), F.col("size")), F.when(F.col("larger"), F.col("size"))
    shared = rows.groupBy(*key).agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(smaller).alias("least"), F.min(larger).alias("least_larger"))
    shared = shared.filter("low < high and least is not null and least_larger is not null").select(*key, "least", "least_larger")
    rows = rows.join(shared, key).filter("reach >= if(larger, least, least_larger)").drop("least", "least_larger")
    rows = kept(rows, "shared")
    x, y = (rows.filter("larger" if side else "not larger").select(*key, *(F.col(c).alias(f"{c}_{side}") for c in ("size", "reach", "node", "label"))) for side in (0, 1))
    pairs = x.join(y, key).filter("label_0 != label_1 and size_0 <= size_1 and size_1 <= reach_0 and size_0 <= reach_1")
    pairs = pairs.select(F.least("node_0", "node_1").alias("a"), F.greatest("node_0", "node_1").alias("b")).distinct()
    a, b = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set")) for c in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "a_set", "b_set").mapInArrow(_near_pairs(threshold), "a binary, b binary")


def near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", threshold: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` and ``text_hash, copies`` for every row of ``docs``.

    Documents are linked where 100 * intersection >= threshold * union. ``text_hash`` tells rows of one id apart;
    ``copies`` counts the rows that share the kept row's id and text.
    """
    docs = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    signed = kept(docs.mapInArrow(_signatures, "doc_id long, text_hash long, n_shingles long, node binary, keys binary, sketch binary"), "signatures")
    same = signed.filter("node is not null").groupBy("node", "doc_id", "text_hash").agg(F.count("*").alias("copies"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "copies")).alias("first")
    nodes = same.groupBy("node").agg(first, F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    nodes = kept(nodes.select("node", "first.doc_id", "first.text_hash", "first.copies", "keys", "sketch"), "nodes")

    links, crowds = _links(docs, nodes, range(FIRST_TREES), None, threshold)
    links = kept(links, "links")
    more, others = _links(docs, nodes, range(FIRST_TREES, TREES), components(links), threshold)
    links = kept(links.unionByName(more), "links")
    label = components(links)
    crowded = _crowd_links(docs, nodes, kept(crowds.unionByName(others), "crowds"), label, threshold)
    if crowded is not None:
        label = components(kept(links.unionByName(crowded), "links"))

    named = nodes.select("node", "doc_id", "copies").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = kept(named, "named")
    best = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    sizes = named.groupBy("label").agg(F.count("*").alias("n"))
    final = kept(joined(named, best, "label", hot_keys(sizes, "label", named.count())).select("node", "component_id", "copies"), "final")
    sizes = signed.filter("node is not null").groupBy("node").agg(F.count("*").alias("n"))
    out = joined(signed.select("doc_id", "text_hash", "n_shingles", "node"), final, "node", hot_keys(sizes, "node", signed.count()))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash", F.coalesce("copies", F.lit(1)).cast("long").alias("copies"))


def deduplicated(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id, and of repeated rows of it one.

    Of rows without an id, every one whose group has no id at all stays.
    """
    found = near_duplicates(docs, threshold=threshold)
    gone = found.filter("not kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    gone = small_side(kept(gone, "dropped"))
    hashed = docs.withColumn("_text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    left = hashed.join(gone, hashed["doc_id"].eqNullSafe(gone["_id"]) & (hashed["_text_hash"] == gone["_hash"]), "left_anti")
    twice = found.filter("kept and copies > 1 and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    twice = small_side(kept(twice, "twice"))
    same = (left["doc_id"] == twice["_id"]) & (left["_text_hash"] == twice["_hash"])
    single = left.join(twice, same, "left_anti")
    again = left.join(twice, same, "left_semi").dropDuplicates(["doc_id", "_text_hash"])
    return single.unionByName(again).select(*docs.columns)
