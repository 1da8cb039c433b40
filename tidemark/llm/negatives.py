"""Hard negatives from an R-tree packed by sort-tile-recursion, searched best-first.

Rows are cut into tiles, and each tile's rows into leaves, by halving them on one coordinate after the other (with
more coordinates than halvings, that is what sort-tile-recursion comes to). Rows equal on a coordinate are
halved by id, so copies of one vector, however many, fill leaves of their own with ascending ids. A leaf has a
minimum bounding box and its smallest id. For an anchor a box gives an interval of inner products: per coordinate the
smaller and the larger end of what the box allows, added up. A queue hands out an anchor's boxes by their upper ends;
a box is passed over if its interval misses the score window, if its upper end is strictly below the kth score
found, or equal to it with no smaller id inside.

The top cuts, which only decide where rows lie and how well boxes prune, come from a sample of ``SAMPLE`` rows; every
row is indexed, and results are exact. Tiles become trees of at most ``TREE_ROWS`` rows, packed in one row
of the index each, so that memory does not grow with the data. Anchors are searched in blocks of ``BLOCK``, broadcast
as packed arrays: first each in its own tile, which gives a floor for its kth score, then in all trees. Every task
sends its own best ``k`` for an anchor to a merge by anchor.

Defined cases: rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part.
A shorter vector counts as padded with zeros. Rows with the anchor's id are not its partners; repeated rows are
partners like any other, but a repeated anchor (same id, label and vector) is searched once. An anchor without
positives, or a positive without negatives in its window, gives no rows; a positive with a negative score has an
empty window. Scores beyond 64 bits are not defined. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import groups, kept

SCALE = 256
#: Rows that the top cuts are fitted to; tiles that they make at most; rows of a tile, a tree and a leaf.
SAMPLE, TILES, TILE_ROWS, TREE_ROWS, LEAF_ROWS = 20_000, 1024, 4096, 16_384, 128
#: Anchors that are broadcast together.
BLOCK = 20_000
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100

_INDEX = "tile int, width int, first binary, low binary, high binary, least binary, ids binary, labels binary, vectors binary"


def eligible(rows: DataFrame, label: Column) -> DataFrame:
    """``vec_id, label, vector`` (whole numbers) of the rows that take part."""
    sound = F.col("vec_id").isNotNull() & label.isNotNull() & (F.size("embedding") > 0)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return rows.filter(sound & finite).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("vector"))


def moved(label: Column, vec_id: Column, every: int = 7, labels: int = 10) -> Column:
    """The label after every seventh id's has been moved on by one."""
    return F.when(vec_id % every == 0, (label + 1) % labels).otherwise(label)


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to one width."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(size) and (size == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(size), width), np.int64)
    start = np.cumsum(size) - size
    at = np.arange(size.sum()) - np.repeat(start, size)
    out[np.repeat(np.arange(len(size)), size), at] = flat
    return out


def halved(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int, axis: int = 0) -> Iterator[np.ndarray]:
    """``rows`` in pieces of at most ``most``: cut in halves on successive coordinates, equal values by id.

    A coordinate on which all rows agree is passed; if they agree on all, they are cut by id alone.
    """
    if len(rows) <= most:
        yield rows
        return
    width = vectors.shape[1]
    for step in range(width):
        value = vectors[rows, (axis + step) % width]
        if value.min() != value.max():
            break
    order = rows[np.lexsort((ids[rows], value))]
    middle = -(-len(order) // (2 * most)) * most  # whole leaves to the left
    for half in (order[:middle], order[middle:]):
        yield from halved(vectors, ids, half, most, (axis + step + 1) % width)


@dataclass(frozen=True)
class Cuts:
    """A binary tree in arrays: axis, value and id to compare with, and the two children (tiles as ``~tile``)."""

    axis: list[int]
    value: list[int]
    id: list[int]
    below: list[int]
    above: list[int]
    tiles: int

    def tile(self, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int32)
        stack = [(0, np.arange(len(ids)))] if self.axis else []
        while stack:
            node, rows = stack.pop()
            value = vectors[rows, self.axis[node]]
            left = (value < self.value[node]) | ((value == self.value[node]) & (ids[rows] <= self.id[node]))
            for child, part in ((self.below[node], rows[left]), (self.above[node], rows[~left])):
                if child < 0:
                    out[part] = ~child
                elif len(part):
                    stack.append((child, part))
        return out


def fitted_cuts(vectors: np.ndarray, ids: np.ndarray, tiles: int) -> Cuts:
    """Cuts that halve the sample on successive coordinates until there are ``tiles`` pieces."""
    cuts = Cuts([], [], [], [], [], max(1, min(tiles, len(ids) // 8)))
    made = 0

    def cut(rows: np.ndarray, pieces: int, axis: int) -> int:
        nonlocal made
        if pieces <= 1:
            made += 1
            return ~(made - 1)
        width = vectors.shape[1]
        for step in range(width):
            value = vectors[rows, (axis + step) % width]
            if value.min() != value.max():
                break
        axis = (axis + step) % width
        order = rows[np.lexsort((ids[rows], value))]
        middle = len(order) * (pieces // 2) // pieces
        node = len(cuts.axis)
        cuts.axis.append(axis), cuts.value.append(int(vectors[order[middle - 1], axis])), cuts.id.append(int(ids[order[middle - 1]]))
        cuts.below.append(0), cuts.above.append(0)
        cuts.below[node] = cut(order[:middle], pieces // 2, (axis + 1) % width)
        cuts.above[node] = cut(order[middle:], pieces - pieces // 2, (axis + 1) % width)
        return node

    if len(ids):
        cut(np.arange(len(ids)), cuts.tiles, 0)
    return cuts


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that holds them."""
    most = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
    return values.astype(next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def packed(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> dict[str, bytes]:
    """A tree: rows in the order of their leaves, and each leaf's first row, box and smallest id."""
    pieces = list(halved(vectors, ids, np.arange(len(ids)), LEAF_ROWS))
    pieces = [p[np.argsort(ids[p], kind="stable")] for p in pieces]
    order = np.concatenate(pieces)
    first = np.cumsum([0, *(len(p) for p in pieces)])[:-1]
    own = vectors[order]
    arrays = {
        "first": first, "low": np.minimum.reduceat(own, first), "high": np.maximum.reduceat(own, first),
        "least": np.minimum.reduceat(ids[order], first), "ids": ids[order], "labels": labels[order],
    }
    return {k: v.astype("<i8").tobytes() for k, v in arrays.items()} | {"vectors": _narrow(own).tobytes()}


def _tiles(cuts, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
                tile = Cuts(**cuts.value).tile(matrix(batch.column("vector"), width), ids)
                yield pa.RecordBatch.from_arrays([pa.array(tile, pa.int32()), *batch.columns], names=["tile", *batch.schema.names])

    return run


def _trees(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by tile; a tile larger than a tree gives several.
        pieces = (batch.slice(i, TREE_ROWS) for batch in batches for i in range(0, batch.num_rows, TREE_ROWS))
        for tile in groups(_bounded(pieces)):
            ids, labels = (tile.column(c).to_numpy() for c in ("vec_id", "label"))
            tree = packed(ids, labels, matrix(tile.column("vector"), width))
            row = {"tile": tile.column("tile")[0].as_py() // _SPLIT, "width": width, **tree}
            yield pa.RecordBatch.from_pylist([row], schema=_INDEX_ARROW)

    return run


_SPLIT = 1 << 20
_INDEX_ARROW = pa.schema([("tile", pa.int32()), ("width", pa.int32()), *((c, pa.binary()) for c in ("first", "low", "high", "least", "ids", "labels", "vectors"))])


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose key, ``tile`` times ``_SPLIT``, goes up by one within a tile after every ``TREE_ROWS`` rows."""
    own, seen = None, 0
    for batch in batches:
        tile = batch.column("tile").to_numpy(zero_copy_only=False).astype(np.int64)
        edges = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
        number = np.arange(len(tile)) - np.repeat(edges, np.diff([*edges, len(tile)]))
        if own == tile[0]:
            head = tile == tile[0]
            number[: head.sum() if head.all() else int(np.argmin(head))] += seen
        key = tile * _SPLIT + number // TREE_ROWS
        own, seen = tile[-1], int(number[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(key), *(batch.column(c) for c in batch.schema.names[1:])], names=batch.schema.names)


@dataclass(frozen=True)
class Index:
    """The trees, the width of their vectors and the cuts that tell a row's tile."""

    trees: DataFrame
    width: int
    cuts: Cuts


def index(rows: DataFrame) -> Index:
    """Trees over all ``rows`` of ``vec_id, label, vector``, written to the shared folder."""
    spark = rows.sparkSession
    shape = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(1)).alias("width")).first()
    n, width = shape["n"], shape["width"]
    draw = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(n, 1)))
    sample = rows.filter(draw).select("vec_id", "vector").limit(2 * SAMPLE).toArrow()
    ids = sample.column("vec_id").to_numpy()
    cuts = fitted_cuts(matrix(sample.column("vector"), width), ids, min(TILES, -(-n // TILE_ROWS)))
    shared = spark.sparkContext.broadcast(vars(cuts))
    tiled = rows.mapInArrow(_tiles(shared, width), "tile int, vec_id long, label long, vector array<long>")
    trees = tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(_trees(width), _INDEX)
    return Index(kept(trees, "trees"), width, cuts)


@dataclass
class Tree:
    """One packed tree, unpacked."""

    tile: int
    first: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Tree:
        width = row["width"]
        longs = {c: np.frombuffer(row[c], "<i8") for c in ("first", "low", "high", "least", "ids", "labels")}
        longs |= {c: longs[c].reshape(-1, width) for c in ("low", "high")}
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(row["vectors"]) // (len(longs["ids"]) * width)]
        return cls(row["tile"], **longs, vectors=np.frombuffer(row["vectors"], kind).reshape(-1, width))

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of the inner products of each anchor with each leaf's rows."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        low, high = self.low.astype(anchors.dtype).T, self.high.astype(anchors.dtype).T
        return up @ low + down @ high, up @ high + down @ low


def exact_type(width: int, *arrays: np.ndarray) -> type:
    """Floating-point numbers add up whole numbers below 2**53 exactly, and faster; 64-bit integers the rest."""
    most = [max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0)))) for a in arrays]
    return np.float64 if max(most) ** 2 * width < 1 << 52 else np.int64


class Best:
    """The best ``k`` scores inside a window, ties by smaller id."""

    __slots__ = ("floor", "found", "high", "k", "low")

    def __init__(self, k: int, low: int | None = None, high: int | None = None, floor: int | None = None):
        self.k, self.low, self.high, self.floor, self.found = k, low, high, floor, []

    def wants(self, lower: float, upper: float, least: int) -> bool:
        """Whether rows with scores in this interval, and no id below ``least``, could enter."""
        if (self.high is not None and lower > self.high) or (self.low is not None and upper < self.low) or (self.floor is not None and upper < self.floor):
            return False
        if len(self.found) < self.k:
            return True
        score, own = self.found[-1]
        return upper > -score or (upper == -score and least < own)

    def over(self, upper: float) -> bool:
        """Whether no box with this upper end, or a smaller one, can matter any more."""
        low = max(x for x in (self.low, self.floor, -self.found[-1][0] if len(self.found) == self.k else None, -np.inf) if x is not None)
        return upper < low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = np.ones(len(scores), bool)
        if self.low is not None:
            inside &= scores >= self.low
        if self.high is not None:
            inside &= scores <= self.high
        if self.floor is not None:
            inside &= scores >= self.floor
        if len(self.found) == self.k:
            inside &= scores >= -self.found[-1][0]
        at = np.flatnonzero(inside)
        if len(at) > self.k:
            at = at[np.lexsort((ids[at], -scores[at]))[: self.k]]
        if len(at):
            self.found = sorted([*self.found, *((-int(scores[i]), int(ids[i])) for i in at)])[: self.k]


def search(tree: Tree, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool, best: dict[int, list[Best]], rows: np.ndarray) -> None:
    """Enter what the tree holds for the anchors ``rows`` into their ``best``: rows of the same label, or of others.

    Each anchor takes leaves from a queue, the one with the largest upper end first.
    """
    if not len(rows):
        return
    kind = exact_type(tree.vectors.shape[1], vectors, tree.vectors)
    lower, upper = tree.bounds(vectors[rows].astype(kind))
    own = tree.vectors.astype(kind)
    edges = [*tree.first.tolist(), len(tree.ids)]
    least = tree.least.tolist()
    for at, a in enumerate(rows.tolist()):
        wanted, low, high, q, name = best[a], lower[at].tolist(), upper[at].tolist(), vectors[a].astype(kind), ids[a]
        queue = [(-u, leaf) for leaf, u in enumerate(high)]
        heapq.heapify(queue)
        while queue:
            u, leaf = heapq.heappop(queue)
            if all(b.over(-u) for b in wanted):
                break
            takers = [b for b in wanted if b.wants(low[leaf], -u, least[leaf])]
            if not takers:
                continue
            i, j = edges[leaf], edges[leaf + 1]
            mine = (tree.labels[i:j] == labels[a]) if same else (tree.labels[i:j] != labels[a])
            mine &= tree.ids[i:j] != name
            if mine.any():
                scores, own_ids = (own[i:j] @ q)[mine], tree.ids[i:j][mine]
                for b in takers:
                    b.add(scores, own_ids)


@dataclass
class Anchors:
    """A block of anchors: ids, labels, vectors, tiles, and the score windows and floors of each (by anchor)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    tiles: np.ndarray
    windows: list[list[tuple[int | None, int | None, int | None]]]


def _searched(shared, same: bool, k: int, own_tile: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Anchors(**shared.value)
        best = {a: [Best(k, *w) for w in windows] for a, windows in enumerate(block.windows)}
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree.of(row)
                rows = np.flatnonzero(block.tiles == tree.tile) if own_tile else np.arange(len(block.ids))
                search(tree, block.vectors, block.ids, block.labels, same, best, rows)
        found = [(a, w, -s, i) for a, own in best.items() for w, b in enumerate(own) for s, i in b.found]
        for i in range(0, len(found), 100_000):
            columns = np.array(found[i : i + 100_000], np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "window", "score", "vec_id"])

    return run


def _best(spark: SparkSession, trees: DataFrame, block: Anchors, same: bool, k: int, own_tile: bool) -> DataFrame:
    """``anchor, window, score, vec_id, rank`` of the best ``k`` of each window."""
    shared = spark.sparkContext.broadcast(vars(block))
    found = trees.mapInArrow(_searched(shared, same, k, own_tile), "anchor long, window long, score long, vec_id long")
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _with_floors(spark: SparkSession, trees: DataFrame, block: Anchors, same: bool, k: int) -> Anchors:
    """``block`` with the kth score of each window among its own tile's rows as a floor, where there are as many."""
    kth = _best(spark, trees, block, same, k, own_tile=True).filter(F.col("rank") == k).select("anchor", "window", "score").toArrow()
    floors = {(a, w): s for a, w, s in zip(*(kth.column(c).to_pylist() for c in ("anchor", "window", "score")))}
    windows = [[(low, high, floors.get((a, w))) for w, (low, high, _) in enumerate(own)] for a, own in enumerate(block.windows)]
    return Anchors(block.ids, block.labels, block.vectors, block.tiles, windows)


def mined_block(own: Index, anchors: pa.Table, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of a block of anchors."""
    spark = own.trees.sparkSession
    ids, labels = (anchors.column(c).to_numpy() for c in ("vec_id", "label"))
    vectors = matrix(anchors.column("vector"), own.width)
    block = Anchors(ids, labels, vectors, own.cuts.tile(vectors, ids), [[(None, None, None)]] * len(ids))
    block = _with_floors(spark, own.trees, block, True, positives)
    near = _best(spark, own.trees, block, True, positives, own_tile=False).select("anchor", "rank", "score", "vec_id").toArrow()
    near = sorted(zip(*(near.column(c).to_pylist() for c in ("anchor", "rank", "score", "vec_id"))))

    # Positives of one score have one window.
    scores: list[list[int]] = [[] for _ in ids]
    rows = []
    for a, rank, score, vec_id in near:
        if score not in scores[a]:
            scores[a].append(score)
        rows.append((a, scores[a].index(score), int(ids[a]), rank, vec_id, score))
    block.windows = [[(-(-LOW * s // 100), HIGH * s // 100, None) for s in own_scores] for own_scores in scores]
    block = _with_floors(spark, own.trees, block, False, negatives)
    found = _best(spark, own.trees, block, False, negatives, own_tile=False)
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(6)]
    names = ["anchor", "window", "anchor_id", "positive_rank", "positive_id", "positive_score"]
    pairs = spark.createDataFrame(pa.Table.from_arrays(columns, names=names))
    out = found.withColumnRenamed("score", "negative_score").withColumnRenamed("vec_id", "negative_id").join(F.broadcast(pairs), ["anchor", "window"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def mine(rows: DataFrame, chosen: Column, label: Column | None = None, block: int = BLOCK) -> DataFrame:
    """Hard negatives for the anchors that ``chosen`` picks, against all rows of ``vec_id, embedding, label``.

    Anchors are distinct and numbered, and searched ``block`` at a time; each block's rows are written as they come.
    """
    spark = rows.sparkSession
    label = moved(F.col("label"), F.col("vec_id")) if label is None else label
    sound = kept(eligible(rows, label), "vectors")
    own = index(sound)
    anchors = kept(sound.filter(chosen).distinct().withColumn("_block", F.lit(0)), "anchors")
    blocks = max(1, -(-anchors.count() // block))
    # By hash, blocks are of nearly equal size: twice as many as needed at least, so that none is much larger.
    blocks = 1 if blocks == 1 else 2 * blocks
    number = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks))
    out: DataFrame | None = None
    for b in range(blocks):
        part = anchors.filter(number == b).drop("_block").orderBy("vec_id", "label").toArrow()
        if part.num_rows:
            found = kept(mined_block(own, part), "negatives")
            out = found if out is None else out.unionByName(found)
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame([], empty) if out is None else out
