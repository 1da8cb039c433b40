"""A Merkle manifest of a dataset: a content-addressed store of nodes, and proofs found by descending it.

A row is a leaf: the SHA-256 of its fields, each with its length. Leaves of a source stand in order of ``doc_id``;
every ``FANOUT`` consecutive nodes become one, up to the source's subroot, and the subroots in order of their sources
likewise become the root. The store maps the digest of every inner node to the digests of its children.

A proof is found from the root, without asking how the tree was built: a request names the place of a source and
the rank of a leaf in it, and the base-``FANOUT`` digits of both say which child to follow; the others of the run are
collected. Requests with the same digits so far travel as one row, so that the root is looked up once and each level
below as often as it has nodes on the way to a leaf; no digest is a hot key of the joins. The segments
collected on the way down, reversed, are the proof from leaf to root.

Ranks come from a range sort on source, id and leaf (and, among equal rows, their place in the input), numbered within
each partition and shifted by the counts of the partitions before, so a source that holds most rows is spread over
many tasks. Levels are aggregates of at most ``FANOUT`` rows a key.

Defined cases: null fields are ``-``; a null source comes first, a null id first in its source, and a row with a null
id is never tampered with. Rows with one id in one source stand in order of their leaves, and equal rows are
interchangeable. A text of any length is hashed whole; an empty one is ``0:``. A table with one row has that leaf as
root and an empty proof. An empty table gives no rows. Other columns are neither read nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import kept

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that one task numbers.
_PER_TASK = 500_000
_PART_BITS = 33  # of monotonically_increasing_id


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(fields: list[Column]) -> Column:
    """The digest of a row: every field as ``-`` if null, or its UTF-8 length, ``:`` and its value."""
    texts = [f.cast("string") for f in fields]
    return digest(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts))


@dataclass(frozen=True)
class Manifest:
    """``root`` (null for an empty table), the ``store`` of nodes, and the ``leaves`` with their places.

    ``store``: ``digest, children``. ``subroots``: ``source, place, n, subroot``. ``leaves``: the columns of the
    numbered rows with ``place`` (of the source among the sources), ``rank`` and ``n`` (leaves of the source).
    """

    root: str | None
    store: DataFrame
    subroots: DataFrame
    leaves: DataFrame


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with a ``rank`` from 0 within their ``source``, ``n`` of the source, and ``place`` of the source.

    ``order`` breaks ties within a source; equal rows are ranked by their place in the input.
    """
    spark = rows.sparkSession
    keys = ["source", *order, "_row"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // _PER_TASK)
    at = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    at = kept(at.sortWithinPartitions(*keys).drop("_row").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    at = at.withColumn("_part", F.shiftright("_at", _PART_BITS))
    # One row for each source and partition: where it begins, and how many rows of the source came before.
    spans = at.groupBy("source", "_part").agg(F.count("*").alias("rows"), F.min("_at").alias("_first"))
    own = Window.partitionBy("source")
    spans = spans.withColumn("_before", F.sum("rows").over(own.orderBy("_part")) - F.col("rows")).withColumn("n", F.sum("rows").over(own))
    spans = kept(spans, "spans")
    firsts = spans.filter("_before = 0")
    heads = firsts.groupBy("_part").agg(F.count("*").alias("heads"))
    earlier = heads.select("_part", (F.sum("heads").over(Window.orderBy("_part")) - F.col("heads")).alias("_earlier"))  # one row a partition
    within = F.row_number().over(Window.partitionBy("_part").orderBy("source")) - 1
    places = firsts.withColumn("_within", within).join(earlier, "_part").select(F.col("source").alias("_source"), (F.col("_earlier") + F.col("_within")).alias("place"))
    spans = spans.join(places, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    spans = spans.select(F.col("source").alias("_source"), F.col("_part").alias("_own"), "place", "n", "_before", "_first")
    found = at.join(spans, (F.col("_part") == F.col("_own")) & F.col("source").eqNullSafe(F.col("_source")))
    return found.withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_own", "_source", "_first", "_before")


def _raised(nodes: DataFrame) -> DataFrame:
    """The next level of ``place, n, at, digest``: each run of ``FANOUT`` becomes a node with its ``children``."""
    runs = nodes.groupBy("place", "n", F.expr(f"at div {FANOUT}").alias("at"))
    runs = runs.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda c: c["digest"]).alias("children"))
    return runs.select("place", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), "at", F.sha2(F.array_join("children", ""), 256).alias("digest"), "children")


def _forest(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All inner nodes by level, and the top of each ``place``: ``place, digest, height``."""
    levels: list[DataFrame] = []
    tops = nodes.filter("n = 1").select("place", "digest", F.lit(0).alias("height"))
    nodes = nodes.filter("n > 1")
    while not nodes.isEmpty():
        level = kept(_raised(nodes), "level")
        levels.append(level.select("digest", "children"))
        tops = tops.unionByName(level.filter("n = 1").select("place", "digest", F.lit(len(levels)).alias("height")))
        nodes = level.filter("n > 1").drop("children")
    return levels, tops


def build(docs: DataFrame, leaf: Column, extra: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``leaf`` is each row's digest, ``extra`` columns stay beside the leaves."""
    extra = extra or {}
    rows = kept(docs.select("doc_id", "source", leaf.alias("leaf"), *(c.alias(name) for name, c in extra.items())), "leaves")
    leaves = kept(numbered(rows, ["doc_id", "leaf"]), "ranked")
    levels, tops = _forest(leaves.select("place", "n", F.col("rank").alias("at"), F.col("leaf").alias("digest")))
    sources = leaves.filter("rank = 0").select("source", "place", "n")
    subroots = kept(sources.join(tops, "place").withColumnRenamed("digest", "subroot"), "subroots")
    count = subroots.count()
    above, top = _forest(subroots.select(F.lit(0).cast("long").alias("place"), F.lit(count).cast("long").alias("n"), F.col("place").alias("at"), F.col("subroot").alias("digest")))
    root = top.first()
    nodes = levels + above
    if nodes:
        store = nodes[0]
        for level in nodes[1:]:
            store = store.unionByName(level)
        store = kept(store.dropDuplicates(["digest"]), "store")
    else:
        store = leaves.limit(0).select(F.col("leaf").alias("digest"), F.array("leaf").alias("children"))
    return Manifest(root["digest"] if root else None, store, subroots, leaves)


def heights(most: int) -> int:
    """Levels above ``most`` nodes."""
    height = 0
    while most > 1:
        most = -(-most // FANOUT)
        height += 1
    return height


def _descended(requests: DataFrame, store: DataFrame, wanted: DataFrame) -> DataFrame:
    """Requests of ``tree, at, digest, path``, one level further: the children that ``wanted`` (``tree, at``) names.

    Each child's digit selects it from the run; its unselected neighbours, left and right of it, go to the front
    of the path, which so runs from below to above.
    """
    runs = requests.join(store, "digest").select("tree", "at", "path", "children")
    child = runs.select("tree", "at", "path", "children", F.posexplode("children").alias("digit", "digest"))
    sides = F.struct(
        F.array_join(F.slice("children", F.lit(1), F.col("digit")), "").alias("left"),
        F.array_join(F.slice("children", F.col("digit") + 2, FANOUT), "").alias("right"),
    )
    child = child.select("tree", (F.col("at") * FANOUT + F.col("digit")).alias("at"), "digest", F.concat(F.array(sides), "path").alias("path"))
    return child.join(wanted, ["tree", "at"])


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (``place, rank`` and other columns) with ``subroot``, and the ``path`` from their leaf to the root.

    The path holds for every level the digests ``left`` and ``right`` of the node in its run, from below to above.
    Requests that name no leaf give no row.
    """
    spark = requests.sparkSession
    if manifest.root is None:
        path = "array<struct<left:string,right:string>>"
        return requests.limit(0).withColumn("subroot", F.lit("")).withColumn("path", F.array().cast(path))
    subroots, none = manifest.subroots, F.array().cast("array<struct<left:string,right:string>>")
    shape = subroots.agg(F.count("*").alias("sources"), F.max("height").alias("height")).first()
    places = requests.select(F.lit(0).cast("long").alias("tree"), F.col("place").alias("at")).distinct()

    # From the root to the subroots asked for.
    found = spark.range(1).select(F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("at"), F.lit(manifest.root).alias("digest"), none.alias("path"))
    for level in reversed(range(heights(shape["sources"]))):
        prefixes = places.select("tree", F.expr(f"at div {FANOUT**level}").alias("at")).distinct()
        found = _descended(found, manifest.store, prefixes)
    found = found.select(F.col("at").alias("place"), F.col("digest").alias("subroot"), "path")
    heads = found.join(subroots.select("place", "height"), "place")
    heads = kept(heads, "subroot-proofs")

    # From each subroot to the runs of leaves asked for; a source joins in at its own height.
    asked = requests.select(F.col("place").alias("tree"), F.col("rank").alias("at"))
    at_height = lambda h: heads.filter(F.col("height") == h).select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("at"), F.col("subroot").alias("digest"), "path")
    found = at_height(shape["height"])
    for level in reversed(range(1, shape["height"])):
        prefixes = asked.select("tree", F.expr(f"at div {FANOUT**level}").alias("at")).distinct()
        found = _descended(found, manifest.store, prefixes).unionByName(at_height(level))
    # The last digit, beside the requests of a run, which are at most ``FANOUT`` different leaves.
    request = F.struct((F.col("rank") % FANOUT).cast("int").alias("digit"), *(c for c in requests.columns if c != "place"))
    grouped = requests.groupBy(F.col("place").alias("tree"), F.expr(f"rank div {FANOUT}").alias("at")).agg(F.collect_list(request).alias("asked"))
    last = found if shape["height"] else found.limit(0)
    last = last.join(grouped, ["tree", "at"]).join(manifest.store, "digest").select("tree", "path", "children", F.explode("asked").alias("r"))
    sides = F.struct(
        F.array_join(F.slice("children", F.lit(1), F.col("r.digit")), "").alias("left"),
        F.array_join(F.slice("children", F.col("r.digit") + 2, FANOUT), "").alias("right"),
    )
    last = last.filter(F.col("r.digit") < F.size("children")).select(F.col("tree").alias("place"), "r.*", F.concat(F.array(sides), "path").alias("path")).drop("digit")
    alone = requests.filter("rank = 0").join(heads.filter("height = 0").select("place", "path"), "place")
    rest = [c for c in requests.columns if c != "place"]
    out = last.select("place", *rest, "path").unionByName(alone.select("place", *rest, "path"))
    return out.join(heads.select("place", "subroot"), "place")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, from below to above and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def verified(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    Where ``TAMPERED`` divides the crc32 of the id as text, the row is tampered with after the manifest was made:
    A-Z of its text become lower case. Every leaf's proof is folded with the row as it now is.
    """
    own = [F.col(c) for c in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    changed = F.when(hit, leaf_of([*own[:-1], F.translate(own[-1], _UPPER, _LOWER)]))
    manifest = build(docs, leaf_of(own), {"changed": changed})
    requests = manifest.leaves.select("place", "rank", "doc_id", "leaf", "changed")
    rows = proofs(manifest, requests)
    now = folded(F.coalesce("changed", "leaf"), F.col("path"))
    out = rows.select("doc_id", "leaf", "subroot", F.lit(manifest.root).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), now.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
