"""Language-model scores, hard negatives and the manifest against brute force, and their defined cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lm, manifest, negatives, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block long, digest string, place int, rank int"
LONG = " ".join(f"Word{i % 977}" for i in range(30_000))
EDGES = [
    (1, None, None, None, None, 1, "x", 1, 1),
    (2, "", "en", "a", 0, 1, "x", 1, 1),
    (3, " \n\t ", "en", "a", 3, 1, "x", 1, 1),
    (4, "One two three.", "en", "a", 14, 1, "x", 1, 1),
    (4, "One two three.", "en", "a", 14, 1, "x", 1, 1),
    (4, "One two four.", "en", "a", 13, 1, "x", 1, 1),
    (None, "one TWO three.", "en", None, 14, 1, "x", 1, 1),
    (None, None, None, None, None, 1, "x", 1, 1),
    (5, LONG, "en", "zü", len(LONG), 1, "x", 1, 1),
    (-6, "ONE two", None, "Z", 7, 1, "x", 1, 1),
    *((100 + i, f"row {i} TWO", "en", "many", 9, 1, "x", 1, 1) for i in range(300)),
]


def fold(doc_id, parts):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


# Language model


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def model(rows, order):
    """Counts of every n-gram up to ``order`` as tuples; a begin is a context only."""
    counts = Counter()
    for doc_id, text in rows:
        if fold(doc_id, 10) in (None, 0):
            continue
        line = ["<s>", *tokens_of(text), "</s>"]
        for end in range(1, len(line)):
            for size in range(1, min(order, end + 1) + 1):
                counts[tuple(line[end - size + 1 : end + 1])] += 1
        counts[("<s>",)] += 1
    return counts


def probability(counts, context, word, normal):
    if not context:
        return (counts[(word,)] + 0.1) / normal
    shorter = probability(counts, context[1:], word, normal)
    return (counts[(*context, word)] + lm.PRIOR * shorter) / (counts[context] + lm.PRIOR)


def expected_scores(rows, order):
    counts = model(rows, order)
    words = [g for g in counts if len(g) == 1 and g != ("<s>",)]
    total = sum(counts[g] for g in words)
    normal = total + 0.1 * (len(words) + 1)
    for doc_id, text in rows:
        line = ["<s>", *tokens_of(text), "</s>"]
        base = sum(math.log10((counts[(w,)] + 0.1) / normal) for w in line[1:])
        score = 0.0
        for i in range(1, len(line)):
            score += math.log10(probability(counts, tuple(line[max(0, i - order + 1) : i]), line[i], normal))
        known = sum(counts[(w,)] > 0 for w in line[1:])
        held = None if doc_id is None else fold(doc_id, 10) == 0
        yield doc_id, held, len(line) - 1, known, total, round(base, 6), round(score, 6)


def scored(df, **kwargs):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm.score(df, **kwargs).collect())


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_are_those_of_all_counts(docs, order):
    assert scored(docs, order=order) == Counter(expected_scores(rows_of(docs), order))


def test_scores_of_odd_rows(edges):
    assert scored(edges) == Counter(expected_scores(rows_of(edges), 2))


def test_scores_without_training_texts(edges):
    out = lm.score(edges, held_out=F.lit(True)).collect()
    assert len(out) == len(EDGES) and all(r.base_score == r.score == 0 and r.n_known == r.train_tokens == 0 for r in out)


def test_probabilities_of_a_context_add_up_to_one(docs):
    counts = model(rows_of(docs.limit(40)), 3)
    words = [g[0] for g in counts if len(g) == 1 and g != ("<s>",)]
    normal = sum(counts[(w,)] for w in words) + 0.1 * (len(words) + 1)
    for context in [("<s>",), (words[0],), ("<s>", words[3]), ("never", "seen")]:
        known = sum(probability(counts, context, w, normal) for w in words)
        assert known + probability(counts, context, "<unknown>", normal) == pytest.approx(1)


def test_held_out_texts_are_likelier_than_by_words_alone(docs):
    held = [r for r in lm.score(docs).collect() if r.held_out and r.n_tokens > 20]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_packing_keeps_keys_and_counts():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64 - 1, 5000, dtype=np.uint64))
    assert (lm.unpacked(lm.packed(keys)) == keys).all()
    assert lm.ranged(keys, 7)[-1] == len(keys) and (np.diff(lm.ranged(keys, 7)) > 500).all()
    for counts in (np.array([0, 1, 2**31]), np.array([5, 2**40])):
        assert (lm._counts(lm._small(counts)) == counts).all()


def test_string_ids_and_an_empty_table(spark, docs):
    named = docs.limit(20).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert lm.score(named).schema["doc_id"].dataType.simpleString() == "string" and lm.score(named).count() == 20
    assert lm.score(docs.limit(0)).collect() == []


def test_documents_are_dealt_into_blocks_once(docs):
    plan = lm.score(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") <= 3 and "CartesianProduct" not in plan


# Hard negatives


def mined(vectors, anchors):
    """``vectors``: id, label, whole components, each row once; ``anchors``: the ids searched."""
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    for a in {(*v[:2], tuple(v[2])) for v in vectors if v[0] in anchors}:
        others = [(-score(a, v), v[0], v[1]) for v in vectors if v[0] != a[0]]
        for p, pid, _ in sorted(x for x in others if x[2] == a[1])[:5]:
            inside = sorted(x[:2] for x in others if x[2] != a[1] and -80 * p <= -100 * x[0] <= -100 * p)
            out += [(a[0], pid, rank, n, -p, -s) for rank, (s, n) in enumerate(inside[:5], 1)]
    return sorted(out)


def whole(rows):
    out = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        out.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    return out


def found(df, chosen=None, **kwargs):
    out = negatives.mine(df, F.col("vec_id") % 100 == 0 if chosen is None else chosen, **kwargs)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out.collect())


EMBEDDINGS = "vec_id long, embedding array<float>, label int, tile int, rank string"


def small(monkeypatch):
    for name, value in (("TILE_ROWS", 64), ("TREE_ROWS", 48), ("LEAF_ROWS", 8), ("SAMPLE", 150)):
        monkeypatch.setattr(negatives, name, value)


def test_negatives_are_those_of_all_pairs(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert found(spark.read.parquet(f"{SF}/embeddings.parquet")) == mined(whole(rows), range(0, 10**6, 100))


def test_negatives_among_copies_ties_and_odd_rows(spark, monkeypatch):
    small(monkeypatch)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(0, 3, 3) / 256], int(rng.integers(0, 4))) for i in range(600)]
    rows += [(1000 + i, [0.5, 0.25, 0.5], i % 10) for i in range(500)]  # one vector, every label
    rows += [(2000, [0.5, 0.25], 1), (2001, [0.5, 0.25, 0.5, 1.0], 1), (2002, [], 1), (2003, None, 1), (2004, [1.0, None, 1.0], 1)]
    rows += [(2005, [float("nan")] * 3, 1), (2006, [float("inf")] * 3, 1), (2007, [1.0, 1.0, 1.0], None), (None, [1.0] * 3, 1)]
    rows += [(100, [0.5, 0.5, 0.5], 2), (100, [0.5, 0.5, 0.5], 2), (1001, [0.5, 0.25, 0.5], 1), (1001, [0.5, 0.25, 0.5], 1)]
    rows += [(-100, [-0.5, -0.5, -0.5], 3), (3000, [2000.0, 3000.0, -1e6], 3)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], EMBEDDINGS)
    want = mined(whole(rows), [i for i in range(-100, 10**4, 100)])
    assert len(want) > 100 and found(df) == want
    assert found(df, block=3) == want


def test_boxes_prune_clusters(monkeypatch):
    small(monkeypatch)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(20, 8))
    vectors = np.floor(256 * (centre[np.arange(4000) % 20] + rng.normal(size=(4000, 8)) / 50)).astype(np.int64)
    ids, labels = np.arange(4000), np.arange(4000) % 2
    tree = negatives.packed(ids, labels, vectors)
    tree = negatives.Tree.of({"tile": 0, "width": 8, **tree})
    assert (np.sort(tree.ids) == ids).all()
    seen, add = [], negatives.Best.add
    monkeypatch.setattr(negatives.Best, "add", lambda self, scores, own: (seen.append(len(scores)), add(self, scores, own))[1])
    best = {0: [negatives.Best(5)]}
    negatives.search(tree, vectors[:1], ids[:1], labels[:1], False, best, np.array([0]))
    want = sorted((-int(vectors[0] @ v), i) for i, v in enumerate(vectors) if labels[i] != labels[0])[:5]
    assert best[0][0].found == want and sum(seen) < 400


def test_bounds_hold_all_rows():
    rng = np.random.default_rng(8)
    vectors = rng.integers(-300, 300, (700, 6))
    tree = negatives.Tree.of({"tile": 0, "width": 6, **negatives.packed(np.arange(700), np.zeros(700, int), vectors)})
    anchors = rng.integers(-300, 300, (30, 6)).astype(float)
    low, high = tree.bounds(anchors)
    scores = anchors @ tree.vectors.astype(float).T
    edges = [*tree.first, 700]
    for leaf, (i, j) in enumerate(zip(edges, edges[1:])):
        assert (low[:, leaf] <= scores[:, i:j].min(axis=1)).all() and (high[:, leaf] >= scores[:, i:j].max(axis=1)).all()


def test_no_embeddings(spark):
    empty = spark.createDataFrame([], EMBEDDINGS)
    assert found(empty) == []
    assert found(spark.createDataFrame([(1, [1.0], 1, 1, "x"), (2, [1.0], 1, 1, "x")], EMBEDDINGS)) == []


# Manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(r, text):
    return sha("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))


def tree(nodes):
    """The top of ``nodes``, and each one's siblings by level as (left, right)."""
    paths = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, below = [], []
        for i in range(0, len(nodes), 16):
            run = nodes[i : i + 16]
            for d, m in enumerate(members[i : i + 16]):
                for x in m:
                    paths[x].append(("".join(run[:d]), "".join(run[d + 1 :])))
            above.append(sha("".join(run)))
            below.append([x for m in members[i : i + 16] for x in m])
        nodes, members = above, below
    return nodes[0], paths


def expected_manifest(rows):
    sources = defaultdict(list)
    for r in rows:
        sources[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    tops = []
    for s in order:
        own = sorted(sources[s], key=lambda x: x[:3])
        tops.append((own, *tree([x[2] for x in own])))
    root, above = tree([t[1] for t in tops])
    for (own, subroot, paths), high in zip(tops, above):
        for (_, _, node, r), low in zip(own, paths):
            path = low + high
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            now = leaf(r, text)
            for left, right in path:
                now = sha(left + now + right)
            yield r.doc_id, node, subroot, root, sha("".join(a + b for a, b in path)), now, now == root


def signed(df):
    return Counter(tuple(r) for r in manifest.verified(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_manifest_is_that_of_the_whole_table(docs, edges):
    want = Counter(expected_manifest(docs.collect()))
    assert signed(docs) == want and {r[-1] for r in want} == {True, False}
    assert signed(edges) == Counter(expected_manifest(edges.collect()))


def test_manifest_of_many_sources_and_a_hot_one(spark):
    rows = [(i, f"T{i}", "en", "hot" if i % 3 else f"s{i % 900}", 1, 1, "x", 1, 1) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert signed(df) == Counter(expected_manifest(df.collect()))


def test_manifest_of_one_row_and_of_none(spark, edges):
    one = edges.filter("doc_id = 2")
    assert signed(one) == Counter(expected_manifest(one.collect()))
    assert manifest.verified(edges.limit(0)).collect() == []


def test_proofs_of_some_leaves_only(spark, docs):
    own = manifest.build(docs, manifest.leaf_of([F.col(c) for c in manifest.FIELDS]))
    few = own.leaves.filter("doc_id % 17 = 0").select("place", "rank", "doc_id", "leaf")
    extra = spark.createDataFrame([(0, 10**6, -1, "none"), (10**6, 0, -1, "none")], "place long, rank long, doc_id long, leaf string")
    want = {r[0]: r for r in expected_manifest(docs.collect())}
    out = manifest.proofs(own, few.unionByName(extra)).withColumn("proof", manifest.proof_digest(F.col("path"))).collect()
    assert {r.doc_id: r.proof for r in out} == {d: want[d][4] for d in want if d % 17 == 0}


def test_sql_of_the_queries(spark):
    from tests.compare import compare, connect

    for name in ("op12_hard_negatives", "op13_manifest"):
        n, problems = compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name])
        assert n and not problems, (name, problems)
