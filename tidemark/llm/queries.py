"""One query for each operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, cleaning, decontaminate, langid, licenses, lm, maintext, manifest, neardup, negatives, quality, sharding, toxicity
from tidemark.llm.frames import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op2_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cleaning.clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *counts, "base_failed", "kept", "kept_chars", F.md5("clean_text").alias("clean_md5"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fitted(docs))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.main_text(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fitted(docs, table(spark, sf_dir, "labels")))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))
    places = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return out.select("doc_id", "held_out", "score", "predicted", places.alias("spans"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 24)


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_near_duplicates, op2_line_cleaning, op3_language, op4_main_text, op5_quality,
    op6_licenses, op7_contamination, op8_byte_bpe, op9_toxicity, op10_shards,
    op11_lm_scores, op12_hard_negatives, op13_manifest,
)}

#: The unsigned crc32 of the decimal doc_id: from all ones, for each byte eight shifts, of which those that lose a one bring the polynomial in.
_CRC32 = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], CAST(range(8) AS BIGINT[])), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _manifest_sql(fanout: int = 16, levels: int = 6) -> str:
    """Every level as a table of ``t`` (0 for the leaves' trees, 1 for the sources' tree), up to 16 ** ``levels`` leaves a source.

    A tree with one node left is not raised further. ``path`` collects the siblings of a leaf from below to above.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    part = lambda x: f"coalesce(CAST(octet_length(encode(CAST({x} AS VARCHAR))) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    ctes = [
        f"""leaves AS (SELECT doc_id, source, {leaf("text")} AS leaf,
  CASE WHEN {_CRC32} % 5 = 0 THEN {leaf(f"translate(text, '{upper}', '{lower}')")} ELSE {leaf("text")} END AS changed FROM documents)""",
        """own0 AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
  count(*) OVER (PARTITION BY source) AS n FROM leaves)""",
        "a0 AS (SELECT g, n, r AS p, leaf AS d FROM own0)",
    ]

    def raised(name: str, k: int) -> str:
        return f"""{name}{k + 1} AS (SELECT g, (n + {fanout - 1}) // {fanout} AS n, p // {fanout} AS p, sha256(string_agg(d, '' ORDER BY p)) AS d FROM {name}{k} WHERE n > 1 GROUP BY g, n, p // {fanout}
  UNION ALL SELECT g, n, p, d FROM {name}{k} WHERE n = 1)"""

    def sides(name: str, k: int) -> str:
        run = f"PARTITION BY g, p // {fanout} ORDER BY p"
        left = f"CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END"
        right = f"CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END"
        return f"{name}s{k} AS (SELECT g, n, p, {left} AS l, {right} AS r FROM {name}{k})"

    for k in range(levels):
        ctes += [raised("a", k), sides("a", k)]
    ctes += [f"subroots AS (SELECT g, d FROM a{levels})", "b0 AS (SELECT 0 AS g, count(*) OVER () AS n, g AS p, d FROM subroots)"]
    for k in range(levels):
        ctes += [raised("b", k), sides("b", k)]
    # Where a node is at level k: its rank divided k times, or 0 once its tree has a single node left.
    ctes.append("f0 AS (SELECT doc_id, leaf, g, r, changed AS now, '' AS path FROM own0)")
    step = 0
    for name, tree, at in (("a", "f.g", "f.r"), ("b", "0", "f.g")):
        for k in range(levels):
            fold = "CASE WHEN s.n > 1 THEN sha256(s.l || f.now || s.r) ELSE f.now END"
            where = f"CASE WHEN s.n = 1 THEN 0 ELSE {at} // {fanout**k} END"
            ctes.append(f"f{step + 1} AS (SELECT f.doc_id, f.leaf, f.g, f.r, {fold} AS now, f.path || s.l || s.r AS path FROM f{step} f JOIN {name}s{k} s ON s.g = {tree} AND s.p = {where})")
            step += 1
    return "WITH " + ",\n".join(ctes) + f"""
SELECT f.doc_id, f.leaf, u.d AS subroot, t.d AS root, sha256(f.path) AS proof_sha256, f.now AS folded_root, f.now = t.d AS verified
FROM f{step} f JOIN subroots u ON u.g = f.g, b{levels} t"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op1_near_duplicates": rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM words),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS n
  FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs WHERE 100 * n >= 75 * (nx + ny - n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.y FROM reach r JOIN links l ON r.b = l.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.c AS component_id, s.doc_id = m.c AS kept
FROM sets s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = s.doc_id
""",
    "op7_contamination": rf"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_NORMAL} AS w FROM benchmark),
known AS (SELECT DISTINCT item_id, width, array_to_string(w[i:i+width-1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS width, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
places AS (SELECT doc_id, width, i, array_to_string(w[i:i+width-1], ' ') AS g
  FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM docs, (SELECT DISTINCT width FROM known))),
hits AS (SELECT a.doc_id, a.i, a.width, k.item_id FROM places a JOIN known k ON a.width = k.width AND a.g = k.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
""",
    "op12_hard_negatives": """
WITH e AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scores WHERE same) WHERE place <= 5),
inside AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS place
  FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM inside WHERE place <= 5
""",
    "op13_manifest": _manifest_sql(),
}
