"""Benchmark decontamination by a broadcast set of normalised n-grams, in DataFrame operations only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A benchmark item gives every run of ``WINDOW``
consecutive words, or all of them if it has fewer. Every text is scanned with windows of the lengths that occur; a
hash match is verified on the words. Items whose windows occur, and the words inside any occurrence, are hits;
contaminated documents, or just the hit spans, are removed.

The scan explodes hashes of windows, not words, and keeps for each text the places whose hash an item has; only the
texts that have any are read again and compared word by word. Cost is in proportion to a text's length.

The windows are broadcast up to ``FEW_WINDOWS`` of them, counted first; a larger benchmark is joined by a shuffle
on the hash. Texts send one row and one for each candidate to the aggregation.

Defined cases: null and empty texts have no words and no hits; an item without words is never found; windows that
several items share count for each; an item with a null id is found but not listed or counted. Repeated rows and
null ids get a row each. Empty tables give no rows or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import kept, small_side
from tidemark.llm.licenses import words_of

WINDOW = 10
FEW_WINDOWS = 500_000


def windows_of_items(items: DataFrame) -> DataFrame:
    """``item_id, width, hash, window`` of every distinct window of every item."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    rows = rows.filter(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(WINDOW)))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)).alias("at"))
    rows = rows.select("item_id", "width", F.slice("words", F.col("at"), F.col("width")).alias("window")).distinct()
    return rows.withColumn("hash", F.xxhash64("window"))


def _windows(words: Column, width: int) -> Column:
    """Place, width and hash of all windows of one width."""
    last = F.size(words) - width
    one = lambda i: F.struct(i.alias("at"), F.lit(width).alias("width"), F.xxhash64(F.slice(words, i + 1, width)).alias("hash"))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), one)).otherwise(F.array().cast("array<struct<at:int,width:int,hash:bigint>>"))


def _keyed(docs: DataFrame) -> DataFrame:
    """``_id, _text`` (a hash) and the words of every row; rows of one id and text have the same hits."""
    return docs.select(F.col("doc_id").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"), words_of(F.col("text")).alias("words"))


def _scanned(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``_id, _text, n_words`` of every row, and the windows whose hash an item has as ``candidates``.

    Only hashes are exploded: no row carries the words of its text, so a text costs in proportion to its length.
    """
    widths = sorted(r[0] for r in known.select("width").distinct().collect())  # at most WINDOW values
    none = F.array().cast("array<struct<at:int,width:int,hash:bigint>>")
    spans = F.flatten(F.array(*(_windows(F.col("words"), w) for w in widths))) if widths else none
    rows = _keyed(docs).select(F.monotonically_increasing_id().alias("row"), "_id", "_text", F.size("words").cast("long").alias("n_words"), spans.alias("spans"))
    rows = rows.select("row", "_id", "_text", "n_words", F.explode_outer("spans").alias("span"))
    hashes = small_side(known.select(F.col("hash").alias("_hash"), F.col("width").alias("_width")).distinct(), FEW_WINDOWS)
    found = rows.join(hashes, (F.col("span.hash") == F.col("_hash")) & (F.col("span.width") == F.col("_width")), "left")
    found = found.filter("_hash is not null or span is null or span.at = 0")  # a row for each text, and one for each candidate
    candidate = F.when(F.col("_hash").isNotNull(), F.col("span"))
    return found.groupBy("row", "_id", "_text", "n_words").agg(F.collect_set(candidate).alias("candidates")).drop("row")


def _verified(docs: DataFrame, scanned: DataFrame, known: DataFrame) -> DataFrame:
    """``_id, _text, spans, items`` of the texts with hits: candidates compared word by word.

    The texts with candidates are read once more; they alone are cut into words again.
    """
    found = scanned.filter(F.size("candidates") > 0).select("_id", "_text", "candidates").dropDuplicates(["_id", "_text"])
    keys = small_side(found.select(F.col("_id").alias("_i"), F.col("_text").alias("_t")))
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = docs.select("doc_id", "text").join(keys, F.col("doc_id").eqNullSafe(F.col("_i")) & (hashed == F.col("_t")), "left_semi")
    texts = _keyed(texts).dropDuplicates(["_id", "_text"]).select(F.col("_id").alias("_i"), F.col("_text").alias("_t"), "words")
    texts = texts.join(found, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_text") == F.col("_t")))
    cut = F.transform("candidates", lambda c: F.struct(c["at"].alias("at"), c["width"].alias("width"), c["hash"].alias("hash"), F.slice("words", c["at"] + 1, c["width"]).alias("words")))
    windows = texts.select("_id", "_text", F.explode(cut).alias("span"))
    same = (F.col("span.hash") == F.col("_hash")) & (F.col("span.words") == F.col("window"))
    hits = windows.join(small_side(known.withColumnRenamed("hash", "_hash").drop("width"), FEW_WINDOWS), same)
    hit = F.struct(F.col("span.at").alias("at"), (F.col("span.at") + F.col("span.width")).alias("end"))
    return hits.groupBy("_id", "_text").agg(F.array_sort(F.collect_set(hit)).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))


def covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))
    step = lambda s, x: F.struct((s["n"] + F.greatest(x["end"] - F.greatest(x["at"], s["reach"]), F.lit(0))).cast("long").alias("n"), F.greatest(x["end"], s["reach"]).alias("reach"))
    return F.aggregate(spans, start, step, lambda s: s["n"])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``."""
    known = kept(windows_of_items(items), "windows")
    scanned = kept(_scanned(docs, known), "scanned")
    found = _verified(docs, scanned, known).select(F.col("_id").alias("_i"), F.col("_text").alias("_t"), "spans", "items")
    out = scanned.join(found, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_text") == F.col("_t")), "left")
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def _found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``_id, _text, spans`` of the contaminated texts."""
    known = kept(windows_of_items(items), "windows")
    scanned = kept(_scanned(docs, known).filter(F.size("candidates") > 0), "scanned")
    return kept(_verified(docs, scanned, known), "contaminated")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones."""
    found = small_side(_found(docs, items).select("_id", "_text"))
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["_text"])
    return docs.join(found, same, "left_anti")


def without_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with the hit words, and what follows each up to the next word, cut out of the texts."""
    found = _found(docs, items)
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["_text"])
    joined = docs.join(small_side(found, 100_000), same, "left")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all("text", F.lit(word + r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), 0)
    head = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    left = F.filter(pieces, lambda _, i: ~F.exists("spans", lambda s: (i >= s["at"]) & (i < s["end"])))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.concat(head, F.array_join(left, "")))
    return joined.withColumn("text", text).select(*docs.columns)
