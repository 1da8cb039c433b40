"""Line-first cleaning: judge every line, drop failing lines, then reject documents that lost too much.

Lines are split at ``\\n``. A line with words fails when it is

* navigation: at least ``NAV_MARKS`` separators ``|``, ``»``, ``›`` or ``·``, and one for every four words at least;
* symbols: ``[#*$%&|<>]`` number more than ``SYMBOL_SHARE`` of its words' characters;
* shouting: ``SHOUT_WORDS`` words or more, of whose letters more than ``SHOUT_SHARE`` are capitals;
* boilerplate: it has one of ``PHRASES`` and fewer than ``PHRASE_WORDS`` words;
* stutter: ``SHOUT_WORDS`` words or more, of which more than ``STUTTER_SHARE`` repeat the word before;
* punctuation: ``LONG_LINE`` words or more with no sentence mark at all;
* repeated: equal to an earlier line of the text, and no shorter than ``REPEAT_WORDS`` words.

Lines without words go as well, but lose nothing. A document is kept if it passes the base rules
(``n_words >= 10`` and ``100 * n_repeat_words <= 20 * n_words``) and its cleaned text keeps ``KEEP_SHARE`` of
its words' characters at least.

Defined cases: a null or empty text has zero counts, a null or empty cleaned text, base_failed true and kept
false. Rows are independent, so null ids and repeated rows are judged like any other; an empty table gives no
rows. Texts of any length are judged whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import Words, spans, utf8

NAV_MARKS = 3
SYMBOL_SHARE = 0.15
SHOUT_WORDS, SHOUT_SHARE = 5, 0.7
PHRASE_WORDS = 25
STUTTER_SHARE = 0.4
LONG_LINE = 60
REPEAT_WORDS = 4
KEEP_SHARE = 0.5
PHRASES = (
    "accept all cookies", "all rights reserved", "click here", "cookie policy", "enable javascript", "follow us on",
    "javascript is disabled", "log in to", "lorem ipsum", "privacy policy", "read more", "share this", "sign up",
    "skip to content", "subscribe to our", "terms of service", "terms of use", "use of cookies",
)
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = re.compile(r"[.!?…。！？।؟:;]")
_NAV = re.compile(r"[|»›·]")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_CAPITALS = re.compile(r"[A-Z]{2}")
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)), re.IGNORECASE)


def line_fails(line: str, words: list[bytes], chars: int) -> str | None:
    """The first rule that a line with words breaks."""
    n = len(words)
    marks = len(_NAV.findall(line)) if "|" in line or "»" in line or "›" in line or "·" in line else 0
    if marks >= NAV_MARKS and 4 * marks >= n:
        return "navigation"
    if len(_SYMBOL.findall(line)) > SYMBOL_SHARE * chars:
        return "symbols"
    if n >= SHOUT_WORDS and (_CAPITALS.search(line) or line.upper() == line):
        if sum(map(str.isupper, line)) > SHOUT_SHARE * sum(map(str.isalpha, line)):
            return "shouting"
    if n >= SHOUT_WORDS and sum(map(eq, words, words[1:])) > STUTTER_SHARE * n:
        return "stutter"
    if n < PHRASE_WORDS and _PHRASE.search(line):
        return "boilerplate"
    if n >= LONG_LINE and not _MARKS.search(line):
        return "punctuation"
    return None


def judge(text: str) -> tuple[str, int, int, int]:
    """Cleaned text, characters in words before and after, and lines equal to an earlier one."""
    seen: set[str] = set()
    clean, before, after, repeated = [], 0, 0, 0
    for line in text.split("\n"):
        words = line.encode().split()
        if not words:
            continue
        chars = len(line) - sum(map(line.count, " \t\x0b\x0c\r"))
        before += chars
        again = line in seen
        repeated += again
        seen.add(line)
        if (again and len(words) >= REPEAT_WORDS) or line_fails(line, words, chars):
            continue
        after += chars
        clean.append(line)
    return "\n".join(clean), before, after, repeated


def repeat_words(words: Words) -> np.ndarray:
    """Per row, the words in 5-word windows that occur twice or more in it, exactly as written."""
    at, value = words.windows(words.hashes(fold=False), 5)
    out = np.zeros(len(words.count), np.int64)
    if not len(at):
        return out
    row = words.row[at]
    order = np.lexsort((value, row))
    same = (value[order][1:] == value[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + 5, -1)
    np.add.at(out, words.row, np.cumsum(cover[:-1]) > 0)
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("text")
        data, offsets = utf8(column)
        for i, j in spans(offsets):
            part, edge = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            words = Words(part, edge)
            total = lambda flags, edge=edge: np.diff(np.concatenate([[0], np.cumsum(flags)])[edge])
            judged = [judge(x or "") for x in column.slice(i, j - i).to_pylist()]
            counts = [words.count, [x[1] for x in judged], total(_SYMBOLS[part]), [x[3] for x in judged], repeat_words(words), [x[2] for x in judged]]
            ids = batch.slice(i, j - i)
            kept = [ids.column(k) for k in range(ids.num_columns)]
            names = [*batch.schema.names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept_chars", "clean_text"]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.int64()) for x in counts), pa.array([x[0] for x in judged], pa.string())], names=names)


def clean_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns other than ``text`` as they are, then ``text``, the base counts, ``kept_chars``, ``clean_text``,
    ``base_failed`` and ``kept``. Columns of ``docs`` with one of these names give way."""
    own = {"text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept_chars", "clean_text", "base_failed", "kept"}
    docs = docs.select(*(c for c in docs.columns if c != text and c not in own), F.col(text).alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = docs.mapInArrow(_counts, f"{fields}, {COUNTS}, kept_chars long, clean_text string")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~failed & (F.col("kept_chars") >= KEEP_SHARE * F.col("word_chars")))


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected rows; texts as they were."""
    own = clean_lines(docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text")), "_text")
    return own.filter("kept").select("_row.*")
