"""The document operators against brute force on small inputs, and their defined cases."""

import hashlib
import html
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, cleaning, decontaminate, langid, licenses, maintext, neardup, quality, sharding, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, hash string, label string, kept int"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
EDGES = [
    (1, None, None, None, None, 1, "x", "y", 1),
    (2, "", "en", "a", 0, 1, "x", "y", 1),
    (3, " \n\t ", "en", "a", 3, 1, "x", "y", 1),
    (4, "One two three.", "en", "a", 14, 1, "x", "y", 1),
    (4, "One two three.", "en", "a", 14, 1, "x", "y", 1),
    (None, "one TWO three.", "en", None, 14, 1, "x", "y", 1),
    (5, LONG, "en", "a", len(LONG), 1, "x", "y", 1),
    (6, "12 34 !! ##", None, "a", 11, 1, "x", "y", 1),
]


def low(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def shingles(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if len(words) < 5:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(" ".join(words[i : i + 5]) for i in range(len(words) - 4))


def components(sets):
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in ids}


def test_near_duplicates_are_those_of_all_pairs(spark, docs, texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    rows = neardup.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in rows} == components(sets)
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in rows)


def test_large_groups_of_near_copies_hold_together(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(400):
        words = list(base)
        for _ in range(rng.integers(0, 5)):
            words[rng.integers(len(words))] = f"x{rng.integers(10**6)}"
        rows.append((d, " ".join(words)))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == components({d: shingles(t) for d, t in rows})


def test_links_inside_a_crowd_below_the_threshold(spark):
    rng = np.random.default_rng(6)
    passage = [f"p{i}" for i in range(166)]
    rows = []
    for d in range(4000):
        own = [f"u{d}x{i}" for i in range(34 + d % 3)]
        if d % 13 == 12:  # shares 8 to 12 more shingles with the one before: similarity 0.76 to 0.80
            k = int(rng.integers(13, 17)) - 4
            own[:k] = rows[-1][1].split()[166 : 166 + k]
        rows.append((d, " ".join(passage + own)))
    sets = {d: shingles(t) for d, t in rows}
    often = Counter(s for x in sets.values() for s in x)
    place = {s: i for i, s in enumerate(s for s, n in often.items() if n > 1)}
    found = np.zeros((len(rows), len(place)), np.float32)
    for d, x in sets.items():
        found[d, [place[s] for s in x if s in place]] = 1
    both, size = found @ found.T, np.array([len(x) for x in sets.values()])
    near = 100 * both >= 75 * (size[:, None] + size - both)
    links = [(a, b) for a, b in zip(*np.nonzero(near)) if a < b]
    assert 200 < len(links) < 400 and np.median(both / (size[:, None] + size - both)) > 0.69
    wanted = {d: d for d in sets}
    for a, b in links:
        wanted[b] = wanted[a]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == wanted


def test_prefixes_of_near_sets_meet():
    rng = np.random.default_rng(8)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 2**63, int(rng.integers(0, n // 6 + 1))).astype(np.uint64)]))
        x, y = sorted((x, y), key=len)
        both = len(np.intersect1d(x, y))
        if not len(x) or 100 * both < 75 * (len(x) + len(y) - both):
            continue
        count = np.full(1 << 20, 2)
        small = {(b, s) for b, larger, found, reach in neardup.prefixes(x, count, 75) if not larger for s, r in zip(found, reach) if r >= len(y)}
        large = {(b, s) for b, larger, found, reach in neardup.prefixes(y, count, 75) if larger for s, r in zip(found, reach) if r >= len(x)}
        assert small & large


def test_near_duplicate_cases(spark, edges):
    rows = neardup.near_duplicates(edges).collect()
    assert len(rows) == len(EDGES)
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in rows)[:5] == [(0, 1, 4, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True)]
    left = neardup.deduplicated(edges)
    assert left.columns == edges.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 4, 5, 6]


def test_base_counts_of_cleaning(docs, edges):
    rows = cleaning.clean_lines(docs).collect() + cleaning.clean_lines(edges).collect()
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for r in rows:
        text = r.text or ""
        w = word.findall(text)
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count, inside, seen, again = Counter(grams), set(), set(), 0
        for i, g in enumerate(grams):
            if count[g] > 1:
                inside.update(range(i, i + 5))
        for line in text.split("\n"):
            if word.search(line):
                again += line in seen
                seen.add(line)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside))
        assert r.base_failed == (len(w) < 10 or 100 * len(inside) > 20 * len(w)) and not (r.base_failed and r.kept)
    assert cleaning.cleaned(edges).columns == edges.columns


@pytest.mark.parametrize("line, rule", [
    ("Home | News | Sport | About", "navigation"), ("a*** b### c$$$", "symbols"), ("BUY THIS NOW OR NEVER!!", "shouting"),
    ("the the the the the the", "stutter"), ("All rights reserved.", "boilerplate"), (" ".join(f"word{i}" for i in range(70)), "punctuation"), ("A plain sentence stands here.", None),
])
def test_line_rules(line, rule):
    assert cleaning.line_fails(line, line.encode().split(), len(line.replace(" ", ""))) == rule


def test_language(spark, docs, edges):
    net = langid.fitted(docs)
    rows = langid.identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.9 * len(held) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    found = langid.identify(edges, net).collect()
    assert len(found) == len(EDGES) and {r.lang_pred for r in found if r.doc_id in (1, 2, 3, 6)} == {"und"}
    nothing = langid.identify(edges, langid.fitted(edges.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_every_language_is_learned(spark):
    rows = [(10 * i + k, f"text {i} of {k}", f"l{i}") for i in range(300) for k in range(8)]
    rows += [(5000 + i, "long " * 10_000 + str(i), "only-long") for i in range(8)] + [(9000, "one text", "hot")] * 3000
    found = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    learned = {d for d, _, _ in rows if zlib.crc32(str(d).encode()) % 4 != 2}
    want = {(d, lang) for d, _, lang in rows if d in learned}
    assert {(r.doc_id, r.lang) for r in found} == want and len(found) == len(want)
    assert max(len(r.text) for r in found) == langid.LONGEST
    many = spark.range(5000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'x' AS lang")
    assert langid.sample(many).count() == langid.PER_CLASS


def test_language_gradients():
    net = langid.Network.fresh(["a", "b"])
    net.weights = {k: v.astype(float) for k, v in net.weights.items()}
    ids = np.random.default_rng(0).integers(97, 101, (5, 3)).astype(np.uint8)
    live = np.ones((5, 3), bool)
    live[3:, 2] = False
    wanted = np.array([0, 1, 0])
    _, grad = langid.gradients(net, ids, live, wanted)
    for k, at in (("uf", (2, 1)), ("xb", (int(ids[0, 0]), 4)), ("out", (3, 1)), ("ub", (1, 9))):
        net.weights[k][at] += 1e-4
        up, _ = langid.gradients(net, ids, live, wanted)
        net.weights[k][at] -= 2e-4
        down, _ = langid.gradients(net, ids, live, wanted)
        net.weights[k][at] += 1e-4
        assert abs((up - down) / 2e-4 - grad[k][at]) < 1e-4


def test_main_text(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r.text for r in maintext.main_text(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*)</article>", r.html, re.DOTALL)[1]
        lines = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", "\n", inside)).split("\n")
        assert found[r.page_id] == "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in lines) if x)


def main_texts(spark, pages):
    """Main texts of ``(url, html)`` in order."""
    df = spark.createDataFrame([(i, *p, 5) for i, p in enumerate(pages)], "page_id long, url string, html string, host int")
    return [r.text for r in sorted(maintext.main_text(df).collect(), key=lambda r: r.page_id)]


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + int(c)) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(n))


def test_main_text_cases(spark):
    page = "<html><body><div id='menu'>Home</div><div class=content><p>First &lt;{0}&gt;\n  part</p><p>Second {0}</p><p>Share it</p></div><div class='comments'><p>me {0}</p></div></body></html>"
    pages = [("http://a.b/x", page.format(f"text of page number {i}")) for i in range(8)]
    assert main_texts(spark, pages)[3] == "First <text of page number 3> part\nSecond text of page number 3"
    few = main_texts(spark, pages[:3])[0]  # no template: all that is not skipped
    assert few == "First <text of page number 0> part\nSecond text of page number 0\nShare it"
    for raw in (None, "", "<", "<p", "a < b", "<!-- x", "<script>x</script>", "</p></div>"):
        assert main_texts(spark, [("http://a.b", raw)])[0] in ("", "<", "<p", "a < b")
    rows = [(1, None, None, 5), (None, "http://x", "<p>a</p>", 5), (2, "http://x", "", 5), (2, "http://x", "", 5)]
    found = maintext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, host int")).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found) == [(0, "a", 1), (1, "", 0), (2, "", 0), (2, "", 0)]


def test_main_text_by_structure_alone(spark):
    """No tag or name tells: menu words, adverts and footers differ page by page, only tags repeat."""
    pages, want = [], []
    for i in range(40):
        menu = "".join(f"<li>{w}</li>" for w in words(i, 6).split())
        body = [words(1000 * i + k, 25) for k in range(2 + i % 5)]
        want.append("\n".join([words(i + 500, 4), *body]))
        inner = f"<h1>{words(i + 500, 4)}</h1>" + "".join(f"<p>{x}</p>" for x in body)
        pages.append(("https://h.example/p", f"<body><div><ul>{menu}</ul></div><div>{words(i + 77, 9)}</div><div>{inner}</div><div>Imprint {words(i, 3)}</div></body>"))
    assert main_texts(spark, pages) == want


def test_an_article_repeated_on_most_pages_stays(spark):
    text = [words(k, 30) for k in range(3)]
    page = "<body><div><ul>{}</ul></div><div><h1>Title</h1>{}</div><div>All rights reserved</div></body>"
    menus = ["".join(f"<li>{w}</li>" for w in words(i, 5).split()) for i in range(40)]
    bodies = ["".join(f"<p>{x}</p>" for x in (text if i < 32 else [words(100 + i, 30), words(200 + i, 20)])) for i in range(40)]
    found = main_texts(spark, [("https://h.example/p", page.format(m, b)) for m, b in zip(menus, bodies)])
    assert all(found[i].endswith("\n".join(text)) for i in range(32)) and "reserved" not in "".join(found)


def test_names_of_wrappers_do_not_erase_the_article(spark):
    for wrapped in (
        '<div class="page has-sidebar"><article><p>{}</p></article></div>', '<article class="post has-comments"><p>{}</p></article>',
        '<article id="share-price-news"><p>{}</p></article>', '<form class="page"><article><p>{}</p></article></form>', '<div class="sidebar"><article><p>{}</p></article></div>',
    ):
        assert main_texts(spark, [("http://x", wrapped.format("What is told"))]) == ["What is told"]
    aside = '<article><p>Text</p><div class="comments-area"><p>me too</p></div><div class="cookie-notice">Accept</div><nav>Home</nav></article>'
    assert main_texts(spark, [("http://x", aside)]) == ["Text"]


def test_templates_are_those_of_all_occurrence_vectors(spark):
    rng = np.random.default_rng(2)
    pages = []
    for i in range(120):
        blocks = [f"<div><p>{w}</p></div>" for w in ("one note", "another note")] if rng.random() < 0.95 else ["<div><p>one note</p></div>", f"<div>{i}</div>"]
        extra = "<section><p>Imprint</p><p>Contact</p></section>" if i % 2 else ""
        pages.append(f"<body>{''.join(blocks)}<div><p>{words(i // 2 if i % 3 else i, 40)}</p></div>{extra}</body>")
    df = spark.createDataFrame([(i, "http://h.x/1", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {(r.layout, r.main, tuple(r.constant)) for r in maintext.templates(maintext.parsed(df)).collect()}
    layouts = defaultdict(dict)
    for p in map(maintext.parse, pages):
        layouts[maintext.layout(p)].setdefault(maintext.content(p), p)
    want = set()
    for name, own in layouts.items():
        where = [{t[0]: t for t in maintext.tokens(p)} for p in own.values()]
        classes = defaultdict(list)
        for token in set().union(*where):
            vector = tuple(w[token][4] if token in w else 0 for w in where)
            if sum(map(bool, vector)) >= maintext.SUPPORT * len(where):
                classes[vector].append(token)
        valid = {t for ts in classes.values() if len(ts) > 1 for t in ts}
        texts = {t[0]: t for w in where for t in w.values()}
        constant = {t for t in valid if texts[t][2] == maintext.TEXT and texts[t][1] in valid}
        main = next(r.main for r in maintext.templates(maintext.parsed(df)).collect() if r.layout == name)
        want.add((name, main, tuple(sorted(constant))))
    assert got == want and len(got) == 2 and all(len(c) in (1, 2, 3, 4) for _, _, c in got)


def test_parsing_takes_time_in_proportion(spark):
    def seconds(html):
        start = time.perf_counter()
        maintext.parse(html)
        return time.perf_counter() - start

    for piece in ("<a ", "<div>", '<a "', "<div><b>", "<p><i>", "</x>", "<!--", "<", "&lt;", "<p class='", "<li>"):
        small, large = seconds(piece * 20_000 + ">"), seconds(piece * 160_000 + ">")
        assert large < 24 * small + 1, piece  # eight times the page


def split_accuracy(rows, label):
    held = [r for r in rows if r.held_out]
    return sum(r[label] == r.predicted for r in held) / max(1, len(held))


def test_quality_and_toxicity_on_held_out_documents(spark, edges):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    for module, label, least in ((quality, "quality", 0.93), (toxicity, "toxic", 0.85)):
        model = module.fitted(docs, labels)
        assert split_accuracy(module.score(docs, model).join(labels, "doc_id").collect(), label) >= least
        found = module.score(edges, model).collect()
        assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
        blank = module.fitted(docs, labels.limit(0))
        assert {r.predicted for r in module.score(edges, blank).collect()} == {0}


def test_field_marginals_are_those_of_all_paths():
    import itertools

    rng = np.random.default_rng(0)
    emission, moves = rng.normal(0, 2, 6), rng.normal(0, 1, (2, 2))
    first, last = np.array([1, 0, 0, 0, 1, 0], bool), np.array([0, 0, 0, 1, 0, 1], bool)
    p = toxicity.marginals(emission, first, last, moves)[0]
    for a, b in ((0, 4), (4, 6)):
        total, share = 0.0, np.zeros(b - a)
        for tags in itertools.product((0, 1), repeat=b - a):
            weight = np.exp(sum(emission[a + i] * t for i, t in enumerate(tags)) + sum(moves[s, t] for s, t in zip(tags, tags[1:])))
            total, share = total + weight, share + weight * np.array(tags)
        assert np.allclose(share / total, p[a:b])


def test_toxic_spans_are_character_offsets():
    raw = "Né mal! bad word"
    tokens = toxicity.Tokens.of([raw])
    data = np.frombuffer(raw.encode(), np.uint8)
    spans = toxicity.spans_of(tokens, data, np.array([0, len(data)]), [np.array([0.1, 0.9, 0.8, 0.2])])
    assert [raw[s["start"] : s["end"]] for s in spans[0]] == ["mal! bad"]


def test_licenses(docs, texts, edges):
    phrases = [(label, text.split()) for label, text in licenses.PHRASES]
    for r in licenses.scan(docs).collect():
        w = low(texts[r.doc_id])
        at = [(i, label) for label, p in phrases for i in range(len(w)) if w[i : i + len(p)] == p]
        base = sorted({x for _, x in at})
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(base))
        assert set(base) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    rows = licenses.scan(edges).collect()
    assert len(rows) == len(EDGES) and {(r.n_base, r.labels) for r in rows} == {(0, "")}


def test_license_with_an_inserted_word(spark):
    text = "permission is hereby granted free of any charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == "mit" and row.n_base == 0 and row.score < 1


def contaminated(texts, items):
    known = defaultdict(set)
    for i, t in items:
        w = low(t)
        k = min(10, len(w))
        for a in range(len(w) - k + 1):
            if k:
                known[tuple(w[a : a + k])].add(str(i))
    out = {}
    for d, t in texts.items():
        w, hit, found = low(t), set(), set()
        for k in {len(x) for x in known}:
            for a in range(len(w) - k + 1):
                if ids := known.get(tuple(w[a : a + k])):
                    found |= ids
                    hit.update(range(a, a + k))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def test_contamination(spark, docs, texts, edges):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    items += [(900, "short item"), (901, ""), (902, None), (903, "One TWO three")]
    bench = spark.createDataFrame([tuple(x) for x in items], "item_id long, text string")
    whole = docs.select("doc_id", "text").unionByName(edges.filter("doc_id > 4").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    known = {r.doc_id: r.text for r in whole.collect()}
    rows = decontaminate.contamination(whole, bench).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == contaminated(known, items)
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not contaminated(texts, items)[d][-1] for d in texts)
    assert not decontaminate.contamination(decontaminate.without_spans(docs, bench), bench).filter("contaminated").count()
    edge = decontaminate.contamination(edges, bench).collect()
    assert len(edge) == len(EDGES) and sum(r.contaminated for r in edge) == 3
    assert not decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count()


@pytest.mark.parametrize("chunk, overlap", [(bpe.CHUNK, bpe.OVERLAP), (700, 90), (200, 12)])
def test_byte_bpe(spark, texts, chunk, overlap):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = dict(list(texts.items())[:80]) | {-1: None, -2: "", -3: "a" * 3000, -4: "x" + " " * 900 + "\n\ny", -5: "it's  é\t日本 " * 300}
    rows = bpe.encode(spark.createDataFrame(list(own.items()), "doc_id long, text string"), ranks, public_tokenizers.PATTERN, True, chunk, overlap).collect()
    assert len(rows) == len(own)
    for r in rows:
        text = own[r.doc_id] or ""
        ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
        assert bytes(r.ids) == ids and r.n_tokens == len(ids) // 4 and r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_very_long_white_space():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    text = "a" + " " * 300_000 + "b"
    assert codec.decode(codec.encode(text)) == text.encode()


def test_shards(spark, docs, edges, texts):
    rows = sharding.shard(docs, 24).collect()
    count = Counter(r.shard for r in rows)
    assert len(rows) == len(texts) and max(count.values()) - min(count.values()) <= 1
    for s in count:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(count[s]))
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    assert len(sharding.shard(edges, 24).collect()) == len(EDGES) and sharding.shard(edges.limit(0), 24).count() == 0


def test_a_hot_arc_is_ranked_in_buckets_of_its_own_count(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 100)
    ids = [(None, f"t{i}") for i in range(3000)] + [(i, f"t{i}") for i in range(3000)]
    out = sharding.shard(spark.createDataFrame(ids, "doc_id long, text string"), 24)
    rows = out.collect()
    count = Counter(r.shard for r in rows)
    assert len(rows) == 6000 and max(count.values()) - min(count.values()) <= 1
    for s in count:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(count[s]))
    ranked = spark.range(3300).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id") % 100 + 8).cast("int").alias("arc"), F.lit(5).alias("place"), F.col("id").alias("row"))
    sizes = sharding.bucketed(ranked, {7: 3000} | {a: 3 for a in range(8, 108)}).groupBy("arc", "bucket").count().collect()
    assert sum(r["count"] for r in sizes) == 3300 and max(r["count"] for r in sizes) < 200
    assert len(sizes) == 130


def test_a_ring_with_room_moves_few_rows():
    owners = [s for _, s in sharding.ring(24)]
    counts = {a: 50 for a in range(len(owners))}
    total = sum(counts.values())
    for slack in (0.0, 0.25):
        capacity = sharding.capacities(total, 24, slack)
        found = sharding.plan(counts, owners, capacity)
        load = Counter()
        for x in found:
            load[x.shard] += x.last - x.first
        assert sum(load.values()) == total and all(load[s] <= capacity[s] for s in range(24))
    home = sum(x.last - x.first for x in found if x.shard == owners[x.arc])
    assert home > 0.9 * total


def test_words_in_typographic_marks_are_the_same_tokens():
    marks = ['"{}"', "“{}”", "« {} »", "«{}»", "—{}—", "‘{}’", "„{}“", "¡{}!", "…{}…", "{}\u00a0", "🙂{}🙂", "({})", "{}"]
    plain = toxicity.Tokens.of(["und so idiöt sagt er"])
    for mark in marks:
        text = f"und so {mark.format('IDIÖT')} sagt er"
        own = toxicity.Tokens.of([text])
        assert (own.places == plain.places).all(), mark
        raw = text.encode()
        assert raw[own.words.start[2] : own.words.end[2]].decode() == "IDIÖT"


def test_folding_keeps_places():
    text = "ÀÉ Straße “Öde” ЖЩ «ΣΑ» é İx ﬀ 漢字𠀀 naïvé ∑ A_B"
    data = np.frombuffer(text.encode(), np.uint8)
    out = toxicity.folded(data).tobytes().decode()
    assert len(out.encode()) == len(data)
    assert out.split() == "àé straße öde жщ σα é İx ﬀ 漢字𠀀 naïvé a_b".split()
    assert toxicity.folded(np.zeros(0, np.uint8)).size == 0


def test_models_of_empty_tables(spark, edges):
    none, labels = edges.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert langid.identify(none, langid.fitted(none)).count() == 0
    assert quality.score(none, quality.fitted(none, labels)).count() == 0
    assert toxicity.score(none, toxicity.fitted(none, labels)).count() == 0


def test_empty_tables(spark, edges):
    none = edges.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    bench = spark.createDataFrame([], "item_id long, text string")
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for out in (
        neardup.near_duplicates(none), neardup.deduplicated(none), cleaning.clean_lines(none), cleaning.cleaned(none), maintext.main_text(pages),
        licenses.scan(none), decontaminate.contamination(none, bench), decontaminate.clean_documents(none, bench), bpe.encode(none, ranks, public_tokenizers.PATTERN),
    ):
        assert out.count() == 0


def test_pipeline_keeps_clean_and_drops_the_rest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    final = corpus_pipeline.run(spark, SF).collect()
    field = toxicity.fitted(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = toxicity.score(docs, field).filter("predicted = 0").select("doc_id")
    kept = cleaning.clean_lines(docs.join(kept, "doc_id", "left_semi")).filter("kept").select("doc_id", "text").collect()
    sets = {r.doc_id: shingles(r.text) for r in kept}
    left = {d for d, c in components(sets).items() if d == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    known = {r.doc_id: r.text for r in kept if r.doc_id in left}
    assert {r.doc_id for r in final} == {d for d, x in contaminated(known, items).items() if not x[-1]}


def test_contamination_of_long_texts_and_clashing_columns(spark):
    words = [f"w{i % 4999}" for i in range(60_000)]
    passage = [f"p{i}" for i in range(14)]
    rows = [(d, " ".join(words[: 20_000 * d] + passage + words[20_000 * d :]), "x", 1, "h") for d in range(4)]
    df = spark.createDataFrame([*rows, rows[0], (None, rows[0][1], "x", 1, "h")], "doc_id long, text string, words string, width int, hash string")
    items = spark.createDataFrame([("a", " ".join(passage[:12]), 1, "w"), ("b", "w0 w1 w2", 1, "w")], "item_id string, text string, hash int, window string")
    out = decontaminate.contamination(df, items).collect()
    # The cycle of words passes its start every 4,999 words.
    starts = {d: sum(i % 4999 == 0 and i + 2 < 60_000 and not (i < 20_000 * d < i + 3) for i in range(60_000)) for d in range(4)}
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items) for r in out) == sorted(
        (d is None, d or 0, 60_014, 12 + 3 * starts[d or 0], 2) for d in (0, 1, 2, 3, 0, None)
    )
