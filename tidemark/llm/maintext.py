"""Main text of web pages by templates deduced from equivalence classes of tokens over all pages of a host.

A page is a sequence of tokens: block elements, told apart by the role they play (their parent's role, tag and
ordinal among its children of that tag), and whole text blocks under a role. Spark counts every token over all pages of
a host, by layout (the tags of the children of the page's outermost branching element), and combines the vector of
its occurrences into one number, so that tokens with one vector form an equivalence class. A class is valid if it has
``LEAST_CLASS`` tokens and covers ``SUPPORT`` of the layout's pages. Valid classes nest: a token belongs to the template
if its enclosing element does, so each class fills a place between tokens of its parent class; ordinals keep their order. Text
tokens of the template are constant; what else stands in its elements are the slots. From the root the main element is
found by following, as long as it holds ``DOMINANT`` of the text left in slots and leaves no heading behind, the element with most of
it; tags and names play no part in that. The text of its slots, in page order, is the page's.

Pages that share their long blocks count as one, so an article that is repeated on most pages, under other menus, does not become
part of the template. Hosts or layouts with fewer than ``LEAST`` different pages have no template; there markup
decides (``article``, ``main``, else all that is not skipped). Inside the main element, too, menus, forms, reader comments and
the like are skipped by tag or whole class name; an element that holds the article or a top heading never is.

All pages are counted; there is no sample. Tokens are aggregated on the map side by host, layout and token, so a
host with a third of all pages costs each task one row a token. A template has at most as many tokens as a page has, by
``SUPPORT``. The parser is linear in the page.

Character references are decoded, white space within a block becomes one space, blocks are joined by a line feed
(``br`` ends a block).

Defined cases: a null or empty page, or one without an article's text, gives an empty text and n_chars 0. A null
url has no host, and so no template. Broken markup is read as far as it goes: an unclosed tag ends with its parent, a
``<`` without a ``>`` after it is text. Repeated rows and null ids get a row each, and an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import kept, small_side

LEAST, LEAST_CLASS, SUPPORT, DOMINANT = 6, 2, 0.9, 0.6
#: Characters from which a block tells what page this is.
LONG_BLOCK = 80
#: Templates that are broadcast; beyond, the join shuffles.
FEW_TEMPLATES = 5_000

SKIPPED = frozenset("applet aside audio button canvas datalist dialog fieldset footer form frame frameset head iframe input menu nav noscript object option script select style svg template textarea title video".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article blockquote body br caption dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that may be a main element; the others hold a paragraph, an item or a heading.
CONTAINERS = frozenset("article body div html main section table tbody td tr form fieldset".split())
HEADINGS = frozenset(("h1", "h2"))
#: A class name or id is skipped if all its parts are among these, and one is among the first.
TELLING = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr "
    "hidden login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion related replies reply search share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
NEUTRAL = frozenset("area articles bar block bottom box button buttons container form header inner item items left link links list main outer page panel posts primary right secondary section site skip top wrap wrapper".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_MARK = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_MASK = (1 << 64) - 1


def hash64(*parts: str | int) -> int:
    """A signed 64-bit hash that is the same in every process."""
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def telling(label: str) -> bool:
    """Whether a class attribute, id or role names boilerplate as a whole."""
    for name in label.lower().split():
        parts = [p for p in re.split(r"[_-]+", name) if p]
        if any(p in TELLING for p in parts) and all(p in TELLING or p in NEUTRAL for p in parts):
            return True
    return False


@dataclass
class Page:
    """Block elements in order of their beginnings, and text blocks; the blocks of an element are consecutive."""

    tag: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [0])
    role: list[int] = field(default_factory=lambda: [0])
    first: list[int] = field(default_factory=lambda: [0])
    last: list[int] = field(default_factory=lambda: [0])
    skip: list[bool] = field(default_factory=lambda: [False])
    marked: list[bool] = field(default_factory=lambda: [False])
    texts: list[str] = field(default_factory=list)
    node: list[int] = field(default_factory=list)

    def skipped(self) -> tuple[list[bool], list[bool]]:
        """For every block whether it is skipped, and whether it stands in a marked article.

        An element that holds a marked article or a top heading with text is not skipped.
        """
        holds = [False] * len(self.tag)
        for i in range(len(self.tag) - 1, 0, -1):
            if (self.marked[i] or self.tag[i] == "h1" or holds[i]) and self.last[i] > self.first[i]:
                holds[self.parent[i]] = True
        out, article = [False] * len(self.tag), [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            p = self.parent[i]
            article[i] = article[p] or self.marked[i]
            header = self.tag[i] == "header" and not article[p]
            out[i] = out[p] or ((self.skip[i] or header) and not (holds[i] and self.tag[i] not in ("nav", "footer")))
        return [out[n] for n in self.node], [article[n] and not out[n] for n in self.node]


def parse(html: str) -> Page:
    """One pass over the page; every character is looked at a bounded number of times."""
    page, pos, size = Page(), 0, len(html)
    stack: list[tuple[str, int]] = [("", 0)]  # tag and element; inline ones have their block's
    blocks: list[int] = [0]  # places in the stack of block elements
    opened: Counter[str] = Counter()
    ordinals: Counter[tuple[int, str]] = Counter()
    text: list[str] = []
    at, last_end, quotes = 0, html.rfind(">"), True

    def flush() -> None:
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                page.texts.append(joined)
                page.node.append(at)
            text.clear()

    def close(k: int) -> None:
        for name, element in reversed(stack[k:]):
            opened[name] -= 1
        del stack[k:]
        while blocks[-1] >= k:
            page.last[stack_elements.pop()] = len(page.texts)
            blocks.pop()

    stack_elements: list[int] = [0]

    def end_of_tag(start: int) -> int:
        """The ``>`` outside of quotes; once a quote never ends, the next one at all."""
        nonlocal quotes
        if quotes:
            k = start
            while m := _STOP.search(html, k):
                if m[0] == ">":
                    return m.start()
                k = html.find(m[0], m.end()) + 1
                if not k:
                    break
            quotes = False
        return html.find(">", start)

    while pos < size:
        lt = html.find("<", pos)
        if lt < 0 or lt > last_end and not html.startswith("<!--", lt):
            if not text:
                at = stack[-1][1]
            text.append(html[pos:])
            break
        if lt > pos:
            if not text:
                at = stack[-1][1]
            text.append(html[pos:lt])
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            pos = end + 3 if end >= 0 else size
            continue
        closing = html.startswith("</", lt)
        m = _NAME.match(html, lt + 1 + closing)
        if not m:
            if html[lt + 1 : lt + 2] in ("!", "?", "/"):
                pos = html.find(">", lt) + 1
                continue
            if not text:
                at = stack[-1][1]
            text.append("<")
            pos = lt + 1
            continue
        end = end_of_tag(m.end())
        if end < 0:  # not reached while a ">" is left
            pos = size
            continue
        name, attributes, pos = m[0].lower(), html[m.end() : end], end + 1
        block = name in BLOCKS or name in SKIPPED
        if block:
            flush()
        if closing:
            if opened[name]:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                close(k)
            continue
        if name in ("p", "li") and stack[blocks[-1]][0] == name:  # an open one of the same kind ends here
            close(blocks[-1])
        if name in VOID:
            continue
        parent = stack[-1][1]
        opened[name] += 1
        if not block:
            stack.append((name, parent))
            continue
        marks = [a or b or c for a, b, c in _MARK.findall(attributes)] if attributes else []
        skip = name in SKIPPED
        if attributes and not skip and name not in ("html", "body"):
            skip = any(map(telling, marks)) or any(x.lower() in ROLES for x in marks) or bool(_HIDDEN.search(attributes))
        ordinals[parent, name] += 1
        page.tag.append(name)
        page.parent.append(parent)
        page.role.append(hash64(page.role[parent], name, ordinals[parent, name]))
        page.first.append(len(page.texts))
        page.last.append(len(page.texts))
        page.skip.append(skip)
        page.marked.append(name in ("article", "main") or "main" in marks or any("article-body" in x for x in marks))
        element = len(page.tag) - 1
        blocks.append(len(stack))
        stack.append((name, element))
        stack_elements.append(element)
        if name in RAW:
            found = re.compile(rf"</{name}\b", re.IGNORECASE).search(html, pos)
            pos = found.start() if found else size
    flush()
    for element in stack_elements:
        page.last[element] = len(page.texts)
    return page


ELEMENT, CONTAINER, HEADING, TEXT = 1, 2, 3, 0


def tokens(page: Page) -> list[tuple[int, int, int, int, int, int, int]]:
    """``token, parent, kind, chars, count, first, last`` of the page's different tokens; an element's chars are those below it."""
    before = [0]
    for x in page.texts:
        before.append(before[-1] + len(x))
    out = []
    for i in range(1, len(page.tag)):
        a, b = page.first[i], page.last[i]
        kind = CONTAINER if page.tag[i] in CONTAINERS else HEADING if page.tag[i] in HEADINGS else ELEMENT
        if page.tag[i] not in RAW:
            out.append((page.role[i], page.role[page.parent[i]], kind, before[b] - before[a], 1, a, b))
    texts: dict[int, list[int]] = {}
    for token, n, x in zip(text_tokens(page), page.node, page.texts):
        texts.setdefault(token, [page.role[n], len(x), 0])[2] += 1
    return out + [(t, role, TEXT, chars, n, -1, -1) for t, (role, chars, n) in texts.items()]


def text_tokens(page: Page) -> list[int]:
    return [hash64(page.role[n], x) for n, x in zip(page.node, page.texts)]


def layout(page: Page) -> int:
    """The tags of the children of the outermost element that has more than one, outside of the head."""
    children = defaultdict(list)
    for i in range(1, len(page.tag)):
        if page.tag[i] not in RAW and page.tag[i] != "head":
            children[page.parent[i]].append(i)
    own, path = 0, []
    while len(children[own]) == 1:
        own = children[own][0]
        path.append(page.tag[own])
    return hash64("/".join(path), *(page.tag[i] for i in children[own]))


def content(page: Page) -> int:
    """What page this is: its long blocks, or all of them where none is long."""
    return hash64(*([x for x in page.texts if len(x) >= LONG_BLOCK] or page.texts))


@dataclass(frozen=True)
class Template:
    """The role of the main element (0: the page) and the constant text tokens."""

    main: int
    constant: list[int]
    classes: int


def deduced(found: list[dict]) -> Template:
    """The template of tokens (``token, parent, kind, chars, vector``) that cover enough pages of one layout.

    ``chars`` are summed over the pages; those of constant texts leave the elements around them.
    """
    classes = defaultdict(list)
    for t in found:
        classes[t["vector"]].append(t)
    valid = {t["token"]: t for own in classes.values() if len(own) >= LEAST_CLASS for t in own}
    nested = {0: True}

    def inside(token: int) -> bool:
        """Whether the elements around a token are in the template, up to the page."""
        path = []
        while token not in nested:
            path.append(token)
            if token not in valid:
                nested[token] = False
                break
            token = valid[token]["parent"]
        for x in path:
            nested[x] = nested[token] and x in valid
        return nested[path[0]] if path else nested[token]

    template = {k: t for k, t in valid.items() if inside(k)}
    constant = [t for t in template.values() if t["kind"] == TEXT]
    left = {k: t["chars"] for k, t in template.items() if t["kind"] != TEXT}
    for t in constant:
        around = t["parent"]
        while around:
            left[around] -= t["chars"]
            around = template[around]["parent"]
    children = defaultdict(list)
    for k, t in template.items():
        if t["kind"] != TEXT:
            children[t["parent"]].append(k)
    main, total = 0, sum(left[k] for k in children[0])
    while best := max((k for k in children[main] if template[k]["kind"] == CONTAINER), key=lambda k: (left[k], k), default=0):
        headed = any(template[k]["kind"] == HEADING and left[k] for k in children[main])
        if headed or left[best] < DOMINANT * total or not left[best]:
            break
        main, total = best, left[best]
    return Template(main, sorted(t["token"] for t in constant), len({t["vector"] for t in template.values()}))


_TOKENS = "array<struct<token:bigint,parent:bigint,kind:int,chars:int,count:int,first:int,last:int>>"
_BLOCKS = "array<struct<text:string,token:bigint,skipped:boolean,article:boolean>>"


def _lists(rows: list[list[tuple]], names: list[str], kinds: list[pa.DataType]) -> pa.ListArray:
    offsets = [0]
    for row in rows:
        offsets.append(offsets[-1] + len(row))
    flat = [x for row in rows for x in row]
    columns = [pa.array([x[i] for x in flat], kind) for i, kind in enumerate(kinds)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, names=names))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(0, whole.num_rows, 512):
            batch = whole.slice(i, 512)
            layouts, contents, own, blocks = [], [], [], []
            for html in batch.column("html"):
                page = parse(html.as_py() or "")
                layouts.append(layout(page)), contents.append(content(page)), own.append(tokens(page))
                blocks.append(list(zip(page.texts, text_tokens(page), *page.skipped())))
            columns = [batch.column(c) for c in ("page_id", "url", "host")]
            columns += [pa.array(layouts, pa.int64()), pa.array(contents, pa.int64())]
            columns.append(_lists(own, ["token", "parent", "kind", "chars", "count", "first", "last"], [pa.int64(), pa.int64(), *[pa.int32()] * 5]))
            columns.append(_lists(blocks, ["text", "token", "skipped", "article"], [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]))
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "layout", "content", "tokens", "blocks"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, layout, content, tokens, blocks`` and a ``row`` number of every page."""
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    rows = rows.mapInArrow(_parsed, f"page_id {kind}, url string, host string, layout bigint, content bigint, tokens {_TOKENS}, blocks {_BLOCKS}")
    return rows.withColumn("row", F.monotonically_increasing_id())


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [deduced(x) for x in batch.column("found").to_pylist()]
        columns = [batch.column("host"), batch.column("layout"), pa.array([x.main for x in found], pa.int64()), pa.array([x.constant for x in found], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "layout", "main", "constant"])


def templates(rows: DataFrame) -> DataFrame:
    """``host, layout, main, constant`` of the layouts with enough different pages, from :func:`parsed` rows."""
    named = rows.filter("host is not null and size(blocks) > 0")
    # One page of each content stands for all that share it.
    first = named.groupBy("host", "layout", "content").agg(F.min("row").alias("row"), F.count("*").alias("n"))
    others = named.select("host", "layout", "content", "row").join(first.filter("n > 1").drop("n").withColumnRenamed("row", "_row"), ["host", "layout", "content"])
    others = kept(others.filter("row <> _row").select("row"), "repeated")
    sizes = first.groupBy("host", "layout").agg(F.count("*").alias("pages")).filter(F.col("pages") >= LEAST)
    single = named.join(small_side(others), "row", "left_anti")
    each = single.select("host", "layout", "content", F.explode("tokens").alias("t"))
    vector = F.bit_xor(F.xxhash64("content", "t.count")).alias("vector")
    counted = each.groupBy("host", "layout", "t.token").agg(
        F.count("*").alias("n"), vector, F.sum("t.chars").alias("chars"), F.first("t.parent").alias("parent"), F.first("t.kind").alias("kind")
    )
    # A page has a bounded number of tokens, and so has a layout of those that SUPPORT of its pages have.
    frequent = counted.filter(F.col("n") >= LEAST * SUPPORT).join(sizes, ["host", "layout"]).filter(F.col("n") >= SUPPORT * F.col("pages"))
    found = frequent.groupBy("host", "layout").agg(F.collect_list(F.struct("token", "parent", "kind", "chars", "vector")).alias("found"))
    return found.mapInArrow(_chosen, "host string, layout bigint, main bigint, constant array<bigint>")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    rows = kept(parsed(pages), "pages")
    found = small_side(kept(templates(rows), "templates"), FEW_TEMPLATES)
    rows = rows.join(found, ["host", "layout"], "left")
    main = F.get(F.filter("tokens", lambda t: (t["kind"] != TEXT) & (t["token"] == F.col("main"))), F.lit(0))
    rows = rows.withColumn("main", F.when(F.col("main") == 0, F.struct(F.lit(0).alias("first"), F.size("blocks").alias("last"))).otherwise(F.struct(main["first"].alias("first"), main["last"].alias("last"))))
    inside = F.slice("blocks", F.col("main.first") + 1, F.col("main.last") - F.col("main.first"))
    slots = F.filter(inside, lambda b: ~b["skipped"] & ~F.array_contains("constant", b["token"]))
    marked, open_ = F.filter("blocks", lambda b: b["article"]), F.filter("blocks", lambda b: ~b["skipped"])
    chosen = F.when(F.col("main.first").isNotNull(), slots).when(F.size(marked) > 0, marked).otherwise(open_)
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), "\n")
    return rows.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
