"""Operator 8: main text of web pages by a site style tree.

Each page is parsed once into blocks (text between block-level tags, in page order). What
HTML itself marks as no article text is left out at once: scripts, styles, forms, menus,
headers, footers, asides, and branches of which a class, id or role names an advert, a notice, a
sidebar, reader comments and the like: a whole name (``NAMES``), or one made of such words and of
words that say nothing by themselves (``BESIDE``), as in "cookie-banner" or "site-footer"; "has-sidebar"
or "comments-open" name no such branch. An outermost ``article`` or ``main`` is never ruled out by its name,
and the header of an article keeps its headings. Where names would leave nothing of a page, they
are not heeded. If a page has an ``article`` or ``main`` element, only
blocks inside it remain. What is still undecided are the blocks in generic branches (``div``,
``section``, lists, tables ...) below the article or, without one, below the body.

For these the pages of a host are merged into one style tree: a branch is a path of tags
(with class and id, and the place among siblings alike in these) from the root, its style on a
page the sequence of tags below it, and its content the texts of its blocks. With m distinct pages of the host and 1 - sum of p log_m p
terms:

* presentation importance: the entropy (base m) of the branch's styles over its pages;
* content importance: 1 - the mean over its texts of log_m(pages that hold the text).

A branch whose importance, the mean of both weighted by ``PRESENTATION_WEIGHT``, is below
``LOW`` looks and reads alike on nearly all pages and is removed from each of them. Only branches
on ``MIN_PAGES`` pages or more are judged: fewer say nothing about a template. Pages of a host
with the same sequence of blocks count as one page, as copies of one article look and read
alike without being a template. On pages where no ``article`` or ``main`` element decides, a
single text block is a content node of the tree too: known by its path without places and its
text, it always looks alike, so its importance is (1 - ``PRESENTATION_WEIGHT``) * (1 - log_m k)
with k of the m pages that hold it, and it goes if that is below ``LOW`` and more than half of
these pages hold it. Text blocks that stand directly in an article are content by definition
and are never judged.

Text: character references are decoded, white space inside a block becomes one space, blocks
are trimmed and joined by one newline. Defined results: null or empty html gives the empty
text; a null URL or one without a host puts the page in a host of its own name ''; unclosed
tags end where HTML ends them; repeated pages give repeated rows.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import by_batch, materialise, table

LOW = 0.2
MIN_PAGES = 5
PRESENTATION_WEIGHT = 0.3

# HTML elements by their role here.
RAW = frozenset("script style textarea title noscript iframe template svg math object canvas audio video select option datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head nav header footer aside form button fieldset dialog menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = frozenset("article main".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr li main menu nav ol p pre section summary table caption thead tbody tfoot tr td th ul".split())
GENERIC = frozenset("div section ul ol dl table details figure center dir".split())
#: A start tag of the key ends an open element of the value (unless a barrier stands between).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIERS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
#: Words of a class, id or role that name a branch without article text.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs"
    " header masthead footer colophon sidebar aside complementary contentinfo search notice notices alert cookie cookies consent gdpr popup modal"
    " overlay newsletter subscribe subscription signup login social share sharing related recommended comment comments disqus respond replies"
    " widget widgets toolbar pagination pager".split())

#: Words that may stand beside them in a compound name.
BESIDE = frozenset(
    "site page post posts user reader list box area wrap wrapper container section block bar inner outer top bottom left right links buttons item items"
    " global primary secondary".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORDS = re.compile(r"[a-z]+")
HEAD_TAGS = frozenset("meta title link style script base noscript template".split())


def marks(attributes: str) -> tuple[str, bool]:
    """(class and id as written, whether they name a branch without article text)."""
    names, hidden = [], False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "")
        hidden |= key == "hidden"
        if key != "hidden":
            names.append(value.lower())
    tokens = " ".join(names).split()
    return ".".join(tokens), hidden or any(no_text(t) for t in tokens)


def no_text(name: str) -> bool:
    """Whether a class, id or role names a branch without article text."""
    words = WORDS.findall(name)
    return name in NAMES or (any(w in NAMES for w in words) and all(w in NAMES or w in BESIDE for w in words))


def parse(html: str) -> list[tuple[str, str, str, bool]]:
    """``find_blocks`` by names, and without them where they would leave nothing."""
    return find_blocks(html, True) or find_blocks(html, False)


def find_blocks(html: str, by_name: bool) -> list[tuple[str, str, str, bool]]:
    """(text, branch, style, free) of the blocks that tags alone do not rule out. branch: path of
    the innermost generic element that holds the block, '' if it stands in the article itself;
    style: the tags from there down to the block; free: no article or main element decided."""
    blocks: list[tuple[str, str, str, bool]] = []
    # tag, path, out (0 no, 1 but for headings, 2 wholly), inside a root, branch, style, number of children by tag, class and id
    stack: list[tuple[str, str, int, bool, str, str, dict[str, int]]] = []
    top: dict[str, int] = {}
    parts: list[str] = []

    def state():
        return stack[-1] if stack else ("", "", 0, False, "", "", top)

    def end_block():
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            _, _, _, inside, branch, style, _ = state()
            if text:
                blocks.append((text, branch, style, inside))

    def pop_to(k: int):
        end_block()
        del stack[k:]

    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        stop = m.start() if m else n
        if stop > at and not state()[2]:
            parts.append(html[at:stop])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag in BLOCK or any(s[0] in BLOCK for s in stack[k:]) or stack[k][2] != state()[2]:
                        pop_to(k)
                    else:
                        del stack[k:]
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
            at = close.end() if close and not m[3].endswith("/") else (at if m[3].endswith("/") else n)
            continue
        if tag in VOID:
            if tag == "hr":
                end_block()
            elif not state()[2]:
                parts.append(" ")
            continue
        if tag in BLOCK:
            end_block()
            for k in range(len(stack) - 1, -1, -1):      # an open paragraph ends at any block
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK:
                    break
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ENDS.get(tag, ()):
                    del stack[k:]
                    break
                if stack[k][0] in BARRIERS.get(tag, ()):
                    break
        if tag not in HEAD_TAGS and stack and stack[-1][0] == "head":
            pop_to(len(stack) - 1)                        # a head without end tag ends at the body
        _, path, out, inside, branch, style, children = state()
        label, named = marks(m[3])
        kind = tag + (f".{label}" if label else "")
        place = children[kind] = children.get(kind, 0) + 1
        node = f"{path}/{kind}" + (f"[{place}]" if place > 1 else "")
        own_header = tag == "header" and inside
        spared = tag in ("html", "body") or own_header or (tag in ROOTS and not inside)
        if own_header:
            out = out or 1
        elif tag in NEVER or (named and by_name and not spared):
            out = 2
        elif tag in HEADINGS and out == 1:
            out = 0
        if m[3].endswith("/") and tag not in BLOCK:
            continue
        if out and not state()[2]:
            end_block()
        if tag in ROOTS:
            inside, branch, style = True, "", ""
        elif tag in GENERIC:
            branch, style = node, ""
        elif tag in BLOCK:
            style = f"{style}/{tag}"
        if not inside and not branch:
            branch = node
        stack.append((tag, node, out, inside, branch, style, {}))
    if not state()[2]:
        end_block()
    free = not any(b[3] for b in blocks)
    return [(*b[:3], free) for b in blocks if free or b[3]]


def page_blocks(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, host, blocks array<struct<text, branch, style, free>>), one row per page."""
    kind = pages.schema[id_col].dataType.simpleString()
    block = pa.struct([("text", pa.string()), ("branch", pa.string()), ("style", pa.string()), ("free", pa.bool_())])

    def make():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [[dict(zip(("text", "branch", "style", "free"), x, strict=True)) for x in parse(h)] for h in b.column(3).to_pylist()]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(found, pa.list_(block))], names=["id", "url", "host", "blocks"])

        return work

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), host.alias("host"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    return by_batch(rows, f"id {kind}, url string, host string, blocks array<struct<text:string,branch:string,style:string,free:boolean>>", make)


def leaf(block: Column) -> Column:
    """Key of a text block as a node of its own; unlike a branch, it does not start with a slash."""
    path = F.regexp_replace(F.concat(block["branch"], F.lit(" "), block["style"]), r"\[\d+\]", "")
    return F.concat(F.lit("#"), F.xxhash64(path, block["text"]).cast("string"))


def low_nodes(blocks: DataFrame) -> DataFrame:
    """(host, low array<string>): the branches and text blocks (by ``leaf``) of low importance,
    for hosts that have any.

    All steps are grouped counts. A page stands for all its copies: it is known by the digest
    of its blocks, not by its id. The array holds a host's template nodes only: each is on
    ``MIN_PAGES`` distinct pages or more and nearly alike on them."""
    pages = blocks.select("host", F.xxhash64("blocks").alias("page"), "blocks")
    size = pages.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("m"))
    undecided = pages.select("page", "host", F.posexplode(F.filter("blocks", lambda b: b["branch"] != "")).alias("at", "b"))
    rows = undecided.select("page", "host", "at", F.col("b.branch").alias("branch"), F.col("b.style").alias("style"), F.xxhash64("b.text").alias("text"))
    per_page = rows.groupBy("host", "branch", "page").agg(F.array_sort(F.collect_set(F.struct("at", "style"))).alias("s")).select(
        "host", "branch", F.xxhash64(F.transform("s", lambda x: x["style"])).alias("style"))    # a set, as copies of the page repeat it
    styles = per_page.groupBy("host", "branch", "style").agg(F.count(F.lit(1)).cast("double").alias("c"))
    shape = styles.groupBy("host", "branch").agg(F.sum("c").alias("pages"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
    texts = rows.groupBy("host", "branch", "text", "page").agg(F.lit(1).alias("one")).groupBy("host", "branch", "text").agg(F.count(F.lit(1)).cast("double").alias("k"))
    same = texts.groupBy("host", "branch").agg(F.avg(F.log("k")).alias("logk"))
    j = shape.filter(F.col("pages") >= MIN_PAGES).join(same, ["host", "branch"]).join(size, "host")
    entropy = F.log("pages") - F.col("clogc") / F.col("pages")
    looks, reads = entropy / F.log("m"), 1 - F.col("logk") / F.log("pages")
    importance = PRESENTATION_WEIGHT * looks + (1 - PRESENTATION_WEIGHT) * reads
    branches = j.filter(importance < LOW).select("host", F.col("branch").alias("node"))
    free = pages.filter(F.exists("blocks", lambda b: b["free"])).select("host", "page", F.array_distinct(F.transform("blocks", leaf)).alias("leaves"))
    of = free.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("m"))
    held = free.select("host", "page", F.explode("leaves").alias("node")).distinct().groupBy("host", "node").agg(F.count(F.lit(1)).cast("double").alias("k"))
    held = held.filter(F.col("k") >= MIN_PAGES).join(of, "host")
    alike = (1 - PRESENTATION_WEIGHT) * (1 - F.log("k") / F.log("m")) < LOW
    leaves = held.filter(alike & (2 * F.col("k") > F.col("m"))).select("host", "node")
    return branches.unionByName(leaves).groupBy("host").agg(F.collect_list("node").alias("low"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars), one row per page."""
    blocks = materialise(page_blocks(pages, id_col, url_col, html_col), "blocks")
    low = materialise(low_nodes(blocks), "low").select(F.col("host").alias("_h"), "low")
    gone = lambda b: F.array_contains("low", b["branch"]) | (b["free"] & F.array_contains("low", leaf(b)))
    kept = F.filter("blocks", lambda b: (b["branch"] == "") | ~F.coalesce(F.col("low").isNotNull() & gone(b), F.lit(False)))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    j = blocks.join(low, F.col("host") == F.col("_h"), "left").select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"))
    return j.withColumn("n_chars", F.length("text").cast("long"))


def op8_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
