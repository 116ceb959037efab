"""Main text of web pages by site style trees.

The pages of a host are laid over each other: nodes reached by the same path of tags
with the same class, id and role are one node of the host's style tree. Two things are
measured for each node over all pages of the host that have it:

* presentation: the entropy of the sequences of its children's styles,
* content: the entropy of the text below it.

Divided by the logarithm of the number of those pages, either lies between 0 (the same
on every page) and 1 (different on every page); the larger is the node's importance.
Text below a node determines the text below its descendants, so a node is at least as
varied as what it contains, and removing a node of low importance removes nothing
varied. Such branches are left out of every page of the host, inside an article as
elsewhere, and so are branches whose tag, class, id or role says that they are no content.
Of what is left, an article or main part is preferred where it holds most of the text.

The tree of a host is never held in one place: nodes are counted per host, path and
hash, added up before the shuffle, and a page is only given the paths to leave out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm.text import lower_ascii
from snapmart.session import materialise

# Nodes of less importance are removed, if that share of the host's pages have them, and
# that many, which is the fewest that can be compared.
LOW = 0.2
SHARE = 0.1
MIN_PAGES = 2

# Fixed values of HTML: elements without an end tag, elements whose inside is no markup,
# elements that are not shown as text, and elements that stand within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
UNSEEN = frozenset("head script style textarea title noscript iframe noframes xmp template object svg math "
                   "canvas audio video select datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr br img".split())
# What a start tag closes if it is open in the same list, table or text.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = frozenset("ul ol dl table body article section main div blockquote".split())
# Elements, and words of class, id or role, that stand for something else than the article.
NO_CONTENT = frozenset("nav header footer aside form button menu dialog".split())
NO_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "footer header menu modal nav navbar navigation newsletter notice pagination popup promo promotion related "
    "replies search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
# Words that say nothing of the content when they stand next to one of the above.
FILLERS = frozenset(
    "area bar block body bottom box button buttons container content global group holder inner item items left link "
    "links list main outer page panel post posts right row section site small top unit wrap wrapper".split())
WHOLE_PAGE = frozenset(("html", "body"))

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(
    r"(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[-_0-9]+")


@dataclass
class _Node:
    tag: str
    path: int
    left_out: bool
    article: bool
    main: bool


@dataclass
class Page:
    """Blocks of text in page order, each with the nodes above it, and hashes for all nodes met."""

    blocks: list = field(default_factory=list)  # (text, paths, in article, in main)
    children: dict = field(default_factory=dict)  # path -> hash of the styles below
    content: dict = field(default_factory=dict)  # path -> hash of the text below


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), double or single or bare)
    return found


def _no_content(tag: str, attributes: dict[str, str]) -> bool:
    if tag in NO_CONTENT or tag in UNSEEN:
        return True
    if not attributes or tag in WHOLE_PAGE:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    names = " ".join(attributes.get(k, "") for k in ("class", "id", "role")).lower()
    return any(map(_names_no_content, names.split()))


def _names_no_content(name: str) -> bool:
    """Whether a whole name stands for no content: ``ad``, ``ad-box-2``, but not ``ad-free``."""
    parts = {p for p in _PARTS.split(name) if p}
    return not NO_CONTENT_WORDS.isdisjoint(parts) and parts <= NO_CONTENT_WORDS | FILLERS


def parse(source: str) -> Page:
    """Read a page. Broken markup is read as far as it goes; nothing raises."""
    page = Page()
    root = _Node("", 0, False, False, False)
    stack, held = [root], []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            top = stack[-1]
            page.blocks.append((text, [n.path for n in stack[1:]], top.article, top.main))

    def say(text: str) -> None:
        if not stack[-1].left_out:
            held.append(text)
        for node in stack[1:]:
            page.content[node.path].update(text)

    def close(tag: str, within: frozenset = frozenset()) -> bool:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                del stack[i:]
                return True
            if stack[i].tag in within:
                return False
        return False

    at, size = 0, len(source)
    while at < size:
        found = _TAG.search(source, at)
        end = found.start() if found else size
        if end > at:
            say(unescape(source[at:end]))
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        inline = tag in INLINE
        if not inline and not stack[-1].left_out:
            flush()
        if found[1]:
            close(tag)
            continue
        if tag in VOID:
            if tag == "br" and not stack[-1].left_out:
                held.append(" ")
            continue
        if not inline:
            close("p", LIMITS)  # a paragraph ends where a block begins
        for other in CLOSES.get(tag, ()):
            close(other, LIMITS)
        attributes = _attributes(found[3]) if found[3] else {}
        style = f"{tag}.{attributes.get('class', '')}#{attributes.get('id', '')}@{attributes.get('role', '')}"
        above = stack[-1]
        path = xxhash.xxh64_intdigest(style, seed=above.path & 0xFFFFFFFFFFFFFFFF)
        if above.path in page.children:
            page.children[above.path].update(style)
        page.children.setdefault(path, xxhash.xxh64())
        page.content.setdefault(path, xxhash.xxh64())
        role = attributes.get("role", "")
        stack.append(_Node(
            tag, path, above.left_out or _no_content(tag, attributes),
            above.article or tag == "article", above.main or tag == "main" or role == "main"))
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = closing.end() if closing else size
            stack.pop()
        elif found[3].endswith("/") and tag in UNSEEN:
            stack.pop()
    if not stack[-1].left_out:
        flush()
    return page


def _size(blocks: list) -> int:
    return sum(len(b[0]) for b in blocks)


def kept_blocks(page: Page, low: frozenset = frozenset()) -> list:
    """The blocks of a page's main text.

    Branches in ``low`` are taken away first; if that leaves nothing, or nothing of an
    article or main part that has text, it has met pages that are copies of each other,
    and none is. Of the rest the article's blocks are taken, or else those of the main
    part, where they hold half of the text or more, and else all.
    """
    left = [b for b in page.blocks if low.isdisjoint(b[1])] if low else page.blocks
    marked = any(b[2] or b[3] for b in page.blocks)
    if not left or marked and not any(b[2] or b[3] for b in left):
        left = page.blocks
    for part in (2, 3):
        inside = [b for b in left if b[part]]
        if inside and 2 * _size(inside) >= _size(left):
            return inside
    return left


def main_text(page: Page, low: frozenset = frozenset()) -> str:
    """The kept blocks, joined by empty lines."""
    return "\n\n".join(b[0] for b in kept_blocks(page, low))


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end; A-Z lower-cased; '' without one."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def _signed(values) -> pa.Array:
    return pa.array(np.array(list(values), dtype=np.uint64).view(np.int64))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, children, content = [], [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html")):
            page = parse(source.as_py() or "")
            hosts += [host] * len(page.children)
            paths += page.children
            children += [h.intdigest() for h in page.children.values()]
            content += [h.intdigest() for h in page.content.values()]
        yield pa.RecordBatch.from_pydict({
            "host": pa.array(hosts, pa.string()), "path": _signed(paths),
            "children": _signed(children), "content": _signed(content)})


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, presentation, content, importance) per node of each host's tree.

    Equal nodes are counted before the shuffle, and entropies are added up from counts,
    so a host with most of the pages is spread like any other.
    """
    nodes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(
        _nodes, "host string, path bigint, children bigint, content bigint")

    def entropy(of: str) -> DataFrame:
        counts = nodes_counted.groupBy("host", "path", of).agg(F.sum("n").alias("n"))
        return counts.groupBy("host", "path").agg(
            F.sum("n").alias("pages"),
            (F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")).alias("bits"))

    nodes_counted = materialise(
        nodes.groupBy("host", "path", "children", "content").agg(F.count("*").alias("n")), "style_nodes")
    presentation = entropy("children").withColumnRenamed("bits", "presentation")
    content = entropy("content").select("host", "path", F.col("bits").alias("content"))
    most = F.log("pages")
    return presentation.join(content, ["host", "path"]).withColumn(
        "importance", F.when(F.col("pages") > 1, F.greatest("presentation", "content") / most).otherwise(1.0))


def low_paths(tree: DataFrame, sizes: DataFrame, low: float = LOW, share: float = SHARE,
              min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, low): the paths of each host to leave out; only hosts that have any.

    ``sizes`` (host, of) has the pages of each host. A path is only taken that a share of
    them have, so a host has a few times as many as one page has nodes.
    """
    rare = F.greatest(F.lit(min_pages), F.ceil(F.col("of") * share))
    return tree.join(sizes, "host").filter((F.col("pages") >= rare) & (F.col("importance") < low)).groupBy("host").agg(
        F.sort_array(F.collect_set("path")).alias("low"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mask = (1 << 64) - 1
    for batch in batches:
        texts, removed = [], []
        for source, low in zip(batch.column("html"), batch.column("low")):
            page, paths = parse(source.as_py() or ""), frozenset(path & mask for path in low.as_py() or ())
            texts.append(main_text(page, paths))
            removed.append(sum(not paths.isdisjoint(b[1]) for b in page.blocks))
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id"), "url": batch.column("url"),
            "text": pa.array(texts, pa.string()), "n_low": pa.array(removed, pa.int64())})


def extract(pages: DataFrame, low: float = LOW, share: float = SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars, n_low) for every row of ``pages`` (page_id, url, html).

    ``n_low`` counts the blocks in branches of low importance. A NULL or empty page has
    the empty text. Pages without a host are taken as one host.
    """
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    sizes = keyed.groupBy("host").agg(F.count("*").alias("of"))
    out = materialise(low_paths(style_tree(pages), sizes, low, share, min_pages), "low_paths")
    texts = keyed.join(out, "host", "left").select("page_id", "url", "html", "low").mapInArrow(
        _texts, "page_id bigint, url string, text string, n_low bigint")
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_low")
