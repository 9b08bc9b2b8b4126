"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into blocks at block-level tags. A block's features are its words and link density
and those of its neighbours, and what its open elements say (inside an article, inside page
furniture, a heading). The tree is grown on the driver from the labelled table below.

Names of classes mislead, so they bind only where they are plain. An element around an article, or
one whose name only holds a telling word among others, no longer counts as furniture once an article
opens in it. Where a page is left without any text, blocks are decided anew by their words and link
density alone, by a tree grown from the same table without what elements say.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody"
    " td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav footer aside form menu dialog search button select fieldset".split())
RAW_TEXT = "script|style|title|textarea"  # without a closing tag these run to the end of the page
RAW = frozenset("template noscript iframe svg math object canvas audio video select button".split())
# Words of class, id and role that name page furniture.
HINTS = frozenset(
    "ad ads adv advert advertisement adverts sponsor sponsored promo promotion banner breadcrumb breadcrumbs comment comments"
    " complementary consent contentinfo cookie cookies disqus footer gdpr header login menu modal nav navbar navigation newsletter"
    " notice notices overlay pager pagination paywall popup related reply respond search share sharing sidebar signup skip social"
    " subscribe subscription teaser toolbar widget masthead alert toc".split()
)
# Words beside which a telling word stays plain.
NEUTRAL = frozenset(
    "area bar bottom block body box col column container content global group inner item items left link links list main mobile outer page"
    " panel primary region right row secondary section site slot text title top unit wrap wrapper zone".split()
)
#: Furniture that may stand around an article.
LOOSE = frozenset("form nav header menu search".split())
#: Words that the second tree must find before a page without text gets one.
LEAST_WORDS = 20
MAIN_HINTS = frozenset("article main content post entry story articlebody".split())

#: name -> position of a block's features
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "inside", "furniture", "heading")

# The labelled table: features in the order above, and 1 for main text.
TABLE = (
    # a nav list, an advert, a footer
    ((1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0), 0), ((2, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), 0), ((12, 0.0, 3, 1.0, 9, 0.0, 0, 1, 0), 0),
    ((7, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0), 0), ((60, 0.0, 30, 0.0, 30, 0.0, 0, 1, 0), 0), ((35, 0.1, 80, 0.0, 10, 0.0, 1, 1, 0), 0),
    ((9, 0.3, 60, 0.0, 50, 0.0, 1, 1, 0), 0), ((4, 0.5, 2, 0.5, 1, 0.0, 0, 1, 1), 0), ((3, 0.0, 80, 0.0, 5, 0.0, 1, 1, 1), 0),
    ((25, 0.0, 5, 0.0, 5, 0.0, 0, 1, 0), 0), ((120, 0.0, 4, 0.0, 90, 0.0, 1, 1, 0), 0), ((1, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0), 0),
    # an article's title, paragraphs, short ones too, list items and quotes with links
    ((8, 0.0, 7, 0.0, 50, 0.0, 1, 0, 1), 1), ((50, 0.0, 8, 0.0, 40, 0.0, 1, 0, 0), 1), ((1, 0.0, 40, 0.0, 60, 0.0, 1, 0, 0), 1),
    ((2, 0.0, 1, 0.0, 0, 0.0, 1, 0, 0), 1), ((30, 0.3, 20, 0.0, 10, 0.1, 1, 0, 0), 1), ((4, 0.0, 8, 0.0, 4, 0.0, 1, 0, 1), 1),
    ((6, 1.0, 50, 0.0, 40, 0.0, 1, 0, 0), 1), ((90, 0.1, 0, 0.0, 0, 0.0, 1, 0, 0), 1), ((3, 0.0, 0, 0.0, 3, 0.0, 1, 0, 0), 1),
    ((1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), 1), ((15, 0.0, 1, 1.0, 7, 0.0, 1, 0, 0), 1),
    # pages without an article element: long text with few links is text, link lists are not
    ((45, 0.0, 3, 1.0, 60, 0.0, 0, 0, 0), 1), ((80, 0.1, 45, 0.0, 4, 0.5, 0, 0, 0), 1), ((25, 0.05, 60, 0.0, 50, 0.0, 0, 0, 0), 1),
    ((5, 0.0, 60, 0.0, 70, 0.0, 0, 0, 0), 1), ((8, 0.0, 3, 1.0, 60, 0.0, 0, 0, 1), 1), ((5, 0.0, 30, 0.0, 45, 0.0, 0, 0, 1), 1),
    ((16, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0), 1), ((14, 0.0, 0, 0.0, 20, 0.0, 0, 0, 0), 1), ((3, 0.0, 50, 0.0, 30, 0.0, 0, 0, 0), 1),
    ((20, 0.0, 30, 0.0, 2, 1.0, 0, 0, 0), 1), ((40, 0.0, 21, 0.0, 3, 1.0, 0, 0, 0), 1), ((7, 0.0, 2, 1.0, 25, 0.0, 0, 0, 1), 1),
    ((20, 0.0, 30, 0.0, 3, 1.0, 1, 0, 0), 1), ((1, 0.0, 4, 0.0, 2, 1.0, 1, 0, 0), 1), ((65, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0), 1),
    ((12, 0.0, 2, 1.0, 0, 0.0, 1, 0, 0), 1), ((9, 0.0, 0, 0.0, 3, 0.9, 1, 0, 1), 1),
    ((5, 0.0, 2, 1.0, 40, 0.0, 0, 0, 1), 1), ((3, 0.0, 2, 1.0, 30, 0.0, 0, 0, 1), 1), ((4, 0.0, 1, 1.0, 22, 0.1, 0, 0, 1), 1),
    ((2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0), 0), ((4, 0.8, 0, 0.0, 3, 1.0, 0, 0, 0), 0), ((6, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0), 0),
    ((18, 0.7, 3, 1.0, 30, 0.0, 0, 0, 0), 0), ((30, 0.9, 50, 0.0, 4, 1.0, 0, 0, 0), 0), ((4, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0), 0),
    ((5, 0.5, 60, 0.0, 0, 0.0, 0, 0, 0), 0), ((3, 0.0, 4, 1.0, 0, 0.0, 0, 0, 0), 0), ((3, 1.0, 60, 0.0, 60, 0.0, 0, 0, 0), 0),
    ((2, 0.0, 1, 1.0, 4, 0.8, 0, 0, 1), 0), ((4, 0.0, 4, 0.0, 3, 1.0, 0, 0, 0), 0),
)


def grow(rows, depth: int = 7):
    """A binary tree (feature, bound, below, above) or a leaf 0 / 1, by the Gini impurity."""
    ones = sum(y for _, y in rows)
    if depth == 0 or ones in (0, len(rows)):
        return int(2 * ones >= len(rows))
    best = None
    # structure first where splits are equally pure
    for f in (7, 6, 1, 0, 4, 2, 5, 3, 8):
        values = sorted({x[f] for x, _ in rows})
        for lo, hi in zip(values, values[1:], strict=False):
            bound = (lo + hi) / 2
            cost = 0.0
            for side in ([y for x, y in rows if x[f] <= bound], [y for x, y in rows if x[f] > bound]):
                p = sum(side) / len(side)
                cost += len(side) * p * (1 - p)
            if best is None or cost < best[0] - 1e-12:
                best = cost, f, bound
    if best is None:
        return int(2 * ones >= len(rows))
    _, f, bound = best
    return f, bound, grow([r for r in rows if r[0][f] <= bound], depth - 1), grow([r for r in rows if r[0][f] > bound], depth - 1)


@cache
def tree():
    return grow(list(TABLE))


@cache
def plain_tree():
    """Grown without what elements say, but for headings.

    Rows that only elements tell apart are left out: furniture without links, an article's links.
    """
    blank = [((*x[:6], 0, 0, x[8]), y) for x, y in TABLE if (x[1] < 0.5 if y else not x[7] or x[1] >= 0.3)]
    return grow(blank)


def decide(node, x) -> int:
    while isinstance(node, tuple):
        f, bound, below, above = node
        node = below if x[f] <= bound else above
    return node


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<text>{RAW_TEXT})(?![\w:-])(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+>(?:.*?</(?P=text)\s*+>|.*\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<attrs>(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|</?[a-z][^<>]*+>|<[!?](?:[^<>]|<(?![!?]))*+>",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role|itemprop|style)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))|\b(hidden|aria-hidden=[\"']?true)", re.I)
_PARTS = re.compile(r"[a-z]+")
_CLOSING = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW}


def _element(name: str, attrs: str, within: bool) -> tuple[int, int, bool]:
    """Whether an element opens main text, whether it opens furniture, and whether that furniture is loose.

    ``within``: it stands inside main text, where a telling word among others tells nothing.
    """
    inside, furniture, loose = int(name in ("article", "main")), int(name in FURNITURE), True
    firm = furniture and name not in LOOSE
    if attrs:
        for m in _ATTR.finditer(attrs):
            if m[5]:
                furniture = firm = 1
                continue
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "style":
                if "display:none" in value.replace(" ", ""):
                    furniture = firm = 1
                continue
            for whole in value.split():
                words = {w for w in _PARTS.findall(whole) if len(w) > 1}
                hints = words & HINTS
                if whole in MAIN_HINTS:
                    inside = 1
                elif hints == {"header"} and words & MAIN_HINTS:
                    continue  # the head of a post holds its title
                elif name not in ("html", "body", "article", "main") and hints:
                    if words <= HINTS | NEUTRAL:
                        furniture = 1
                        firm = firm or not hints <= LOOSE | {"paywall"}
                    elif not within:
                        furniture = 1
    loose = bool(furniture) and not firm
    return inside, furniture, loose


def blocks(page: str) -> list[list]:
    """[text, words, words in links, inside, furniture, heading, firm furniture] of each block that holds text."""
    out: list[list] = []
    text: list[str] = []
    linked = 0
    stack: list[tuple[str, int, int, bool]] = []
    inside = furniture = links = heading = loosely = 0
    opened = Counter()  # names on the stack
    unclosed = set()  # elements of RAW without a closing tag in the rest of the page

    def flush():
        nonlocal linked
        if text:
            # references are read once the block is whole, as tags inside a word do not end it
            words = html.unescape("".join(text)).split()
            if words:
                out.append([" ".join(words), len(words), min(linked, len(words)), inside, furniture, heading, furniture - loosely])
            text.clear()
        linked = 0

    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            piece = page[at : m.start()]
            text.append(piece)
            if links:
                linked += len(piece.split())
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name in RAW and not m["close"]:
            # a self-closed element is empty, and without a closing tag the opening one alone goes
            if not m["attrs"].endswith("/") and name not in unclosed:
                end = _CLOSING[name].search(page, at)
                if end:
                    at = end.end()
                else:
                    unclosed.add(name)
            continue
        block = name in BLOCKS
        if block:
            flush()
        elif name == "br":
            text.append(" ")
        if m["close"]:
            if opened[name]:
                while stack:
                    was, i, f, loose = stack.pop()
                    opened[was] -= 1
                    inside -= i
                    furniture -= f
                    loosely -= loose
                    links -= was == "a"
                    heading -= was in ("h1", "h2", "h3", "h4", "h5", "h6")
                    if was == name:
                        break
        elif name not in VOID and not m["attrs"].endswith("/"):
            if name in ("p", "li", "a", "option", "tr", "td", "th", "dd", "dt") and stack and stack[-1][0] == name:
                was, i, f, loose = stack.pop()
                opened[was] -= 1
                inside, furniture, links, loosely = inside - i, furniture - f, links - (was == "a"), loosely - loose
            i, f, loose = _element(name, m["attrs"], inside > 0)
            if name == "header" and not inside and not f:
                f, loose = 1, True
            if name == "a" and links:
                i = f = 0
                loose = False
            if name in ("article", "main") and loosely and not f:
                # what stands around an article is no furniture from here on
                stack = [(was, k, 0 if free else g, False) for was, k, g, free in stack]
                furniture, loosely = furniture - loosely, 0
            stack.append((name, i, f, loose))
            opened[name] += 1
            inside += i
            furniture += f
            loosely += loose
            links += name == "a"
            heading += name in ("h1", "h2", "h3", "h4", "h5", "h6")
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


def main_text(page: str | None, node) -> str:
    """The main text of a page, blocks joined by one space."""
    if not page:
        return ""
    found = blocks(page)
    density = [b[2] / b[1] for b in found]
    features = []
    for k, b in enumerate(found):
        before = (found[k - 1][1], density[k - 1]) if k else (0, 0.0)
        after = (found[k + 1][1], density[k + 1]) if k + 1 < len(found) else (0, 0.0)
        features.append((b[1], density[k], *before, *after, int(b[3] > 0), int(b[4] > 0), int(b[5] > 0)))
    kept = [b for b, x in zip(found, features, strict=True) if decide(node, x)]
    if not kept and found:
        again = [b for b, x in zip(found, features, strict=True) if not b[6] and decide(plain_tree(), (*x[:6], 0, 0, x[8]))]
        kept = again if sum(b[1] for b in again) >= LEAST_WORDS else []
    return " ".join(b[0] for b in kept)


def _extract(node):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([main_text(x, node) for x in part.column(2).to_pylist()], pa.string())],
                    names=["page", "url", "text"],
                )

    return run


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text (empty if none), n_chars (its code points).

    A null or empty page has no text; a page of plain text is one block.
    """
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page", "url")]
    out = rows.mapInArrow(_extract(tree()), f"page {kinds[0]}, url {kinds[1]}, text string")
    return out.select(F.col("page").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
