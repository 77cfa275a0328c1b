"""Main-text extraction from web pages by composite text density.

A tolerant parse gives every DOM node its characters, tags, link characters and link
tags.  The composite density of a node is its characters per tag, adjusted by a
logarithm that falls as links take over.  The node whose children's densities sum
highest is the text's root; the least density on the path from it to the body is the
threshold that a part beside it must reach to be taken along, and below which blocks of
links within it are left out.  Where the root lies in an article or main element, that
element is taken as the text's bounds.

Furniture is left out of the counts and of the text: elements that are never prose, and
elements whose tag, class, id or role names a menu, header, footer, sidebar, notice,
advert, form or reader comments, unless they hold the page's article.

Null pages are empty and an empty page gives an empty text.  Repeated rows stay, null
ids stay null, columns other than page_id, url and html are not read, and an empty
table gives an empty one.  A page is one row's work: nothing is gathered across pages.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from graphloom.llm.common import small_batches

_NODE = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""",
    re.S,
)
_NAMES = re.compile(r"""(?:\A|\s)(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:\A|\s)(?:hidden(?=\s|/|=|\Z)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_WORD = re.compile(r"[a-z]+")

#: The tags of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NEVER_TEXT = frozenset(
    "applet area aside audio button canvas datalist embed fieldset footer form frame frameset head iframe input label legend map menu nav "
    "noscript object option progress script select style svg template textarea title video".split()
)
SELF_CLOSING = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
}
#: Where the search for an open element that a start tag closes ends.
SCOPE = frozenset("html body table ul ol dl div section article main td th blockquote form fieldset".split())
#: Words of class, id and role names that mark furniture.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies "
    "disclaimer disqus dropdown footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notification overlay pager "
    "pagination paywall popup promo promotion recommend recommended related replies reply respond search share sharing sidebar sidebars signup skip "
    "social sponsor sponsored subscribe subscription tags teaser toc toolbar widget widgets".split()
)
ARTICLE = frozenset(["article", "main"])
_PARAGRAPH = frozenset(["p"])
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}


def main_text(html: str) -> str:
    """The page's main text: blocks in page order, one line each."""
    tags, parents, names, chunks = _parse(html)
    n = len(tags)
    has_article = [t in ARTICLE or t == "h1" for t in tags]
    for k in range(n - 1, 0, -1):
        if has_article[k]:
            has_article[parents[k]] = True
    inside = [False] * n
    dropped = [False] * n
    for k in range(1, n):
        up, tag = parents[k], tags[k]
        inside[k] = inside[up] or tags[up] in ARTICLE
        furniture = tag in NEVER_TEXT or (tag == "header" and not inside[k]) or names[k] is None
        if not furniture and names[k]:
            furniture = not FURNITURE.isdisjoint(_WORD.findall(names[k]))
        comments = names[k] and not {"comment", "comments"}.isdisjoint(_WORD.findall(names[k]))
        if furniture and has_article[k] and not comments and tag != "head":
            furniture = False
        dropped[k] = dropped[up] or furniture

    chars, links, marks, link_marks = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for k in range(1, n):
        linked[k] = linked[parents[k]] or tags[k] == "a"
    for node, _, text in chunks:
        if not dropped[node]:
            size = len("".join(text.split()))
            chars[node] += size
            if linked[node]:
                links[node] += size
    for k in range(n - 1, 0, -1):
        if not dropped[k]:
            up = parents[k]
            chars[up] += chars[k]
            links[up] += links[k]
            marks[up] += marks[k] + 1
            link_marks[up] += link_marks[k] + (tags[k] == "a")
    body = next((k for k in range(n) if tags[k] == "body" and not dropped[k]), 0)
    if not chars[body]:
        body = 0
    share = links[body] / chars[body] if chars[body] else 0.0
    density = [0.0 if dropped[k] else _density(chars[k], marks[k], links[k], link_marks[k], share) for k in range(n)]
    sums = [0.0] * n
    for k in range(1, n):
        sums[parents[k]] += density[k]
    below = _below(parents, body)
    root = max((k for k in range(n) if below[k] and not dropped[k] and chars[k]), key=lambda k: sums[k] or density[k] / 2, default=-1)
    if root < 0:
        return ""
    path, k = [root], root
    while k != body and k > 0:
        k = parents[k]
        path.append(k)
    threshold = min(density[k] for k in path)
    # The article around the root, or the root with those beside its path that are as dense.
    whole = next((k for k in reversed(path) if tags[k] in ARTICLE), root)
    on_path = set(path)
    kept = [False] * n
    for k in range(n):
        up = parents[k]
        dense = k not in on_path and up in on_path and density[k] >= threshold and links[k] * 2 < chars[k]
        # Lists of links stay out of the text that they stand in, too, but for words of a sentence.
        furniture = tags[k] in BLOCK and density[k] < threshold and links[k] * 2 >= chars[k] > 0
        kept[k] = not dropped[k] and (k == whole or (k > 0 and kept[up] and not (furniture and k not in on_path)) or (whole == root and below[k] and dense))
    blocks: dict[int, list[str]] = {}
    for node, block, text in chunks:
        if kept[node] or (node in on_path and below[node] and whole == root and not dropped[node]):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def _below(parents: list[int], top: int) -> list[bool]:
    out = [False] * len(parents)
    for k in range(len(parents)):
        out[k] = k == top or (k > 0 and out[parents[k]])
    return out


def _density(chars: int, marks: int, links: int, link_marks: int, body_share: float) -> float:
    """Characters per tag, times a logarithm that shrinks with the share of links."""
    if not chars:
        return 0.0
    per_tag = chars / (marks or 1)
    base = math.log(chars / max(1, chars - links) * links + body_share * chars + math.e)
    inner = chars / (links or 1) * (marks or 1) / (link_marks or 1)
    return max(0.0, per_tag * math.log(max(inner, 1.0)) / math.log(max(base, 1.0 + 1e-9))) if base > 1 else per_tag * math.log(max(inner, 1.0))


class _Open:
    """The open elements: a stack with the places of each name in it, so no search walks the stack."""

    def __init__(self):
        self.nodes, self.names, self.places = [0], ["#root"], {"#root": [0]}

    def push(self, node: int, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.nodes))
        self.nodes.append(node)
        self.names.append(name)

    def cut(self, place: int) -> bool:
        """Close everything from a place on; whether a block was among it.  What is closed is looked at once."""
        block = False
        while len(self.nodes) > place:
            name = self.names.pop()
            self.nodes.pop()
            self.places[name].pop()
            block = block or name in BLOCK
        return block

    def last(self, name: str) -> int:
        held = self.places.get(name)
        return held[-1] if held else -1

    def close(self, closed: frozenset[str]) -> None:
        """Close from the outermost open element of ``closed`` that no other scope is inside of."""
        held = [places for name in closed if (places := self.places.get(name))]
        if held:
            edge = max(self.last(name) for name in SCOPE - closed)
            firsts = [places[k] for places in held if (k := bisect_right(places, edge)) < len(places)]
            if firsts:
                self.cut(min(firsts))


def _parse(html: str):
    """Nodes in document order (parents first), their names, and the text chunks.

    A chunk is (node, block, text); a block number ends where a block-level tag begins
    or ends.  ``names`` holds class, id and role, or None for a hidden element.  The work
    is in proportion to the page, however many elements stay open.
    """
    tags, parents, names = ["#root"], [0], [""]
    chunks: list[tuple[int, int, str]] = []
    stack, block, at = _Open(), 0, 0
    size = len(html)
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            chunks.append((stack.nodes[-1], block, unescape(html[at:])))
            break
        found = _NODE.match(html, lt)
        if lt > at or not found:
            stop = lt if lt > at else lt + 1
            chunks.append((stack.nodes[-1], block, unescape(html[at:stop])))
            at = stop
            continue
        at = found.end()
        slash, name, rest = found[1], found[2], found[3]
        if name is None:
            slash, name, rest = found[4], found[5], found[6]
        if name is None:
            continue
        name = name.lower()
        if slash:
            place = stack.last(name)
            if place > 0:
                block += stack.cut(place)
            continue
        if name == "br":
            chunks.append((stack.nodes[-1], block, " "))
        if name in BLOCK:
            block += 1
            stack.close(_PARAGRAPH)
        if name in SELF_CLOSING:
            stack.close(SELF_CLOSING[name])
        if name in ("html", "body") and stack.last(name) >= 0:
            continue
        if name == "body":
            html_at = stack.last("html")
            stack.cut(max(1, html_at + 1))
        tags.append(name)
        parents.append(stack.nodes[-1])
        if rest and "=" in rest or "hidden" in rest:
            labels = " ".join(m[1] for m in _NAMES.finditer(rest)).lower()
            names.append(None if _HIDDEN.search(rest) else labels)
        else:
            names.append("")
        if name in RAW and not rest.endswith("/"):
            end = _RAW_END[name].search(html, at)
            stop = end.start() if end else size
            if name not in ("script", "style"):
                chunks.append((len(tags) - 1, block, html[at:stop]))
            at = stop
            if end:
                gt = html.find(">", at)
                at = gt + 1 if gt >= 0 else size
        elif name not in VOID and not (rest.endswith("/") and name in ("svg", "path", "iframe")):
            stack.push(len(tags) - 1, name)
    return tags, parents, names, chunks


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) if x else "" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    columns = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    return pages.select(*columns).mapInArrow(run, "page_id long, url string, text string, n_chars long")
