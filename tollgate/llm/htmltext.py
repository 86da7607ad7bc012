"""Main text of web pages by composite text density of the DOM.

The page becomes a tree with implied end tags.  Elements that never hold article text
(scripts, styles, menus, headers outside an article, footers, sidebars, forms, adverts, notices,
comments by readers, ...: by tag, role, or a word of class or id) are taken out.  A word of
class or id never takes out a main or heading element, or an article outside of another one;
nor an element that holds one (``_settle``); words after has, no, with, ... in a layout's name
do not count.  For every node

    density = C/T * log(C/LC * T/LT) / log(ln(C/(C-LC) * LC + LC_body/C_body * C + e))

with C characters, T tags, LC and LT those inside links (a count of 0 stands for 1).  A node's
score is the sum of its children's densities.  The node of the largest score is the main
part; ties go to the outer node.  The threshold is the smallest density on the path from it
to body: a sibling of a node on this path (a headline, a paragraph outside of the
container) joins when it is a heading before it or its own density reaches the threshold; without
a headline so far, the nearest element before it that stayed for its headline joins.  If an
article or main element holds the node, the outermost one is the main part.

Text of block elements is a block: references decoded, white space made one space,
trimmed; blocks are joined by an empty line.

Defined results: null or empty html, and a page without text, give an empty text; a null
page_id or url and repeated rows are passed through; an unclosed comment, script or tag
runs to the end of the page; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import chunked, column

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul xmp".split())
CLOSES_P = BLOCK - {"caption", "dd", "dt", "li", "legend", "tbody", "td", "tfoot", "th", "thead", "tr", "summary", "body", "head", "html"}
SAME_CLOSE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
              "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
SCOPE = frozenset("ul ol dl table select menu article section div main body html td th".split())
DROP = frozenset("nav aside footer form button select dialog object embed canvas audio video menu head svg annotation annotation-xml".split()) | (RAW - {"xmp"})
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
DROP_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
                       "notification alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside footer header masthead topbar "
                       "comment comments reply replies disqus discussion share sharing social related recommended newsletter subscribe subscription signup login "
                       "search pagination pager widget toolbar skip copyright outbrain taboola".split())
#: Of these, words for other texts than the page's own: an article in them counts only if there is none elsewhere.
OTHER_TEXTS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar side aside footer nav navbar navigation "
                        "comment comments reply replies disqus discussion related recommended newsletter widget outbrain taboola".split())
LAYOUT = frozenset("has have no not non with without".split())
SIDE_BY_SIDE = re.compile(r"side[-_]?by[-_]?side", re.I)
HEADINGS = frozenset(("h1", "h2"))
#: Elements that no word takes out, as bits.
HELD = {"article": 1, "main": 2, "h1": 4, "h2": 8, "h3": 16, "h4": 16, "h5": 16, "h6": 16}
MAIN_BITS = 1 | 2 | 4
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "words", "holds", "spared", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, words: frozenset[str] = frozenset()):
        self.tag, self.parent, self.children, self.drop, self.words, self.holds, self.spared = tag, parent, [], drop, words, 0, False


def _drop_words(value: str) -> set[str]:
    """Words of DROP_WORDS in a class or id, without those after a LAYOUT word of the same name."""
    out = set()
    for name in SIDE_BY_SIDE.sub(" ", value).split():
        for w in WORD.findall(name):
            w = w.lower()
            if w in LAYOUT:
                break
            if w in DROP_WORDS:
                out.add(w)
    return out


def _dropped(tag: str, attributes: str, in_article: bool) -> tuple[bool, frozenset[str]]:
    """Whether the element goes by its tag or an attribute; and the words for which it may go (``_settle``)."""
    if tag in DROP or (tag == "header" and not in_article):
        return True, frozenset()
    words: set[str] = set()
    for name, a, b, c in ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, frozenset()
        if name == "role" and value.lower() in DROP_ROLES:
            return True, frozenset()
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True, frozenset()
        if name in ("class", "id"):
            words |= _drop_words(value)
    return False, frozenset(words)


def _settle(root: Node) -> None:
    """Decides on the elements with words of DROP_WORDS, when the whole tree is known.

    An element of HELD stays, but for an article of OTHER_TEXTS inside of another article.  Any other stays if it holds an
    article, main or h1 (a header: any heading); one of OTHER_TEXTS only if there is none of that kind outside of such elements."""
    nodes, inside, other, elsewhere = _walk(root), {}, {}, 0
    if not any(n.words for n in nodes):
        return
    for n in nodes:
        up, foreign = n.parent, not OTHER_TEXTS.isdisjoint(n.words)
        inside[id(n)] = up is not None and (inside[id(up)] or up.tag == "article")
        other[id(n)] = (up is not None and other[id(up)]) or (foreign and (n.tag not in HELD or (n.tag == "article" and inside[id(n)])))
        elsewhere |= 0 if other[id(n)] else HELD.get(n.tag, 0)
    for n in reversed(nodes):
        foreign = not OTHER_TEXTS.isdisjoint(n.words)
        if n.words:
            if n.tag in HELD:
                n.drop = n.tag == "article" and foreign and inside[id(n)]
            elif foreign:
                n.drop = not n.holds & MAIN_BITS & ~elsewhere
            else:
                n.drop = not (n.holds if n.words == {"header"} else n.holds & MAIN_BITS)
            n.spared = not n.drop and n.tag not in HELD
        if not n.drop and n.parent is not None:
            n.parent.holds |= n.holds | (0 if n.tag == "article" and foreign and other[id(n)] else HELD.get(n.tag, 0))


def parse(page: str) -> Node:
    """The page's tree; children are nodes and strings (still with references)."""
    root = Node("html", None)
    node, at, articles = root, 0, 0
    while m := MARKUP.search(page, at):
        if m.start() > at:
            node.children.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            up = node
            while up is not root and up.tag != tag and not (tag == "p" and up.tag in SCOPE):
                up = up.parent
            if up.tag == tag and up is not root:
                node = up.parent
            continue
        if tag in ("html", "body"):
            if tag == "body":
                while node is not root and node.tag in ("head",):
                    node = node.parent
                if node is root:
                    node.children.append(body := Node("body", node))
                    node = body
            continue
        if tag in CLOSES_P:
            up = node
            while up.tag not in SCOPE and up.tag != "p":
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in SAME_CLOSE:
            up = node
            while up.tag not in SAME_CLOSE[tag] and (up.tag not in SCOPE or up.tag in SAME_CLOSE[tag]):
                up = up.parent
            if up.tag in SAME_CLOSE[tag]:
                while up.parent and up.parent.tag in SAME_CLOSE[tag]:
                    up = up.parent
                node = up.parent
        inside = any(True for x in _path(node) if x.tag in ("article", "main")) if tag == "header" else False
        child = Node(tag, node, *_dropped(tag, m[3], inside))
        node.children.append(child)
        if tag in RAW:
            # Inside of svg and math, as in XML, an element may be closed by its own slash.
            if m[3].endswith("/") and any(x.tag in ("svg", "math") for x in _path(node)):
                continue
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            if tag == "xmp":
                child.children.append(references.escape(page[at:end.start() if end else len(page)], quote=False))
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            node = child
    if at < len(page):
        node.children.append(page[at:])
    _settle(root)
    return root


def _path(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _walk(root: Node) -> list[Node]:
    """Kept nodes, parents first; without recursion, so any depth is fine."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        stack.extend(c for c in reversed(n.children) if isinstance(c, Node) and not c.drop)
    return out


def _measure(nodes: list[Node]) -> None:
    for n in nodes:
        n.chars = sum(len(SPACE.sub("", c)) for c in n.children if isinstance(c, str))
        n.tags = n.link_chars = n.link_tags = 0
    for n in reversed(nodes):
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.link_tags + 1
        if n.parent is not None:
            p = n.parent
            p.chars += n.chars
            p.tags += n.tags + 1
            p.link_chars += n.link_chars
            p.link_tags += n.link_tags
    body = nodes[0]
    ratio = body.link_chars / max(1, body.chars)
    for n in nodes:
        c, t, lc, lt = n.chars, max(1, n.tags), max(1, n.link_chars), max(1, n.link_tags)
        base = math.log(c / max(1, c - n.link_chars) * n.link_chars + ratio * c + math.e)
        inner = max(1.0, c / lc * t / lt)
        n.density = c / t * math.log(inner) / math.log(max(base, 1.0) + 1e-9) if base > 1 + 1e-6 else c / t * math.log(inner)
        n.density = n.density if c > n.link_chars else 0.0


def _main_parts(root: Node) -> list[Node]:
    nodes = _walk(root)
    _measure(nodes)
    best, top = None, 0.0
    for n in nodes:
        score = sum(c.density for c in n.children if isinstance(c, Node) and not c.drop) + (n.density if n.tag in BLOCK and n.tag != "body" and n is not root and not any(isinstance(c, Node) and not c.drop for c in n.children) else 0.0)
        if score > top:
            best, top = n, score
    if best is None:
        return [root]
    holder = None
    for n in _path(best):
        if n.tag in ("article", "main"):
            holder = n
    if holder is not None:
        return [holder]
    path = list(_path(best))
    threshold = min(n.density for n in path if n.tag not in ("html",)) if any(n.tag != "html" for n in path) else 0.0
    keep, child, headline = {id(best)}, best, None
    for n in path[1:]:
        seen, near = False, None
        for c in n.children:
            if c is child:
                seen = True
            elif isinstance(c, Node) and not c.drop and (c.density >= threshold > 0 or (not seen and c.tag in HEADINGS and c.chars)):
                keep.add(id(c))
            elif isinstance(c, Node) and not c.drop and not seen and c.spared and c.holds & (4 | 8):
                near = c
        child, headline = n, headline or near
    if headline is not None and not any(x.tag in HEADINGS for n in nodes if id(n) in keep for x in _walk(n)):
        keep.add(id(headline))
    return [n for n in nodes if id(n) in keep]


def _blocks(part: Node) -> list[str]:
    out, run = [], []

    def close() -> None:
        text = SPACE.sub(" ", references.unescape("".join(run))).strip()
        run.clear()
        if text:
            out.append(text)

    stack: list = [part]
    while stack:
        x = stack.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag in BLOCK:
            close()
            stack.append(None)
            stack.extend(c for c in reversed(x.children) if isinstance(c, str) or not c.drop)
        else:
            if x.tag == "br":
                run.append(" ")
            stack.extend(c for c in reversed(x.children) if isinstance(c, str) or not c.drop)
    close()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n\n".join(b for part in _main_parts(parse(page)) for b in _blocks(part))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunked(batches, 512):
        text = [main_text(h) for h in column(b, "html").to_pylist()]
        yield pa.record_batch([column(b, "page_id"), column(b, "url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                              names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
