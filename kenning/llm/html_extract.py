"""Main text of web pages by tree scoring.

A page is parsed into a tree. Elements that are never content (scripts, forms,
navigation, footers, and those whose class, id or role says advert, menu, comment,
notice ...) are left out; words that may also be a subject (social, promotion, notes)
leave out neither a paragraph, heading, quotation or cell nor a container whose name
says more. Every remaining block with text of its own passes points for its length and
commas to its ancestors, in full to the parent and half as many with every step
further, in one pass from the leaves up; a candidate's points are discounted by its link
density. The article the best container is part of is kept whole; around it, or around
the best container, headings, loose text and everything that is not full of links are
kept, whatever their length (beside an article in the body itself, what scores well and
paragraphs that are sentences); their blocks are the text. The work is linear in the
page, however deep it nests.

Defined results: a null or empty page, or one without any content, has an empty
text; markup that is never closed ends with the page; of containers with equal points
the first in the page is the best; a very long page is parsed whole by its task, with
some hundred bytes an element; rows that repeat are each returned; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
DROP = frozenset("script style head title noscript iframe template nav footer aside form button select option textarea "
                 "input svg canvas object embed applet dialog menu link meta noembed noframes fieldset audio video map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr br".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                     "h6 header hgroup hr main menu nav ol p pre section table ul".split())
# An opening tag that ends an open element of the second set, up to one of the third.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "option": (("option",), ("select",))}
# Words in a class or id: always left out; left out unless the name says something else
# too; left out unless a content word stands beside them; words of layout; content words.
NEVER = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored comment comments disqus replies respond cookie "
                  "cookies consent gdpr nav navbar navigation menu breadcrumb breadcrumbs footer newsletter paywall pagination pager "
                  "toolbar".split())
DOUBTFUL = frozenset("promo promotion share sharing social subscribe subscription signup login".split())
UNLIKELY = frozenset("sidebar aside header masthead banner widget widgets related recommended recommendations notice notices popup "
                     "modal overlay alert tags meta rail search skip hidden".split())
LAYOUT = frozenset("area bar block bottom box button buttons card container group icon icons inner item items left link links list outer "
                   "panel right row section slot top unit wrap wrapper".split())
CONTENT = frozenset("article content main body post entry story text page container wrapper".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that are text themselves, not a place on the page.
PROSE = HEADINGS | frozenset("p li dt dd blockquote pre td th figcaption caption q".split())
# From this share of linked text on, an element beside the content is not part of it.
LINKED = 0.25
TAG_POINTS = {"article": 25, "main": 20, "section": 3, "div": 5, "td": 3, "blockquote": 3, "pre": 3, "form": -3, "ul": -3, "ol": -3,
              "body": 0}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "points", "text", "linked")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children, self.points, self.text, self.linked = [], 0.0, 0, 0


def parse(page: str) -> Node:
    root = here = Node("#root", "", None)
    opened: Counter = Counter()  # tags of the open elements
    at, n = 0, len(page)

    def leave(to):
        """Close the open elements below ``to``."""
        nonlocal here
        while here is not to:
            opened[here.tag] -= 1
            here = here.parent

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            here.children.append(page[at:])
            break
        if m.start() > at:
            here.children.append(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if opened[tag]:
                up = here
                while up.tag != tag:
                    up = up.parent
                leave(up.parent)
            continue
        if tag in CLOSES_P:
            leave(_above(here, opened, ("p",), ("td", "th", "table", "button", "object", "caption")))
        elif tag in ENDS:
            leave(_above(here, opened, *ENDS[tag]))
        attrs = (m[3] if m[2] else m[6]) or ""
        node = Node(tag, attrs, here)
        here.children.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}[^>]*(?:>|\\Z)", re.I).search(page, at)
            node.children.append(page[at:end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID and (not attrs.endswith("/") or tag in INLINE | CLOSES_P):  # "/>" means nothing on these
            here = node
            opened[tag] += 1
    return root


def _above(here, opened, tags, stop):
    """The parent of the nearest open element of ``tags``, or ``here`` if none is open or
    one of ``stop`` comes before it."""
    if not any(opened[t] for t in tags):
        return here
    up = here
    while up.tag not in tags:
        if up.tag in stop:
            return here
        up = up.parent
    return up.parent


def left_out(node: Node, inside: bool) -> bool:
    """Never content? ``inside``: below an article or main element."""
    tag = node.tag
    if tag in DROP or tag == "header" and not inside:
        return True
    if not node.attrs or tag in ("html", "body"):
        return False
    names = []  # the words of each name
    for key, a, b, c in _ATTR.findall(node.attrs):
        key, value = key.lower(), a or b or c
        if key in ("class", "id"):
            names += [{x.lower() for x in _NAME.findall(name)} for name in value.split()]
        elif key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    if not names:
        return False
    words = set().union(*names)
    if tag in ("article", "main"):  # such an element may be a reader's comment, but is otherwise content
        return bool(words & {"comment", "comments"})
    if words & NEVER:
        return True
    if tag in PROSE:
        return False
    known = DOUBTFUL | UNLIKELY | LAYOUT
    return any(x & DOUBTFUL and x <= known for x in names) or bool(words & UNLIKELY) and not words & CONTENT


def _prune(root: Node) -> list[Node]:
    """Drop what is never content; the remaining nodes, parents first."""
    out, stack = [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        out.append(node)
        inside = inside or node.tag in ("article", "main")
        node.children = [c for c in node.children if isinstance(c, str) or not left_out(c, inside)]
        stack += [(c, inside) for c in reversed(node.children) if not isinstance(c, str)]
    return out


def _score(nodes: list[Node]) -> None:
    for node in reversed(nodes):  # children first: text and linked text below each node
        own = "".join(c for c in node.children if isinstance(c, str))
        node.text += len(own.strip())
        if node.tag == "a":
            node.linked = node.text
        if node.parent is not None:
            node.parent.text += node.text
            node.parent.linked += node.linked
    passed: dict[int, float] = {}  # what a block's own text is worth
    below: dict[int, float] = {}  # what reaches a node's parent from below the node
    for node in nodes:
        if node.tag in INLINE or node.tag == "#root":
            continue
        words, stack = [], list(node.children)
        while stack:  # its own text: strings and inline elements
            c = stack.pop()
            if isinstance(c, str):
                words.append(c)
            elif c.tag in INLINE:
                stack += c.children
        own = " ".join("".join(words).split())
        if not own:
            continue
        points = (1 + own.count(",") + min(len(own) / 100, 3)) * (1 - _density(node))
        if node.tag not in PROSE:
            node.points += points  # a container with text of its own
        if node.parent is not None:
            passed[id(node)] = points
    for node in reversed(nodes):  # a parent gets all points, those above it half as many with every step
        up = node.parent
        if up is not None and up.tag != "#root":
            given = passed.get(id(node), 0.0)
            up.points += given + below.get(id(node), 0.0)
            below[id(up)] = below.get(id(up), 0.0) + (given + below.get(id(node), 0.0)) / 2


def _density(node: Node) -> float:
    return node.linked / node.text if node.text else 0.0


def _blocks(tops: list) -> list[str]:
    """``tops``: nodes and strings; None ends a block."""
    out, words = [], []

    def flush():
        text = " ".join(html.unescape("".join(words)).split())
        words.clear()
        if text:
            out.append(text)

    for top in tops:
        stack: list = [top]
        while stack:
            c = stack.pop()
            if c is None:
                flush()
            elif isinstance(c, str):
                words.append(c)
            elif c.tag in ("br", "wbr", "img"):
                words.append(" " if c.tag == "br" else "")
            elif c.tag in INLINE:
                stack += reversed(c.children)
            else:
                flush()
                stack.append(None)
                stack += reversed(c.children)
    flush()
    return out


def _kept(children: list, inner: Node, low) -> tuple[list, list]:
    """What is kept of the siblings before and after ``inner``, in order; ``low``: whether
    an element is. Text and inline elements in a row are judged together."""
    before: list = []
    out, run = before, []

    def end():
        text = sum(len(c.strip()) if isinstance(c, str) else c.text for c in run)
        if text and sum(c.linked for c in run if not isinstance(c, str)) < LINKED * text:
            out.extend([None, *run, None])
        run.clear()

    for c in children:
        if isinstance(c, str) or c.tag in INLINE:
            run.append(c)
            continue
        end()
        if c is inner:
            out = []
        elif c.text and (c.tag in HEADINGS or low(c)):
            out.append(c)
    end()
    return before, out


def _is_sentence(node: Node) -> bool:
    """A paragraph without links that reads as a sentence, and no copyright line."""
    text = " ".join(_blocks([node]))
    return not node.linked and len(text.split()) > 2 and text[-1:] in ".!?…" and not re.match(r"©|\(c\)|copyright\b", text, re.I)


def _around(best: Node, most: float) -> list:
    """What is kept of the page. Where the best container is part of an article, the
    whole article; around it, up to the main element (without an article, up to
    the highest element that is not full of links), all siblings that are not full of
    links, however short. Beside an article or main element in the body itself, only
    what scores well and paragraphs that are sentences."""
    up = [best]
    while up[-1].parent is not None and up[-1].parent.tag not in ("body", "html", "#root"):
        up.append(up[-1].parent)
    marked = [k for k, node in enumerate(up) if node.tag in ("article", "main")]
    articles = [k for k in marked if up[k].tag == "article"]
    at = articles[-1] if articles else 0
    last = marked[-1] if marked else at
    while not marked and last + 1 < len(up) and _density(up[last + 1]) < LINKED:
        last += 1

    def low(c):
        return _density(c) < LINKED

    def well(c):
        return low(c) and (c.tag == "h1" or (c.points + TAG_POINTS.get(c.tag, 0)) * (1 - _density(c)) >= max(10, 0.2 * most)
                           or c.tag == "p" and (c.text > 80 or _is_sentence(c)))

    before, after = [], []
    for node in up[at:last]:
        a, b = _kept(node.parent.children, node, low)
        before.append(a)
        after.append(b)
    top = up[last]
    if not marked or top.parent.tag not in ("body", "html", "#root"):
        a, b = _kept(top.parent.children, top, low)
    else:
        k = next(k for k, c in enumerate(top.parent.children) if c is top)
        a, b = ([x for c in part if not isinstance(c, str) and c.text and well(c) for x in (None, c, None)]
                for part in (top.parent.children[:k], top.parent.children[k + 1:]))
    return [x for part in [a, *reversed(before), [up[at]], *after, b] for x in part]


def main_text(page: str) -> str:
    root = parse(page)
    nodes = _prune(root)
    _score(nodes)
    best, most = None, 0.0
    for node in nodes:
        if node.tag in INLINE or node.tag in ("#root", "html", "p", "li") or not node.text:
            continue
        total = (node.points + TAG_POINTS.get(node.tag, 0)) * (1 - _density(node))
        if total > most:
            best, most = node, total
    if best is None:
        return "\n".join(_blocks([root]))
    tops = _around(best, most)
    return "\n".join(_blocks(tops))


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, ``text``."""
    src = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("h"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([main_text(p or "") for p in b.column(2).to_pylist()], pa.string())],
                ["id", "url", "text"])

    schema = f"id {src.schema['id'].dataType.simpleString()}, url {src.schema['url'].dataType.simpleString()}, text string"
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
