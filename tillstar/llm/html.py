"""Main text of web pages, with wrappers inferred from pages of the same host.

1. A page's token stream is balanced into a tree of labelled nodes (tag, class
   and id words) and text tokens.
2. Wrapper inference by union-free regular expressions: the streams of a host's
   pages are aligned one after the other with the wrapper so far.  Equal labels
   align and their contents are aligned in turn; where the streams do not match,
   the surplus part becomes optional, neighbours of one label (or of one short
   run of labels) become a repeated group, and texts that differ become slots.
   A wrapper keeps no page text but hashes, so its size follows the variety of a
   host's templates, not its pages.  Wrappers are folded within each task and
   then merged by host, so a host with any share of the pages reaches the merge
   as one wrapper per task.
3. The wrapper tells the region of a host's main content: the node of article
   kind if there is one, else the deepest node that still holds most of the
   slots' text outside of page furniture.  Inside it, it tells the template from the article:
   - a node whose class or id is a word that may or may not mean furniture
     (``UNSURE``) stays where its slots hold running text, outside of links for the most part;
   - a block, not a heading, that all pages of a host have with the same texts
     (``MANY`` unlike pages or more) while other texts vary is part of the template and goes.
4. Each page's region is read out by these rules: furniture inside it (menus, headers, footers,
   sidebars, notices, adverts, forms, comments, scripts, styles) is left out,
   character references are decoded, blocks are joined by line breaks.  A page
   without its host's region is read by the rules of its own tree.

Of a class or id only whole names count: ``share`` and ``share-buttons`` are furniture words,
``share-price`` is not.  Ids of headings are anchors and never count.
Wrappers of a host are merged in a tree of tasks, ``FAN`` at a time.  Runs of unlike nodes of any length are
aligned by their longest common subsequence.

A null html has the text ''; a null url is a host of its own kind; repeated
rows are read each (a host whose pages are all alike has no slots, so nothing of them is template); texts of any
length are read whole; an empty table gives no rows; other columns are ignored.
Broken markup (open tags at the end, stray ends, cut tags) never fails: what is
open at the end is closed there.  Elements may nest to any depth.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Generator, Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import map_arrow, written

BROADCAST_BYTES = 8 << 20

# Fixed values of HTML: tag kinds.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr", "img", "center",
}
# Tags whose start ends an open one of these (up to the nearest of the given limits).
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
# Page furniture: tags, ARIA roles and words in class or id.
FURNITURE = {
    "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "input", "head", "fieldset",
    "object", "svg", "canvas", "audio", "video", "math", "datalist", "map",
} | RAW
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu",
    "menubar", "toolbar", "note",
}
# Words that mean furniture, words that may, and words that go with either in a name.
SURE = {
    "ad", "ads", "adv", "advert", "advertisement", "advertising", "adverts", "adsense", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer",
    "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notification", "overlay",
    "pager", "pagination", "popup", "promo", "promoted", "promotion", "sharing", "sidebar", "signup", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "topbar",
}
UNSURE = {
    "discussion", "feedback", "form", "header", "legal", "notice", "notices", "recommended", "related", "replies", "reply",
    "respond", "search", "share", "skip", "trending", "widget", "widgets",
}
BESIDE = {
    "area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "container", "global", "group", "holder", "icons",
    "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "module", "outer", "page", "panel",
    "post", "posts", "primary", "right", "row", "secondary", "section", "site", "sticky", "stories", "text", "thread",
    "top", "unit", "wrap", "wrapper",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ARTICLE = {"article", "main"}
# Of these words, those that tell a teaser or a comment from the article itself.
NOT_ARTICLE = {"ad", "ads", "advert", "advertisement", "comment", "comments", "promo", "promoted", "recommended", "related", "reply", "sponsored", "trending", "widget"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|</?[a-zA-Z][^>]*\Z"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
# An attribute: its whole name, then a double-quoted, single-quoted or bare value.  A quote left open ends with the tag.
ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>][^\s>]*)))?""", re.A)
SPLIT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")
# Characters a page's node of an unsure name holds on average to be running text, with slots to go by and without.
RUNNING, RUNNING_ALONE = 60, 200
# Unlike pages of a host from which on texts that never change are taken for its template.
MANY = 4
# Wrappers of a host merged by one task at a time, 4 at least (memory bound only).
FAN = 64


def furniture_word(name: str) -> str:
    """What one class or id name means: "f" (furniture), "m" (it may) or ""."""
    words = {w.lower() for w in SPLIT.split(name) if w and not w.isdigit()}
    known = words & (SURE | UNSURE)
    if not known or words - known - BESIDE:
        return ""
    return "f" if known & SURE else "m"


class Node:
    """An element: its label, whether it is furniture ("f"), may be ("m") or is not, its parts (nodes and texts)."""

    __slots__ = ("tag", "label", "parts", "furniture")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.parts = tag, []
        marks = {"f"} if tag in FURNITURE else set()
        words: list[str] = []
        if attrs:
            for name, a, b, c in ATTR.findall(attrs):
                name, value = name.lower(), a or b or c
                if name == "hidden" and value.lower() != "until-found" or name == "role" and value.lower() in ROLES:
                    marks.add("f")
                elif name in ("class", "id"):
                    # digits in names number the elements: not a part of the label
                    words += [w.lower() for w in SPLIT.split(value) if w and not w.isdigit()]
                    if tag not in ("html", "body", "main", "article") and not (name == "id" and tag in HEADINGS):
                        marks |= set(map(furniture_word, value.split()))
        if tag == "article" and not NOT_ARTICLE.isdisjoint(words):
            marks.add("f")
        self.furniture = "f" if "f" in marks else "m" if "m" in marks else ""
        self.label = tag if not words else tag + "." + ".".join(sorted(set(words)))


class Open:
    """The open elements of a page, with the places of each tag, so that no tag scans the whole of them."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.at: dict[str, list[int]] = {"": [0]}  # places by tag, the nearest last
        self.blocks = [0]  # places of elements that are not inline

    def push(self, node: Node) -> None:
        if node.tag not in INLINE:
            self.blocks.append(len(self.nodes))
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def close(self, i: int) -> None:
        """Ends the element at place ``i`` and all inside it."""
        while len(self.nodes) > i:
            tag = self.nodes.pop().tag
            self.at[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()

    def nearest(self, tag: str) -> int:
        """The place of the nearest open element of a tag, 0 where there is none."""
        places = self.at.get(tag)
        return places[-1] if places else 0

    def end(self, tag: str) -> bool:
        """An end tag; whether it ended an element (an inline end never closes a block)."""
        i = self.nearest(tag)
        if i and (tag not in INLINE or i > self.blocks[-1]):
            self.close(i)
            return True
        return False

    def imply_ends(self, tag: str) -> None:
        """Close what the start of a block closes: an open paragraph, list item, cell, ..."""
        if tag not in CLOSES:
            if self.nodes[self.blocks[-1]].tag == "p":
                self.close(self.blocks[-1])
            return
        ends, limits = CLOSES[tag]
        while i := max(map(self.nearest, ends | limits | {"p"})):
            near = self.nodes[i].tag
            if near in limits:
                break
            self.close(i)
            if near in ends:
                break


def parse(html: str) -> Node:
    """The tree of a page."""
    root = Node("")
    stack = Open(root)
    at = 0
    while m := TOKEN.search(html, at):  # from the end of what was read, so nothing begins inside skipped raw text
        if m.start() > at:
            stack.nodes[-1].parts.append(html[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            if not stack.end(tag) and tag == "p":
                stack.nodes[-1].parts.append(Node("p"))
            continue
        attrs = m["attrs"] if m["tag"] else m["attrs2"]
        if tag not in INLINE and tag not in VOID:
            stack.imply_ends(tag)
        node = Node(tag, attrs)
        stack.nodes[-1].parts.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            raw = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = raw.end() if raw else len(html)
            continue
        stack.push(node)
    if at < len(html):
        stack.nodes[-1].parts.append(html[at:])
    return root


# --- wrappers -----------------------------------------------------------------
# A wrapper node is [label, marks, chars, children, number]: marks of "?" (optional), "+"
# (repeated), "f" (furniture), "m" (perhaps furniture), and how many nodes of pages it stands for.
# A text is ["#", hash or None for a slot, chars, [], number].  The root's first child names up to
# ``MANY`` unlike pages, as children labelled by their texts' hash.
PAGES = "!pages"


# Pages nest to any depth, so steps that go down a tree are generators: each yields
# the steps below it and is sent their results by ``done``, which keeps them on a list.


def done(step: Generator) -> list:
    """The result of a step and of all steps it yields."""
    steps, value = [step], None
    while steps:
        try:
            below = steps[-1].send(value)
        except StopIteration as end:
            steps.pop()
            value = end.value
        else:
            steps.append(below)
            value = None
    return value


def skeleton(node: Node) -> list:
    """The wrapper of one page: its tree with texts as hashes, repeats folded."""
    return done(_skeleton(node))


def _skeleton(node: Node) -> Generator:
    kids = []
    for part in node.parts:
        if isinstance(part, str):
            text = part.strip()
            if text:
                kids.append(["#", text_hash(text), len(text), [], 1])
        elif part.tag not in RAW:
            kids.append((yield _skeleton(part)))
    kids = yield _fold(kids)
    if not node.tag:
        mine = text_hash(dumped([node.label, "", 0, kids, 1]))
        kids = [[PAGES, "f", 0, [[mine, "", 0, [], 1]], 1], *kids]
    return [node.label, node.furniture, 0, kids, 1]


def joined_text(a: list, b: list) -> list:
    return ["#", a[1] if a[1] == b[1] else None, a[2] + b[2], [], a[4] + b[4]]


def _fold(kids: list) -> Generator:
    """Neighbours that repeat (runs of one to three labels) as one repeated group."""
    for period in (1, 2, 3):
        out: list = []
        i = 0
        while i < len(kids):
            labels = [k[0] for k in kids[i : i + period]]
            if len(out) >= period and labels == [k[0] for k in out[-period:]] and (period == 1 or len(set(labels)) > 1):
                for n in range(period):
                    a = out[len(out) - period + n]
                    b = kids[i + n]
                    out[len(out) - period + n] = yield _merged(a, b, repeated=True)
                i += period
            else:
                out.append(kids[i])
                i += 1
        kids = out
    return kids


def merged_node(a: list, b: list, repeated: bool = False) -> list:
    """Two nodes of one label as one that matches both."""
    return done(_merged(a, b, repeated))


def _merged(a: list, b: list, repeated: bool = False) -> Generator:
    if a[0] == "#":
        return joined_text(a, b)
    if a[0] == PAGES:
        unlike = sorted({k[0] for k in a[3] + b[3]})[:MANY]
        return [PAGES, "f", 0, [[name, "", 0, [], 1] for name in unlike], a[4] + b[4]]
    marks = "".join(m for m in "?+fm" if m in a[1] or m in b[1] or (repeated and m == "+"))
    return [a[0], marks, a[2] + b[2], (yield _align(a[3], b[3])), a[4] + b[4]]


def optional(node: list) -> list:
    if node[0] == "#":
        return node
    return [node[0], node[1] if "?" in node[1] else "?" + node[1], *node[2:]]


def _align(a: list, b: list) -> Generator:
    """Two runs of nodes as one: equal labels in order align, the rest becomes optional."""
    i = 0
    while i < len(a) and i < len(b) and a[i][0] == b[i][0]:
        i += 1
    j = 0
    while j < len(a) - i and j < len(b) - i and a[-1 - j][0] == b[-1 - j][0]:
        j += 1
    head, tail = [], []
    for x, y in zip(a[:i], b[:i]):
        head.append((yield _merged(x, y)))
    for x, y in zip(a[len(a) - j :], b[len(b) - j :]):
        tail.append((yield _merged(x, y)))
    x, y = a[i : len(a) - j], b[i : len(b) - j]
    if not x or not y:
        return (yield _fold(head + [optional(n) for n in x + y] + tail))
    middle = []
    p = q = 0
    for i, j in [*common_labels([n[0] for n in x], [n[0] for n in y]), (len(x), len(y))]:
        middle += [optional(n) for n in x[p:i] + y[q:j]]
        if i < len(x):
            middle.append((yield _merged(x[i], y[j])))
        p, q = i + 1, j + 1
    return (yield _fold(head + middle + tail))


def common_labels(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Places (in ``x``, in ``y``) of a longest common subsequence.

    For each length the subsequence that ends first in ``y`` is kept; only pairs of equal labels are looked at.
    """
    places: dict[str, list[int]] = defaultdict(list)
    for j in range(len(y) - 1, -1, -1):
        places[y[j]].append(j)
    ends: list[int] = []
    chains: list[tuple] = []  # (place in x, place in y, the chain before)
    for i, label in enumerate(x):
        for j in places.get(label, ()):  # from the last, so that a label of x is used once
            n = bisect_left(ends, j)
            if n < len(ends) and ends[n] == j:
                continue
            chain = (i, j, chains[n - 1] if n else None)
            if n == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[n], chains[n] = j, chain
    out, chain = [], chains[-1] if chains else None
    while chain:
        out.append(chain[:2])
        chain = chain[2]
    return out[::-1]


def dumped(wrapper: list) -> str:
    """A wrapper as JSON: its nodes in order, each with the number of its children."""
    out, stack = [], [wrapper]
    while stack:
        node = stack.pop()
        out.append([*node[:3], len(node[3]), node[4]])
        stack += reversed(node[3])
    return json.dumps(out, separators=(",", ":"))


def loaded(text: str) -> list:
    """The wrapper of ``dumped``."""
    top: list = []
    stack = [(top, 1)]  # children so far and how many there are
    for label, marks, chars, n, number in json.loads(text):
        while len(stack[-1][0]) == stack[-1][1]:
            stack.pop()
        node = [label, marks, chars, [], number]
        stack[-1][0].append(node)
        stack.append((node[3], n))
    return top[0]


def below(node: list, skip=lambda node: False) -> Iterator[tuple[list, bool]]:
    """Texts below a wrapper node, each with whether it stands in a link."""
    stack = [(node, False)]
    while stack:
        node, link = stack.pop()
        if node[0] == "#":
            yield node, link
        elif not skip(node):
            link = link or node[0].partition(".")[0] == "a"
            stack += [(k, link) for k in reversed(node[3])]


def stays(node: list, slots: bool) -> bool:
    """Whether a node of an unsure name holds running text of the pages."""
    free = linked = 0
    for text, link in below(node, lambda n: "f" in n[1]):
        if not slots or text[1] is None:
            free, linked = (free, linked + text[2]) if link else (free + text[2], linked)
    return free > linked and free >= (RUNNING if slots else RUNNING_ALONE) * node[4]


TOP = 0  # key of a region's node


def key_below(key: int, label: str) -> int:
    """Key of the nodes of a label under a node."""
    return xxhash.xxh64_intdigest(label, key)


class Rules:
    """What a wrapper tells of a host's pages.

    ``path``: labels from the root to the main content.  By key of the node (its labels from there on): ``keep``,
    nodes of an unsure name that stay, and ``constant``, hashes of the texts of template blocks.
    """

    def __init__(self, path: list[str], keep: set[int], constant: dict[int, set[str]]):
        self.path, self.keep, self.constant = path, keep, constant

    def dumped(self) -> str:
        return json.dumps([self.path, sorted(self.keep), {str(k): sorted(v) for k, v in self.constant.items()}])

    @classmethod
    def loaded(cls, text: str) -> Rules:
        path, keep, constant = json.loads(text)
        return cls(path, set(keep), {int(k): set(v) for k, v in constant.items()})


def rules(wrapper: list) -> Rules:
    slots = any(text[1] is None for text, _ in below(wrapper))
    stack = [wrapper]
    unsure = set()
    while stack:
        node = stack.pop()
        if "m" in node[1] and "f" not in node[1]:
            if stays(node, slots):
                unsure.add(id(node))
            else:
                node[1] += "f"
        stack += [k for k in node[3] if k[0] != "#"]
    path = region(wrapper)
    keep, constant = set(), {}
    # the nodes at the path, and those below them with their keys
    here = [wrapper]
    for label in path:
        here = [k for n in here for k in n[3] if k[0] == label and "f" not in k[1]]
    varied = any(t[1] is None for n in here for t, _ in below(n, lambda n: "f" in n[1]))
    many = varied and any(k[0] == PAGES and len(k[3]) >= MANY for k in wrapper[3])
    walk = [(k, key_below(TOP, k[0]), many) for n in here for k in n[3] if k[0] != "#"]
    while walk:
        node, key, always = walk.pop()
        if "f" in node[1]:
            continue
        if id(node) in unsure:
            keep.add(key)
        tag = node[0].partition(".")[0]
        always = always and "?" not in node[1]
        if always and tag not in INLINE and tag not in HEADINGS:
            texts = [t for t, _ in below(node)]
            if texts and all(t[1] is not None and t[4] >= wrapper[4] for t in texts):
                constant.setdefault(key, set()).update(t[1] for t in texts)
                continue
        walk += [(k, key_below(key, k[0]), always) for k in node[3] if k[0] != "#"]
    return Rules(path, keep, constant)


def region(wrapper: list) -> list[str]:
    """Labels from the root to the main content's node ([] for the whole page)."""
    # nodes outside of furniture in page order, parents first: (node, its parent's place, depth)
    order: list[tuple[list, int, int]] = []
    stack = [(wrapper, -1, 0)]
    while stack:
        node, parent, depth = stack.pop()
        if "f" not in node[1]:
            stack += [(k, len(order), depth + 1) for k in reversed(node[3]) if k[0] != "#"]
            order.append((node, parent, depth))

    def weights(constant: bool) -> list[int]:
        """Characters in slots (and in constant texts, if told so) of each node, furniture left out."""
        out = [sum(k[2] for k in node[3] if k[0] == "#" and (constant or k[1] is None)) for node, _, _ in order]
        for i in range(len(order) - 1, 0, -1):
            out[order[i][1]] += out[i]
        return out

    weight = weights(False) if order else []
    if not order or not weight[0]:  # one page, or equal ones: nothing tells slots from the template
        weight = weights(True)

    def path(i: int) -> list[str]:
        out = []
        while i > 0:
            out.append(order[i][0][0])
            i = order[i][1]
        return out[::-1]

    named = [i for i in range(1, len(order)) if order[i][0][0].partition(".")[0] in ARTICLE and weight[i]]
    if named:
        return path(max(named, key=lambda i: (order[i][0][0].startswith("article"), weight[i], -order[i][2])))
    inside: dict[int, list[int]] = defaultdict(list)
    for i in range(1, len(order)):
        if order[i][0][0].partition(".")[0] not in INLINE:
            inside[order[i][1]].append(i)
    at = 0
    while True:
        best = max(inside[at], key=weight.__getitem__, default=None)
        if best is None or "+" in order[best][0][1] or order[best][0][0] == "p" or 5 * weight[best] < 4 * weight[0]:
            return path(at)
        at = best


# --- reading a page -------------------------------------------------------------


def find(node: Node, path: list[str]) -> list[Node]:
    """Nodes at a path of labels, in page order."""
    here = [node]
    for label in path:
        here = [k for n in here for k in n.parts if not isinstance(k, str) and k.label == label and k.furniture != "f"]
    return here


def text_hash(text: str) -> str:
    return f"{xxhash.xxh64_intdigest(text.encode('utf-8', 'surrogatepass')):x}"


def is_template(node: Node, hashes: set[str]) -> bool:
    """Whether the node's texts are all among ``hashes``."""
    stack = [node]
    while stack:
        for part in stack.pop().parts:
            if not isinstance(part, str):
                if part.tag not in RAW:
                    stack.append(part)
            elif (text := part.strip()) and text_hash(text) not in hashes:
                return False
    return True


def blocks(node: Node, rules: Rules) -> Iterator[str]:
    """Texts of the blocks below a node, furniture and template left out."""
    line: list[str] = []
    stack: list = [iter(node.parts)]
    ends: list = [(None, TOP)]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            if ends.pop()[0] and line:
                yield from _line(line)
                line = []
            continue
        if isinstance(part, str):
            line.append(part)
            continue
        if part.tag == "br":
            line.append(" ")
            continue
        key = key_below(ends[-1][1], part.label)
        left_out = part.furniture == "f" or part.furniture == "m" and key not in rules.keep
        if left_out or key in rules.constant and is_template(part, rules.constant[key]):
            if part.tag not in RAW and line:
                yield from _line(line)
                line = []
        else:
            block = part.tag not in INLINE
            if block and line:
                yield from _line(line)
                line = []
            stack.append(iter(part.parts))
            ends.append((block, key))
    yield from _line(line)


def _line(parts: list[str]) -> Iterator[str]:
    text = " ".join(unescape("".join(parts)).split())
    if text:
        yield text


def main_text(html: str | None, of_host: Rules | None) -> str:
    if not html:
        return ""
    root = parse(html)
    nodes = find(root, of_host.path) if of_host else []
    if not nodes:  # not of the host's shape: by its own wrapper
        of_host = rules(skeleton(root))
        nodes = find(root, of_host.path) or [root]
    return "\n".join(b for n in nodes for b in blocks(n, of_host))


def host() -> Column:
    """The host of a page's url, '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper)`` of ``pages (url, html)``: folded in each task, then merged by host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[str, list] = {}
        for batch in batches:
            for name, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = skeleton(parse(html.as_py() or ""))
                held[name] = merged_node(held[name], page) if name in held else page
                if len(held) >= 4096:  # memory bound: what is folded so far goes on to the merge
                    yield {"host": list(held), "wrapper": [dumped(w) for w in held.values()]}
                    held = {}
        yield {"host": list(held), "wrapper": [dumped(w) for w in held.values()]}

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        out = None
        for text in pdf["wrapper"]:
            w = loaded(text)
            out = w if out is None else merged_node(out, w)
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [dumped(out)]})

    kind = "host string, wrapper string"
    folded = written(map_arrow(pages.select(host().alias("host"), "html"), run, kind), "html-folded")
    # a host has at most one wrapper a task (and 4,096 hosts): FAN at a time become one, until one task can take them
    while (most := folded.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > FAN:
        deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-most // (FAN // 2))))
        folded = folded.withColumn("deal", deal).groupBy("host", "deal").applyInPandas(merge, kind)
        folded = written(folded, "html-folded")
    return folded.groupBy("host").applyInPandas(merge, kind)


def regions(wrappers: DataFrame) -> DataFrame:
    """``(host, region)``: the ``Rules`` of each host, as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {"host": batch.column(0), "region": [rules(loaded(w)).dumped() for w in batch.column(1).to_pylist()]}

    return map_arrow(wrappers.select("host", "wrapper"), run, "host string, region string")


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages (page_id, url, html)``."""
    pages = pages.select("page_id", "url", "html")
    found = written(regions(infer_wrappers(pages)), "html-regions")
    size = found.agg(F.sum(F.octet_length("host") + F.octet_length("region") + 64)).first()[0] or 0
    keyed = pages.withColumn("host", host())
    # a host's pages may be a third of all: AQE splits their side where hosts are too many to broadcast
    joined = keyed.join(F.broadcast(found) if size <= broadcast_bytes else found, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known: dict[str, Rules] = {}
        for batch in batches:
            texts = []
            for html, told in zip(batch.column(2), batch.column(3).to_pylist()):
                if told is not None and told not in known:
                    if len(known) >= 4096:  # memory bound only
                        known.clear()
                    known[told] = Rules.loaded(told)
                texts.append(main_text(html.as_py(), known.get(told)))
            yield {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_arrow(
        joined.select("page_id", "url", "html", "region"), run, "page_id bigint, url string, text string, n_chars bigint"
    )
