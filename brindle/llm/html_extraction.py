"""Main text of web pages by wrapper induction.

Pages become trees of block elements. One page of each host, of the least hash,
is its reference. Every page is aligned with it as a whole by simple tree matching:
the order-preserving alignment of siblings of equal labels (tag and class names)
with the most matched nodes, an equal text counting as one more. What the pages of
a host have at a node of the reference is then added up: pages, the least and
greatest hash of the node's own text, its characters and those within links. From
these sums a template is induced:

* a node is constant if its text is one and the same on ``MIN_PAGES`` pages or more
  and, where it is one of several siblings of its label, on ``MIN_SHARE`` of the
  pages that have its parent (the last places of long sequences are filled by few);
* outside articles, a node below which ``MENU`` of all characters are links is a menu;
* all other nodes, and those that the reference lacks, are slots: content.

What a page declares is a weight beside that. Names of an element are judged
together. Some words (and elements such as ``nav``) always tell boilerplate, which
varies from page to page and so cannot be constant; others ("search", "related")
do unless the template finds most of the host's varying text there. ``article`` and
``main`` are taken for the content unless the template finds more varying text of
the host outside of them than inside. A later, much shorter article is a teaser,
and articles within an article are comments, unless they make up nearly all of it.
If constants or menus are all that is left, they stay: a host may show one article
only.

Sums, minima and maxima combine on the map side and in any order, so a host with
a third of all pages costs a row per node and batch, and results do not depend on
how pages are dealt. The least hash is found without moving pages. References, and
templates, are broadcast only after their total size has been found to be within
``MAX_BROADCAST``; beyond it they are joined by host. Pages whose trees and texts
shared with the reference are equal are aligned once. Pairs of unlike subtrees are
scored together, height by height, in arrays; two long sequences of siblings are
aligned row by row, beyond ``CELLS`` pairs by halves, with equal scores. Nothing is
cut off, at any depth; memory grows with the pairs of unlike subtrees that siblings
of one label have.

Defined results: null or empty html gives an empty text; pages without a host
have no template; white space inside a block becomes one space, ``br`` counts as
white space, blocks are joined by one line feed; text outside any element is a
block; unclosed and misnested tags are closed as browsers do; after a tag whose
quotes never end, tags end at the next ``>``; very long and deep pages are taken
whole, in linear time but for the alignment; ties of alignment go to the later
siblings; repeated rows are all extracted; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import Column, DataFrame

from brindle.llm.common import appended, dropped, in_small_batches, let_go, pieces, shaped, staged

MIN_PAGES = 5
#: Share of the pages that must hold a constant which is one of several siblings of its label.
MIN_SHARE = 0.8
#: Share of characters within links that makes a menu.
MENU = 0.9
#: Pairs of siblings that one alignment keeps scores of.
CELLS = 1 << 22
#: Bytes of references or templates that are broadcast, and of those that a worker keeps parsed.
MAX_BROADCAST, MAX_KEPT = 16 << 20, 16 << 20
#: Pairs of nodes that a template keeps of alignments that it has made.
MAX_PAIRS = 200_000

#: Element and class names that decide what a part of a page is. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
LEFT_OUT = frozenset("aside audio button canvas datalist dialog fieldset footer form frameset head input iframe map menu nav noembed noframes noscript object option script select style svg template textarea title video".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
STRONG = frozenset("ads adsbygoogle advert adverts advertisement advertising breadcrumb breadcrumbs comment comments disqus gdpr newsletter sponsored".split())
SOFT = frozenset("notice notices popup promo promotion promotions related search widget widgets".split())
BOILERPLATE = STRONG | SOFT | frozenset(
    "ad banner consent cookie cookies disclaimer footer login masthead menu menus modal nav navbar navigation pager pagination replies reply respond share sharing sidebar sidebars signup skip social sponsor subscribe subscription teaser teasers toolbar topbar".split()
)
POSITIVE = frozenset("article body content entry main story text".split())
LAYOUT = frozenset("has is no not with without".split())
HEADERS = frozenset("header page-header site-header siteheader".split())
NEUTRAL = frozenset(
    "area article articles author bar block body bottom box button buttons column container content fixed form group header holder icons info inner item items law left link links list main media mobile module outer overlay page panel policy post posts primary reader right row secondary section site slot stories text this title tools top unit user wrap wrapper".split()
)
KEEP_WHOLE = frozenset("html body main".split())
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "thead": ("table",), "tbody": ("table",), "tfoot": ("table",)}
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "thead": ("tr", "td", "th", "tbody"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "thead", "tbody")}

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)(?:([^>"']*+)>)?|<!--.*?(?:--!?>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[^\s]+")
_PART = re.compile(r"[-_]+")


class Node:
    """A block element: label, whether it is declared boilerplate (2: surely), strings and nodes in order, characters and those within links."""

    __slots__ = ("tag", "label", "out", "kids", "inline", "number", "chars", "links")

    def __init__(self, tag: str, label: str, out: int, inline: bool = False):
        self.tag, self.label, self.out, self.inline = tag, label, out, inline
        self.kids: list = []
        self.number, self.chars, self.links = -1, 0, 0


def _boilerplate(tag: str, names: list[str], inside: bool) -> int:
    """What an element's classes and id say together: 2 where a word or all words do, 1 where the template may overrule it."""
    if any(n in HEADERS for n in names):
        return 0 if inside else 2
    if tag == "article":
        return 2 if any(n in BOILERPLATE for n in names) else 0
    parts = {p for n in names for p in _PART.split(n) if p and not p.isdigit()}
    found = parts & BOILERPLATE
    if not found or parts & LAYOUT:
        return 0
    if found & STRONG:
        return 2
    if not parts <= BOILERPLATE | NEUTRAL:
        return 0
    if found <= SOFT:
        return 0 if len(names) > 1 and any(n in POSITIVE for n in names) else 1
    return 2


def _declared(tag: str, attributes: str, inside: bool) -> tuple[str, int]:
    """Label and verdict of an element from its tag and attributes; ``inside``: within an article or main."""
    out = 2 if tag in LEFT_OUT or (tag == "header" and not inside) else 0
    if "=" not in attributes and "hidden" not in attributes:
        return tag, out
    classes, names = "", []
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            names += value.lower().split()
            if name == "class":
                classes = ".".join(sorted(set(value.lower().split())))
        elif name == "role":
            out = 2 if value.lower() in ROLES else out
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            out = 2
    if names and tag not in KEEP_WHOLE:
        out = max(out, _boilerplate(tag, names, inside))
    return f"{tag}.{classes}" if classes else tag, out


class _Open:
    """The open elements, with the places of each tag, so that no end tag has to search for its start."""

    def __init__(self, root: Node):
        self.stack: list[tuple[str, Node]] = [("", root)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]
        self.walls: list[int] = [0]
        self.inside = 0

    def push(self, tag: str, node: Node) -> None:
        at = len(self.stack)
        self.stack.append((tag, node))
        self.places.setdefault(tag, []).append(at)
        if tag not in INLINE:
            self.blocks.append(at)
            if tag in ("article", "main", "body", "table", "td"):
                self.walls.append(at)
                self.inside += tag in ("article", "main")

    def close(self, at: int) -> None:
        """Ends the elements from the place ``at`` on."""
        while len(self.stack) > at:
            tag, _ = self.stack.pop()
            k = self.places[tag].pop()
            if self.blocks[-1] == k:
                self.blocks.pop()
            if self.walls[-1] == k:
                self.walls.pop()
                self.inside -= tag in ("article", "main")

    def end(self, tag: str) -> None:
        places = self.places.get(tag)
        if places and (tag not in INLINE or places[-1] > self.walls[-1]):
            self.close(places[-1])

    def begin(self, tag: str) -> None:
        """Ends what the start of ``tag`` ends."""
        if tag in CLOSES_P and self.stack[self.blocks[-1]][0] == "p":
            self.close(self.blocks[-1])
        if tag in ENDS:
            within = max((self.places[t][-1] for t in SAME[tag] if self.places.get(t)), default=0)
            ended = [p[k] for t in ENDS[tag] if (p := self.places.get(t)) and (k := bisect_right(p, within)) < len(p)]
            if ended:
                self.close(min(ended))


def parse(html: str) -> Node:
    """The tree of block elements of a page."""
    root = Node("", "", 0)
    open_ = _Open(root)
    at, n = 0, len(html)
    quotes = True

    def text(s: str) -> None:
        if s:
            node = open_.stack[-1][1]
            s = entities.unescape(s) if "&" in s else s
            node.kids.append(s)
            size = len(s.strip())
            node.chars += size
            if open_.places.get("a"):
                node.links += size

    def tag_end(i: int) -> tuple[int, int]:
        """Where the attributes that begin at ``i`` end, and what follows the tag."""
        nonlocal quotes
        k = i
        while quotes:
            m = _STOP.search(html, k)
            if m is not None and m[0] == ">":
                return m.start(), m.end()
            k = html.find(m[0], m.end()) + 1 if m is not None else 0
            quotes = k > 0
        k = html.find(">", i)
        return (k, k + 1) if k >= 0 else (n, n)

    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        attributes = m[3]
        if attributes is None:
            stop, after = tag_end(at)
            attributes, at = html[at:stop], after
        if m[1]:
            open_.end(tag)
            continue
        if tag == "br" or tag == "wbr":
            text(" " if tag == "br" else "")
            continue
        open_.begin(tag)
        label, out = _declared(tag, attributes, open_.inside > 0)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
            continue
        above = open_.stack[-1][1]
        if tag in VOID or (attributes.endswith("/") and tag not in INLINE and tag not in CLOSES_P):
            if tag == "hr":
                above.kids.append(Node("hr", "hr", 0))
            continue
        if tag in INLINE and not out:
            open_.push(tag, above)
            continue
        node = Node(tag, label, out, tag in INLINE)
        above.kids.append(node)
        open_.push(tag, node)
    return root


def _walk(root: Node) -> list[Node]:
    """Nodes in page order, without those that are surely boilerplate and what is in them."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [k for k in reversed(node.kids) if isinstance(k, Node) and k.out < 2]
    return out


def _plain(region: Node) -> tuple[int, int]:
    """Characters outside and within links below a node, without boilerplate."""
    found = [k for k in _walk(region) if not k.out or k is region]
    links = sum(k.links for k in found)
    return sum(k.chars for k in found) - links, links


def _tops(root: Node, tags: tuple[str, ...]) -> list[Node]:
    """The outermost nodes of ``tags`` below a node, in page order."""
    found, todo = [], [k for k in reversed(root.kids) if isinstance(k, Node)]
    while todo:
        node = todo.pop()
        if node.out > 1:
            continue
        if node.tag in tags:
            found.append(node)
        else:
            todo += [k for k in reversed(node.kids) if isinstance(k, Node)]
    return found


def regions(root: Node) -> list[Node]:
    """The articles, or else mains, that a page declares as its content; comments and teasers among them are told boilerplate."""
    found = []
    for top in _tops(root, ("article", "main")):
        own = _tops(top, ("article",)) if top.tag == "main" else []
        share = sum(_plain(k)[0] for k in own)
        found += own if own and 2 * share >= _plain(top)[0] else [top]
    for top in found:
        if inner := _tops(top, ("article",)):
            within = [_plain(k)[0] for k in inner]
            if 10 * sum(within) < 9 * _plain(top)[0] and not (len(inner) == 1 and 2 * within[0] >= _plain(top)[0]):
                for k in inner:
                    k.out = 2
    if len(found) > 1:
        sizes = [_plain(k) for k in found]
        most = max(range(len(found)), key=lambda k: sizes[k][0])
        for k, (plain, links) in enumerate(sizes):
            if k > most and 4 * plain < sizes[most][0] and (links or 16 * plain < sizes[most][0]):
                found[k].out = 2
        found = [k for k in found if k.out < 2]
    return found


class Tree:
    """The nodes of a page in page order, under one root: labels, hashes of own texts (0: none) and children; the sums that templates need."""

    def __init__(self, root: Node):
        self.root, self.declared = root, regions(root)
        self.labels, self.texts, self.kids, self.parents = [], [], [], []
        self.chars, self.links, self.weak, self.inside = [], [], [], []
        tops = {id(r) for r in self.declared}
        todo = [(0, root)]
        while todo:
            above, node = todo.pop()
            k = node.number = len(self.labels)
            if k:
                self.kids[above].append(k)
            self.parents.append(above)
            self.labels.append(node.label)
            own = _squeezed("".join(x for x in node.kids if isinstance(x, str)))
            self.texts.append(xxhash.xxh64_intdigest(own) >> 1 or 1 if own else 0)
            self.kids.append([])
            self.chars.append(node.chars)
            self.links.append(node.links)
            self.weak.append(node.out == 1 or bool(k and self.weak[above]))
            self.inside.append(id(node) in tops or bool(k and self.inside[above]))
            todo += [(k, x) for x in reversed(node.kids) if isinstance(x, Node) and x.out < 2]


def page_tree(html: str) -> Tree:
    return Tree(parse(html))


class _Classes:
    """Classes of equal subtrees of two trees: label, children's classes, and the text where both trees have it."""

    def __init__(self, a: Tree, b: Tree):
        shared = set(a.texts) & set(b.texts) - {0}
        self.known: dict[tuple, int] = {}
        self.label: list[str] = []
        self.text: list[int] = []
        self.kids: list[tuple[int, ...]] = []
        self.full: list[int] = []  # the score of a class with itself
        self.height: list[int] = []
        self.of = [self._named(t, shared) for t in (a, b)]

    def _named(self, t: Tree, shared: set[int]) -> list[int]:
        out = [0] * len(t.labels)
        for k in range(len(out) - 1, -1, -1):  # children come after their parents
            key = (t.labels[k], t.texts[k] if t.texts[k] in shared else 0, tuple([out[i] for i in t.kids[k]]))
            c = self.known.get(key)
            if c is None:
                c = self.known[key] = len(self.label)
                self.label.append(key[0])
                self.text.append(key[1])
                self.kids.append(key[2])
                self.full.append(1 + (key[1] > 0) + sum([self.full[i] for i in key[2]]))
                self.height.append(1 + max([self.height[i] for i in key[2]], default=0))
            out[k] = c
        return out

    def middle(self, a: int, b: int) -> tuple[int, int]:
        """How many children at the start and at the end have equal classes; these align first."""
        x, y = self.kids[a], self.kids[b]
        n, lo, hi = min(len(x), len(y)), 0, 0
        while lo < n and x[lo] == y[lo]:
            lo += 1
        while hi < n - lo and x[-1 - hi] == y[-1 - hi]:
            hi += 1
        return lo, hi

    def pairs(self, p: int, q: int, worth: _Scores) -> list[tuple[int, int]]:
        """The aligned children of two unlike classes."""
        lo, hi = self.middle(p, q)
        x, y = self.kids[p], self.kids[q]
        middle = aligned(x[lo : len(x) - hi], y[lo : len(y) - hi], worth)
        return [(i, i) for i in range(lo)] + [(lo + i, lo + j) for i, j in middle] + [(len(x) - k, len(y) - k) for k in range(hi, 0, -1)]


def matching(a: Tree, b: Tree) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two trees: the score, and the aligned pairs of their nodes."""
    c = _Classes(a, b)
    top = (c.of[0][0], c.of[1][0])
    scores = _Scores(c, *top)
    out, todo = [], [(0, 0)]
    while todo:
        i, j = todo.pop()
        out.append((i, j))
        p, q = c.of[0][i], c.of[1][j]
        if p == q:
            todo += zip(a.kids[i], b.kids[j], strict=True)
        else:
            todo += [(a.kids[i][k], b.kids[j][m]) for k, m in c.pairs(p, q, scores)]
    return scores.of(*top), out


class _Scores:
    """Scores of the pairs of classes that a match of two of them needs, in arrays: pairs of small families are scored together."""

    def __init__(self, c: _Classes, p: int, q: int):
        self.classes, self.count = c, len(c.label)
        self.names = np.unique(np.array(c.label), return_inverse=True)[1]
        self.full, self.size = np.array(c.full), np.array([len(k) for k in c.kids])
        self.text, self.height = np.array(c.text, np.uint64), np.array(c.height)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.array([k for x in c.kids for k in x], np.int64)
        new = np.array([p * self.count + q])
        found = [new]
        while len(new):
            new = np.setdiff1d(self.below(new), np.concatenate(found))
            found.append(new)
        self.codes = np.unique(np.concatenate(found))
        self.score = np.zeros(len(self.codes), np.int64)
        x, y = np.divmod(self.codes, self.count)
        height = np.minimum(self.height[x], self.height[y])
        same = x == y
        self.score[same] = self.full[x[same]]
        for h in np.unique(height[~same]).tolist():
            self.solve(np.flatnonzero((height == h) & ~same))

    def families(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
        """Places in ``codes`` of pairs with as many children each, and these children; None for a pair of large families."""
        x, y = np.divmod(codes, self.count)
        shape = self.size[x] * (1 << 32) + self.size[y]
        order = np.argsort(shape, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(shape[order])) + 1) if len(order) else ():
            m, n = int(self.size[x[at[0]]]), int(self.size[y[at[0]]])
            if not m or not n:
                continue
            if m * n > 4096:
                for k in at:
                    yield np.array([k]), None, None
                continue
            step = max(1, (1 << 20) // (m * n))
            for i in range(0, len(at), step):
                some = at[i : i + step]
                yield some, self.flat[self.start[x[some]][:, None] + np.arange(m)], self.flat[self.start[y[some]][:, None] + np.arange(n)]

    def below(self, codes: np.ndarray) -> np.ndarray:
        """The pairs of children of equal label, of unlike pairs."""
        x, y = np.divmod(codes, self.count)
        codes = codes[x != y]
        out = [np.empty(0, np.int64)]
        for at, i, j in self.families(codes):
            if i is None:
                p, q = divmod(int(codes[at[0]]), self.count)
                lo, hi = self.classes.middle(p, q)
                i, j = (np.unique(np.array(k[lo : len(k) - hi], np.int64))[None, :] for k in (self.classes.kids[p], self.classes.kids[q]))
            rows = max(1, (1 << 22) // max(1, i.shape[1] * j.shape[1]))
            for r in range(0, len(i), rows):
                both = np.broadcast_arrays(i[r : r + rows, :, None], j[r : r + rows, None, :])
                fit = (self.names[both[0]] == self.names[both[1]]) & (both[0] != both[1])
                out.append(np.unique(both[0][fit] * self.count + both[1][fit]))
        return np.unique(np.concatenate(out))

    def looked_up(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        code = i * self.count + j
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(i == j, self.full[i], np.where(self.codes[at] == code, self.score[at], 0))

    def of(self, i: int, j: int) -> int:
        return int(self.looked_up(np.array([i]), np.array([j]))[0])

    def row(self, i: int, j: tuple[int, ...]) -> np.ndarray:
        return self.looked_up(np.full(len(j), i), np.array(j, np.int64))

    def solve(self, at: np.ndarray) -> None:
        codes = self.codes[at]
        x, y = np.divmod(codes, self.count)
        own = 1 + ((self.text[x] > 0) & (self.text[x] == self.text[y]))
        for some, i, j in self.families(codes):
            if i is None:
                p, q = int(x[some[0]]), int(y[some[0]])
                own[some] += sum(self.of(self.classes.kids[p][k], self.classes.kids[q][m]) for k, m in self.classes.pairs(p, q, self))
                continue
            w = self.looked_up(np.broadcast_to(i[:, :, None], (len(i), i.shape[1], j.shape[1])), np.broadcast_to(j[:, None, :], (len(i), i.shape[1], j.shape[1])))
            best = np.zeros((j.shape[1] + 1, len(i)), np.int64)
            for r in range(i.shape[1]):
                before = best.copy()
                for k in range(j.shape[1]):
                    best[k + 1] = np.maximum(np.maximum(before[k + 1], best[k]), before[k] + w[:, r, k])
            own[some] += best[-1]
        self.score[at] = own


def aligned(x: tuple[int, ...], y: tuple[int, ...], worth: _Scores) -> list[tuple[int, int]]:
    """The order-preserving pairs of two sequences of classes that are worth most together."""
    if not x or not y:
        return []
    rows = {p: worth.row(p, y) for p in set(x)}
    out: list[tuple[int, int]] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if (b - a) * (d - c) > CELLS and b - a > 1:
            mid = (a + b) // 2
            fore, back = np.zeros(d - c + 1, np.int64), np.zeros(d - c + 1, np.int64)
            for i in range(a, mid):
                fore = _next(fore, rows[x[i]][c:d])
            for i in range(b - 1, mid - 1, -1):
                back = _next(back, rows[x[i]][c:d][::-1])
            k = c + int((fore + back[::-1]).argmax())
            todo += [(a, mid, c, k), (mid, b, k, d)]
            continue
        m = np.zeros((b - a + 1, d - c + 1), np.int64)
        for i in range(b - a):
            m[i + 1] = _next(m[i], rows[x[a + i]][c:d])
        i, j = b - a, d - c
        while i and j:
            w = rows[x[a + i - 1]][c + j - 1]
            if w and m[i, j] == m[i - 1, j - 1] + w:
                i, j = i - 1, j - 1
                out.append((a + i, c + j))
            elif m[i, j] == m[i - 1, j]:
                i -= 1
            else:
                j -= 1
    return sorted(out)


def _next(before: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The best scores with one more row, by columns."""
    out = before.copy()
    np.maximum(out[1:], before[:-1] + w, out=out[1:])
    return np.maximum.accumulate(out)


def _squeezed(s: str) -> str:
    return " ".join(s.split())


class Template:
    """A host's reference page and what was induced of its nodes: constants, menus, weak boilerplate that is content; whether articles are overruled."""

    def __init__(self, html: str, constants: dict[int, int], menus: Iterable[int] = (), kept: Iterable[int] = (), whole: bool = False):
        self.tree, self.constants, self.menus, self.kept, self.whole = page_tree(html), constants, set(menus), set(kept), whole
        self.told = bool(self.constants or self.menus or self.kept)
        self.aligner = Aligner(self.tree)


class Aligner:
    """Alignments with one reference; pages that are alike in all that matters to it are aligned once."""

    def __init__(self, reference: Tree):
        self.reference, self.texts = reference, set(reference.texts)
        self.known: dict[bytes, list[tuple[int, int]]] = {}
        self.held = 0

    def pairs(self, page: Tree) -> list[tuple[int, int]]:
        shape = "\n".join(f"{a} {t if t in self.texts else 0} {n}" for a, t, n in zip(page.parents, page.texts, page.labels, strict=True))
        key = hashlib.blake2b(shape.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if key not in self.known:
            found = matching(self.reference, page)[1]
            self.held += len(found)
            if self.held > MAX_PAIRS:
                self.known.clear()
                self.held = len(found)
            self.known[key] = found
        return self.known[key]


def content(region: Node, marks: dict[int, str]) -> tuple[list[str], list[str]]:
    """Blocks of a region: those that stay, and all that are not declared boilerplate.

    ``marks`` by number of a node: "constant" (its own text is), "menu" or "kept".
    """
    slots: list[str] = []
    every: list[str] = []
    line: list[str] = []

    def flush(node: Node, menu: bool) -> None:
        s = _squeezed("".join(line))
        line.clear()
        if s:
            every.append(s)
            if not menu and marks.get(node.number) != "constant":
                slots.append(s)

    stack = [(region, iter(region.kids), marks.get(region.number) == "menu")]
    while stack:
        node, kids, menu = stack[-1]
        for k in kids:
            if isinstance(k, str):
                line.append(k)
            elif k.out > 1 or (k.out and marks.get(k.number) != "kept"):
                if not k.inline:
                    flush(node, menu)
            else:
                flush(node, menu)
                stack.append((k, iter(k.kids), menu or marks.get(k.number) == "menu"))
                break
        else:
            flush(node, menu)
            stack.pop()
    return slots, every


def extract(html: str | None, template: Template | None = None) -> str:
    """The main text of one page under its host's template."""
    if not html:
        return ""
    tree = page_tree(html)
    marks: dict[int, str] = {}
    if template is not None and template.told:
        for i, j in template.aligner.pairs(tree):
            if i in template.kept:
                marks[j] = "kept"
            elif i in template.menus:
                marks[j] = "menu"
            elif i in template.constants and template.constants[i] == tree.texts[j]:
                marks[j] = "constant"
    overruled = template is not None and template.whole
    slots: list[str] = []
    every: list[str] = []
    for region in [tree.root] if overruled or not tree.declared else tree.declared:
        a, b = content(region, marks)
        slots += a
        every += b
    if not every:  # nothing but what is weakly declared boilerplate: then that is the content
        every = content(tree.root, {k: "kept" for k, weak in enumerate(tree.weak) if weak})[1]
    return "\n".join(slots or every)


#: Of a node: pages, least and greatest text, characters, those within links.
Stats = dict[int, tuple[int, int, int, int, int]]
#: Numbers under which a page's characters outside links count, within declared articles and elsewhere.
INSIDE, OUTSIDE = -1, -2


def add_page(stats: Stats, reference: Tree, page: Tree, aligner: Aligner | None = None) -> None:
    """Adds what a page has at the nodes of the reference, and its sums."""
    for i, j in aligner.pairs(page) if aligner else matching(reference, page)[1]:
        n, lo, hi, chars, links = stats.get(i, (0, 1 << 63, -1, 0, 0))
        t = page.texts[j]
        stats[i] = (n + 1, min(lo, t), max(hi, t), chars + page.chars[j], links + page.links[j])
    sums = [0, 0]
    for inside, weak, chars, links in zip(page.inside, page.weak, page.chars, page.links, strict=True):
        if not weak:
            sums[not inside] += chars - links
    for k, x in zip((INSIDE, OUTSIDE), sums, strict=True):
        n, lo, hi, chars, links = stats.get(k, (0, 0, 0, 0, 0))
        stats[k] = (n + 1, lo, hi, chars + x, links)


def constants_of(reference: Tree, stats: Stats) -> dict[int, int]:
    """Nodes of the reference that are constant, and their texts."""
    out = {}
    for i, (n, lo, hi, *_) in stats.items():
        if i >= 0 and lo == hi > 0 and n >= MIN_PAGES:
            above = reference.parents[i]
            many = Counter(reference.labels[k] for k in reference.kids[above])[reference.labels[i]] > 1
            if not many or n >= MIN_SHARE * stats[above][0]:
                out[i] = lo
    return out


def induced(reference: Tree, stats: Stats) -> tuple[dict[int, int], list[int], list[int], bool]:
    """Constants, menus, weak boilerplate that is content, and whether most varying text lies outside the declared articles."""
    constants = constants_of(reference, stats)
    size = len(reference.labels)
    chars, links, varying = [0] * size, [0] * size, [0] * size
    for i in range(size - 1, -1, -1):
        _, _, _, c, k = stats.get(i, (0, 0, 0, 0, 0))
        chars[i], links[i] = chars[i] + c, links[i] + k
        varying[i] += 0 if i in constants else c - k
        if i:
            above = reference.parents[i]
            for x in (chars, links, varying):
                x[above] += x[i]
    often = lambda i: stats.get(i, (0,))[0] >= MIN_PAGES
    fixed = sum(stats[i][3] - stats[i][4] for i in constants if not reference.inside[i] and not reference.weak[i])
    inside, outside = (stats.get(k, (0, 0, 0, 0, 0))[3] for k in (INSIDE, OUTSIDE))
    pages = stats.get(INSIDE, (0,))[0]
    whole = pages >= MIN_PAGES and inside > 0 and outside - fixed > inside
    kept = [i for i in range(size) if reference.weak[i] and not reference.weak[reference.parents[i]] and often(i) and 2 * varying[i] > varying[0]]
    menus = [i for i in range(1, size) if chars[i] and links[i] >= MENU * chars[i] and often(i) and (whole or not reference.inside[i])]
    return constants, menus, kept, whole


def template_of(pages: list[str]) -> Template:
    """The template of one host's pages."""
    known = min(pages, key=lambda h: xxhash.xxh64_intdigest(h))
    reference, stats = page_tree(known), {}
    aligner = Aligner(reference)
    for p in pages:
        add_page(stats, reference, page_tree(p), aligner)
    return Template(known, *induced(reference, stats))


def host(url: str = "url") -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def references(pages: DataFrame) -> DataFrame:
    """(host, html): the page of the least hash of each host that has ``MIN_PAGES`` pages or more."""
    source = shaped(pages, ["url", "html"]).select(host().alias("host"), "html").where("host <> '' AND html <> ''")
    least = source.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("html")).alias("rank")).where(F.col("n") >= MIN_PAGES)
    least = staged(least.select("host", "rank"), "ranks")
    few = (least.agg(F.sum(F.octet_length("host") + 40)).first()[0] or 0) <= MAX_BROADCAST
    met = source.withColumn("rank", F.xxhash64("html")).join(F.broadcast(least) if few else least, ["host", "rank"]).select("host", "html")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()  # copies of a reference stay behind
        for batch in batches:
            at = [k for k, h in enumerate(batch.column(0).to_pylist()) if not (h in seen or seen.add(h))]
            yield batch.take(pa.array(at, pa.int64()))

    return met.mapInArrow(once, "host string, html string").groupBy("host").agg(F.min("html").alias("html"))


_TOLD = {"nodes": "array<int>", "texts": "array<bigint>", "menus": "array<int>", "kept": "array<int>", "whole": "boolean"}


def _beside(pages: DataFrame, known: DataFrame, columns: list[str], max_bytes: int):
    """``pages`` plus ``_in`` (host, html, known), and a function from its rows to the parsed ``known`` of their hosts or None.

    ``known``: (host, html, ``_TOLD``), broadcast if its size is within bounds, else joined.
    """
    marks = F.size("nodes") + F.size("menus") + F.size("kept")
    size = known.agg(F.sum(F.octet_length("html") + F.octet_length("host") + 16 * marks)).first()[0] or 0
    part = F.struct("html", *_TOLD)
    if size <= max_bytes:
        sent = pages.sparkSession.sparkContext.broadcast({r["host"]: r[1] for r in known.select("host", part).toLocalIterator()})
        none = F.lit(None).cast(known.select(part.alias("k")).schema["k"].dataType)
        out = pages.withColumn("_in", F.struct(host().alias("host"), "html", none.alias("known")))
        told = lambda r: sent.value.get(r["host"])
    else:
        met = pages.withColumn("_host", host()).join(known.select(F.col("host").alias("_host"), part.alias("_known")), "_host", "left")
        out = met.withColumn("_in", F.struct(F.col("_host").alias("host"), "html", F.col("_known").alias("known")))
        told = lambda r: r["known"]
    cache: dict[str, Template | None] = {}
    kept = [0]

    def template(r: dict) -> Template | None:
        if r["host"] not in cache:
            k = told(r)
            kept[0] += len(k["html"]) if k else 100
            if kept[0] > MAX_KEPT:
                cache.clear()
                kept[0] = len(k["html"]) if k else 100
            cache[r["host"]] = Template(k["html"], dict(zip(k["nodes"], k["texts"], strict=True)), k["menus"], k["kept"], k["whole"]) if k else None
        return cache[r["host"]]

    return out.select(*columns, "_in"), template


def templates(pages: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(host, html, ``_TOLD``): the reference of every host of which something was induced, and that."""
    in_small_batches(pages.sparkSession)
    none = [(F.lit(False) if t == "boolean" else F.expr(f"cast(array() as {t})")).alias(c) for c, t in _TOLD.items()]
    known = staged(references(pages).select("host", "html", *none), "references")
    source = shaped(pages, ["url", "html"]).select("url", "html").where("html <> ''")
    keyed, template = _beside(source, known, [], max_broadcast)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in pieces(batch, 0):
                made: dict[str, Stats] = {}
                for r in part.column(0).to_pylist():
                    t = template(r)
                    if t is not None:
                        add_page(made.setdefault(r["host"], {}), t.tree, page_tree(r["html"]), t.aligner)
                rows = [(h, i, *x) for h, stats in made.items() for i, x in stats.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(_COUNTED), _COUNTED.types, strict=True)], schema=_COUNTED)

    per_node = keyed.mapInArrow(counted, "host string, node int, n bigint, lo bigint, hi bigint, chars bigint, links bigint")
    sums = [F.sum(c).alias(c) for c in ("n", "chars", "links")]
    per_node = per_node.groupBy("host", "node").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *sums)
    # one row a host, of no more nodes than its reference has
    per_host = per_node.groupBy("host").agg(F.collect_list(F.struct("node", "n", "lo", "hi", "chars", "links")).alias("stats"))

    def judged(column: pa.Array) -> list[list]:
        found = []
        for r in column.to_pylist():
            constants, menus, kept, whole = induced(page_tree(r["html"]), {x["node"]: tuple(x[c] for c in ("n", "lo", "hi", "chars", "links")) for x in r["stats"]})
            found.append((sorted(constants), [constants[i] for i in sorted(constants)], menus, kept, whole))
        return [list(c) for c in zip(*found, strict=True)] if found else [[] for _ in _TOLD]

    met = per_host.join(known.select("host", "html"), "host").select("host", F.struct("html", "stats").alias("_in"))
    told = appended(met, _TOLD, judged, "_in").where("size(nodes) + size(menus) + size(kept) > 0 OR whole")
    out = staged(told.select("host", F.col("_in.html").alias("html"), *_TOLD), "templates")
    dropped(known)
    return out


_COUNTED = pa.schema([("host", pa.string()), ("node", pa.int32()), ("n", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())])


def extracted(pages: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``pages`` plus ``text`` and ``n_chars``."""
    known = templates(pages, max_broadcast)
    pages = shaped(pages, ["url", "html"], ["text", "n_chars", "_in", "_host", "_known"])
    names = pages.columns
    keep = [n for n in names if n != "html"]
    keyed, template = _beside(pages, known, keep, max_broadcast)

    def batch(column: pa.Array) -> list[list[str]]:
        return [[extract(r["html"], template(r)) if r["html"] else "" for r in column.to_pylist()]]

    done = appended(keyed, {"text": "string"}, batch, "_in")
    return done.select(*keep, F.col("_in.html").alias("html"), "text", F.length("text").cast("bigint").alias("n_chars")).select(*names, "text", "n_chars")
