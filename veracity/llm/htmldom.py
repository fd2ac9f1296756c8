"""Document trees of web pages as flat arrays, and the features of their nodes.

A page is read once from start to end with a stack of open elements; missing
and stray end tags are mended (a paragraph ends before the next block, an end
tag closes what is open inside). A node is an element, or a text leaf: text
that stands directly in an element without a block between. Formatting
elements without attributes of interest are no nodes, their text belongs to
the leaf around. Nodes are numbered as they begin, so a subtree is a range of
numbers and sums over it are differences of running sums, for many pages at
once.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np

# Fixed values of HTML: element kinds by the role they have in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("script style noscript template iframe noembed noframes head title textarea button select option optgroup object applet svg canvas audio video map datalist".split())
#: A start tag of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: What a start tag ends, up to the element that holds it.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

TAG = re.compile(r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*+>?|/(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+>?
    |(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+)>)""", re.S | re.X)
#: Used for the rest of a page in which a quote was never closed.
LOOSE = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*+>?|/(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+>?|(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>[^>]*+)(?:>|\Z))", re.S)
ATTR = re.compile(r"""(class|id|role|itemprop|aria-label|style|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
MARKS = ".!?;:,"
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Words of class names, ids and roles by what they tell; a bit each.
ROLES = {
    "content": "article articlebody content post entry story body text main page prose copy news blog reading",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs toc pagination pager tabs toolbar menubar",
    "head": "header head masthead topbar top logo brand hero",
    "foot": "footer foot bottom copyright colophon legal imprint contentinfo",
    "side": "sidebar side aside widget rail related recommended trending popular complementary secondary more",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall warning message disclaimer privacy dialog banner announcement",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion affiliate dfp teaser",
    "form": "form search login signup register contact input poll",
    "comment": "comment comments discussion disqus reply replies respond responses reviews feedback thread",
    "share": "share sharing social follow tweet facebook like buttons",
    "hidden": "hidden sr visually screenreader invisible none",
}
ROLE_BITS = {name: 1 << n for n, name in enumerate(ROLES)}
TAGS = ("p", "heading", "list", "item", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "table", "quote", "inline", "page", "figure", "other")
TAG_OF = {"p": "p", **dict.fromkeys(HEADINGS, "heading"), **dict.fromkeys(("ul", "ol", "dl", "menu"), "list"), **dict.fromkeys(("li", "dt", "dd"), "item"),
          "div": "div", "section": "section", "article": "article", "main": "main", "nav": "nav", "header": "header", "footer": "footer", "aside": "aside",
          **dict.fromkeys(("form", "fieldset", "legend", "label", "dialog"), "form"), **dict.fromkeys(("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"), "table"),
          **dict.fromkeys(("blockquote", "pre"), "quote"), **dict.fromkeys(("html", "body"), "page"), **dict.fromkeys(("figure", "figcaption", "img"), "figure"),
          **dict.fromkeys(INLINE, "inline")}
TAG_NUMBER = {t: TAGS.index(TAG_OF[t]) for t in TAG_OF}
OTHER = len(TAGS) - 1
_WORD_ROLE = {w: ROLE_BITS[name] for name, words in ROLES.items() for w in words.split()}
_STEMS = [(w, bit) for w, bit in _WORD_ROLE.items() if len(w) >= 6]


class _Roles(dict):
    """Role bits of a value of class, id, role or the like, those seen lately at hand."""

    def __missing__(self, value: str) -> int:
        if len(self) > 1 << 14:
            self.clear()
        bits = 0
        for token in TOKEN.findall(value):
            token = token.lower()
            bits |= _WORD_ROLE.get(token, 0) or next((bit for stem, bit in _STEMS if token.startswith(stem)), 0)
        self[value] = bits
        return bits


_ROLES = _Roles()


def roles_of(attrs: str) -> int:
    bits = 0
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "style" and HIDING.search(value)):
            bits |= ROLE_BITS["hidden"]
        elif name != "style":
            bits |= _ROLES[value]
    return bits


class Nodes:
    """Nodes of some pages, one list a column."""

    COLUMNS = ("parent", "end", "depth", "tag", "roles", "above_roles", "above_tags", "leaf", "before", "after", "place",
               "chars", "words", "marks", "links", "elements", "in_p", "headings", "items")

    def __init__(self):
        for c in self.COLUMNS:
            setattr(self, c, [])
        self.last: list[int] = []  # last child of each node
        self.texts: dict[int, list[str]] = {}
        self.gap: dict[int, bool] = {}  # whether a block began or ended before the leaf
        self.pages: list[tuple[int, int]] = []

    def __len__(self):
        return len(self.parent)

    def add(self, parent: int, tag: int, roles: int, leaf: bool, root: int) -> int:
        n = len(self.parent)
        for name in ("end", "chars", "words", "marks", "links", "in_p", "headings", "items"):
            getattr(self, name).append(0)
        self.parent.append(parent)
        self.tag.append(tag)
        self.roles.append(roles)
        self.leaf.append(leaf)
        self.elements.append(0 if leaf else 1)
        self.last.append(-1)
        self.after.append(-1)
        if parent < root:
            self.depth.append(0)
            self.above_roles.append(0)
            self.above_tags.append(0)
            self.before.append(-1)
            self.place.append(0)
        else:
            self.depth.append(self.depth[parent] + 1)
            self.above_roles.append(self.above_roles[parent] | self.roles[parent])
            self.above_tags.append(self.above_tags[parent] | 1 << self.tag[parent])
            elder = self.last[parent]
            self.before.append(elder)
            self.place.append(0 if elder < 0 else self.place[elder] + 1)
            if elder >= 0:
                self.after[elder] = n
            self.last[parent] = n
        return n

    def parse(self, page: str) -> None:
        """Adds the nodes of a page; an empty page has its root alone."""
        root = self.add(-1, TAG_NUMBER["html"], 0, False, len(self))
        stack: list[tuple[str, int, bool, bool]] = [("", root, False, False)]  # name, node, in a link, in a paragraph
        leaf, gap, space, at, size, matcher = -1, True, False, 0, len(page), TAG
        opened: Counter = Counter()  # open elements by name, so that an end tag without one costs no search

        def text(piece: str) -> None:
            nonlocal leaf, gap, space
            if not piece:
                return
            if leaf < 0 and not piece.strip():
                space = True
                return
            name, node, link, in_p = stack[-1]
            if leaf < 0 or self.parent[leaf] != node:
                leaf = self.add(node, self.tag[node], self.roles[node], True, root)
                self.texts[leaf], self.gap[leaf] = [" "] if space else [], gap
                gap = space = False
            piece = html.unescape(piece) if "&" in piece else piece
            self.texts[leaf].append(piece)
            chars = len(piece)
            self.chars[leaf] += chars
            self.words[leaf] += len(piece.split())
            self.marks[leaf] += sum(map(piece.count, MARKS))
            self.links[leaf] += chars * link
            self.in_p[leaf] += chars * in_p

        def close(depth: int) -> None:
            nonlocal leaf, gap
            while len(stack) > depth:
                name, node, *_ = stack.pop()
                opened[name] -= 1
                if node != stack[-1][1]:
                    self.end[node] = len(self)
                    leaf = -1
                if name not in INLINE:
                    leaf, gap = -1, True

        while at < size:
            start = page.find("<", at)
            if start < 0:
                start = size
            m = matcher.match(page, start) if start < size else None
            if m is None:
                if start < size and page[start + 1:start + 2].isalpha() and matcher is TAG:
                    matcher = LOOSE  # a quote that never ends
                    continue
                text(page[at:start + 1])
                at = start + 1
                continue
            text(page[at:start])
            at = m.end()
            name = (m["start"] or "").lower()
            if name:
                if name in RAW:
                    done = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
                    at = done.start() if done else size
                    if name not in INLINE:
                        leaf, gap = -1, True
                    continue
                if name in ENDS_P and opened["p"]:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == "p":
                            close(k)
                            break
                        if stack[k][0] in ("table", "button", "td", "th", "caption", "object"):
                            break
                ended, held = ENDS.get(name, ((), ()))
                if any(opened[x] for x in ended):
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in ended:
                            close(k)
                            break
                        if stack[k][0] in held:
                            break
                _, node, link, in_p = stack[-1]
                if name in VOID:
                    if name in ("br", "hr", "img", "input"):
                        if name in ("br", "hr"):
                            leaf, gap = -1, True
                        self.elements[node] += 1
                    continue
                roles = roles_of(m["attrs"]) if m["attrs"] else 0
                inline = name in INLINE
                if not inline:
                    leaf, gap = -1, True
                if inline and not roles:
                    self.elements[node] += 1
                else:
                    node = self.add(node, TAG_NUMBER.get(name, OTHER), roles, False, root)
                    if name in HEADINGS:
                        self.headings[node] = 1
                    elif name == "li":
                        self.items[node] = 1
                    if name in DROPPED:
                        self.roles[node] |= 1 << 30
                stack.append((name, node, link or name == "a", in_p or name == "p"))
                opened[name] += 1
            elif m["end"]:
                name = m["end"].lower()
                for k in range(len(stack) - 1, 0, -1):
                    if not opened[name]:
                        break
                    if stack[k][0] == name:
                        close(k)
                        break
                    if name in INLINE and stack[k][0] not in INLINE:
                        break
        close(1)
        self.end[root] = len(self)
        self.pages.append((root, len(self)))


DROP_BIT = 1 << 30
_ABOVE = ("article", "main", "nav", "header", "footer", "aside", "form", "list", "table", "p", "heading", "quote", "section", "figure")
FEATURES = (["leaf", "depth", "chars", "words", "links", "density", "share", "marks", "words a leaf", "start", "place", "siblings", "share of siblings",
             "before", "after", "links before", "links after", "in p", "headings", "items", "holds article", "holds main", "holds content",
             "parent's share", "parent's links", "parent in p", "parent's words a leaf"]
            + [f"is {t}" for t in TAGS] + [f"in {t}" for t in _ABOVE] + [f"own {r}" for r in ROLES] + [f"above {r}" for r in ROLES])


def features(nodes: Nodes) -> np.ndarray:
    """``nodes x FEATURES``, for the nodes of all pages at once."""
    col = {c: np.array(getattr(nodes, c), np.int64) for c in Nodes.COLUMNS}
    n = len(nodes)
    at = np.arange(n)
    end = np.where(col["leaf"] == 1, at + 1, np.maximum(col["end"], at + 1))

    def subtree(values):
        running = np.concatenate([[0], np.cumsum(values)])
        return running[end] - running[at], running

    chars, running = subtree(col["chars"])
    words, marks, links, elements, in_p, headings, items, leaves = (subtree(col[c])[0] for c in ("words", "marks", "links", "elements", "in_p", "headings", "items", "leaf"))
    articles, mains, contents = (subtree(x)[0] - x for x in (
        (col["tag"] == TAGS.index("article")) & (col["leaf"] == 0), (col["tag"] == TAGS.index("main")) & (col["leaf"] == 0), (col["roles"] & ROLE_BITS["content"] > 0) & (col["leaf"] == 0)))
    root = np.zeros(n, np.int64)
    for a, b in nodes.pages:
        root[a:b] = a
    parent = np.where(col["parent"] < 0, at, col["parent"])
    siblings = np.bincount(parent, minlength=n)[parent]
    held = np.bincount(parent, weights=chars, minlength=n)[parent]
    density = links / np.maximum(chars, 1)

    def near(which, values):
        return np.where(which >= 0, values[which], 0)

    total = np.maximum(chars[root], 1)
    out = [col["leaf"], col["depth"], np.log1p(chars), np.log1p(words), density, np.log1p(chars) - np.log1p(elements), chars / total, marks / np.maximum(words, 1),
           words / np.maximum(leaves, 1), (running[at] - running[root]) / total, np.minimum(col["place"], 50), np.minimum(siblings, 50), chars / np.maximum(held, 1),
           np.log1p(near(col["before"], chars)), np.log1p(near(col["after"], chars)), near(col["before"], density), near(col["after"], density),
           in_p / np.maximum(chars, 1), np.minimum(headings, 20), np.minimum(items, 50), articles > 0, mains > 0, contents > 0,
           (chars / total)[parent], density[parent], (in_p / np.maximum(chars, 1))[parent], (words / np.maximum(leaves, 1))[parent]]
    out += [col["tag"] == t for t in range(len(TAGS))]
    out += [(col["above_tags"] >> TAGS.index(t)) & 1 for t in _ABOVE]
    out += [(col["roles"] & bit) > 0 for bit in ROLE_BITS.values()]
    out += [(col["above_roles"] & bit) > 0 for bit in ROLE_BITS.values()]
    return np.stack([np.asarray(x, np.float64) for x in out], 1)
