"""HTML extraction: the main text of web pages by boosted trees over DOM nodes.

Each node of a page's tree gets a probability to hold main text from
gradient-boosted trees over its features (``htmldom``): density and links of
its subtree, tokens of its class, id and role and of those above, depth,
place, and how it compares with its siblings. **Hierarchical decoding**
chooses the most probable labelling of the whole tree in which nothing is kept
below a node that isn't: a node's best labelling costs its own logarithm and,
if kept, the better of both labellings of each child; if not, all nodes below
count as not kept. So a menu's paragraph can't outlive the menu, nor an
article be dropped around its text.

The model is fitted on ``TRAIN_PAGES`` made pages (:func:`training_pages`):
layouts with and without sectioning elements, telling class names, menus,
notices, adverts, forms, comments, missing end tags. It doesn't depend on the
table that is read, so a page has the same text in every table. Its trees, of
a bounded size, go to the tasks; pages are read, scored
and decoded there one batch at a time, without a shuffle.

Blocks are joined by one space; white space is that of Unicode, character
references are decoded as browsers do. Scripts, styles, forms' controls and
comments are no text whatever the model says.

Defined results: a null or empty page has the empty text; so has one in which
nothing is kept. Text without markup is main text or not like any other. Each
row is read by itself: repeated rows and ids, null ids and urls come back as
they are. An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from veracity.llm.base import arrow_batches, slices
from veracity.llm.htmldom import DROP_BIT, FEATURES, Nodes, features

TRAIN_PAGES, SEED = 400, 7
TREES, DEPTH, RATE = 32, 5, 0.3
#: Bins of a feature, weight of a leaf towards 0, least curvature of a leaf.
BINS, SHRINK, LEAST = 32, 1.0, 1.0
#: Nodes and characters of pages that are read before they are scored.
NODES, CHARS = 20_000, 1 << 22
_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

# --- made pages ------------------------------------------------------------------------
#: Marks main text in made pages; a private code point.
MARK = ""
_CLASSES = {
    "article": "article post entry story content article-body post-content entry-content main-content story-body articleBody prose text body-copy blog-post page-content",
    "wrap": "wrapper container page layout has-sidebar with-sidebar site row col grid content-area inner clearfix l-main page-wrapper two-column",
    "menu": "nav navbar menu main-menu breadcrumb breadcrumbs toc pagination tabs site-nav navigation topnav pager",
    "head": "header masthead site-header top-bar page-header logo-bar brand head",
    "foot": "footer site-footer foot bottom-bar copyright colophon legal footer-links",
    "side": "sidebar side widget related right-rail related-posts recommended trending popular aside secondary more-stories",
    "notice": "cookie-banner cookie-notice gdpr consent alert notice popup modal newsletter newsletter-signup subscribe-box paywall announcement disclaimer",
    "advert": "ad ads advert advertisement adsbox sponsored promo ad-slot banner-ad sponsor google-ad promotion",
    "form": "search-form login-form contact-form signup form search subscribe",
    "comment": "comments comment comment-list discussion replies responses comment-section disqus_thread reviews",
    "share": "share social share-buttons social-links follow-us post-tags",
}
_ELEMENTS = {"menu": ("nav", "div", "ul"), "head": ("header", "div"), "foot": ("footer", "div"), "side": ("aside", "div", "section"), "notice": ("div", "section", "aside", "p"),
             "advert": ("div", "aside", "p", "section"), "form": ("form", "div"), "comment": ("section", "div", "ol"), "share": ("div", "ul", "p")}
_FIXED = ["Cookie settings", "Accept all", "We use cookies to improve your experience.", "Subscribe to our newsletter.", "All rights reserved.", "Read more", "Sign in",
          "Share this", "Leave a reply", "Advertisement", "Privacy policy", "Terms of use", "Back to top", "Related articles", "Posted in", "&copy; 2024", "&middot;"]


class _Page:
    """One made page; ``main`` tells whether its text is marked."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        r = self.r
        letters = r.choice(("etaoinshrdlu", "enisratdhulc", "eaosrnidlctu", "ěščřžýáíéou", "аеинотрслвкм", "的一是不了人我在有他这中"))
        self.words = ["".join(r.choice(letters) for _ in range(r.randint(1, 9))) for _ in range(60)]
        self.named, self.sections, self.sloppy = r.random() < 0.7, r.random() < 0.6, r.random() < 0.3

    def sentence(self, least: int, most: int) -> str:
        r = self.r
        out = " ".join(r.choice(self.words) for _ in range(r.randint(least, most)))
        return out[:1].upper() + out[1:] + r.choice((".", ".", ".", "!", "", " &amp; more."))

    def text(self, least: int, most: int, main: bool = False) -> str:
        left, out = self.r.randint(least, most), []
        while left > 0:
            out.append(self.sentence(1, min(left, 14)))
            left -= out[-1].count(" ") + 1
        body = self.r.choice((" ", " ", "\n")).join(out)
        if self.r.random() < 0.15 and " " in body:
            a, b = body.split(" ", 1)
            body = f"{a} <{(t := self.r.choice(('a href=/x', 'b', 'em', 'span')))}>{b}" + (f"</{t.split()[0]}>" if not self.sloppy else "")
        return MARK + body if main else body

    def end(self, tag: str) -> str:
        return "" if self.sloppy and tag in ("p", "li", "td", "tr", "b") and self.r.random() < 0.7 else f"</{tag}>"

    def attrs(self, role: str, always: bool = False) -> str:
        if not (always or (self.named and self.r.random() < 0.85)):
            return ""
        names = _CLASSES[role].split()
        value = " ".join(self.r.sample(names, 1 if self.r.random() < 0.7 else 2)) + self.r.choice(("", "", "", " mt-3", " js-x"))
        return f" {self.r.choice(('class', 'class', 'class', 'id'))}=\"{value}\""

    def links(self, least: int, most: int) -> str:
        items = [f"<a href=\"/{i}\">{self.text(1, 4) if self.r.random() < 0.8 else self.r.choice(_FIXED)}</a>" for i in range(self.r.randint(least, most))]
        return ("<ul>" + "".join(f"<li>{x}{self.end('li')}" for x in items) + "</ul>") if self.r.random() < 0.7 else " | ".join(items)

    def block(self, role: str) -> str:
        """A part of the page that is no main text."""
        r = self.r
        tags = _ELEMENTS[role]
        tag = tags[0] if self.sections and r.random() < 0.8 else r.choice(tags[1:])
        telling = tag in ("nav", "header", "footer", "aside", "form")
        attrs = self.attrs(role, always=not telling)
        if role == "menu":
            inner = self.links(2, 12)
        elif role == "head":
            inner = r.choice(("", f"<h1>{self.text(1, 4)}</h1>", f"<div>{self.text(1, 5)}</div>")) + (self.links(1, 8) if r.random() < 0.6 else f"<p>{self.text(2, 12)}</p>")
        elif role == "foot":
            inner = r.choice((f"&copy; x.example &middot; {self.text(1, 40)}", f"<p>{self.text(3, 60)}</p>", self.links(2, 10) + f"<p>{r.choice(_FIXED)}</p>"))
        elif role == "side":
            inner = f"<h{(k := r.randint(2, 4))}>{self.text(1, 4)}</h{k}>" + (self.links(2, 10) if r.random() < 0.6 else "".join(f"<p>{self.text(4, 60)}</p>" for _ in range(r.randint(1, 4))))
        elif role == "comment":
            item = r.choice(("li", "div", "article"))
            own = ' class="comment"' if item != "article" or r.random() < 0.5 else ""
            inner = r.choice(("", f"<h3>{self.text(1, 3)}</h3>")) + "".join(f"<{item}{own}><b>{self.text(1, 2)}</b><p>{self.text(2, 90)}{self.end('p')}</{item}>" for _ in range(r.randint(1, 8)))
            inner = f"<li>{inner}</li>" if tag == "ol" and item != "li" else inner
        elif role == "form":
            inner = f"<label>{self.text(1, 3)}</label><input name=q><p>{self.text(1, 10)}</p><select><option>{self.text(1, 2)}</option></select><button>{self.text(1, 2)}</button>"
        elif role == "share":
            inner = self.links(2, 6)
        else:
            inner = r.choice((self.text(1, 60), f"<p>{self.text(3, 80)}</p>", f"<h4>{self.text(1, 5)}</h4><p>{self.text(3, 60)}</p><a href=/y>{r.choice(_FIXED)}</a>"))
        return f"<{tag}{attrs}>{inner}{self.end(tag)}\n"

    def article(self) -> str:
        r, out = self.r, []
        size = r.choice((0, 1, 1, 2, 3, 5, 8, 14))
        head = f"<h1>{self.text(1, 12, True)}</h1>" if r.random() < 0.8 else ""
        out.append(f"<header>{head}</header>" if head and r.random() < 0.15 else head)
        long = r.choice((6, 30, 120))
        for _ in range(size):
            kind = r.random()
            if kind < 0.72:
                bold = r.random() < 0.15
                out.append(f"<p>{'<b>' * bold}{self.text(1, long, True)}{'<br>' * (r.random() < 0.15)}{'</b>' * (bold and r.random() < 0.3)}{self.end('p')}")
            elif kind < 0.78:
                out.append(f"<h{(k := r.randint(2, 4))}>{self.text(1, 7, True)}</h{k}>")
            elif kind < 0.83:
                out.append("<ul>" + "".join(f"<li>{self.text(1, 20, True)}{self.end('li')}" for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.86:
                out.append(f"<blockquote><p>{self.text(3, 40, True)}</p></blockquote>")
            elif kind < 0.88:
                out.append("<table>" + "".join(f"<tr><td>{self.text(1, 4, True)}</td><td>{self.text(1, 4, True)}</td></tr>" for _ in range(r.randint(1, 5))) + "</table>")
            elif kind < 0.9:
                out.append(f"<figure><img src=x><figcaption>{self.text(2, 12, True)}</figcaption></figure>")
            elif kind < 0.93:
                out.append(f"<div><p>{self.text(2, long, True)}</p></div>" if r.random() < 0.5 else f"<section><h2>{self.text(1, 5, True)}</h2><p>{self.text(2, long, True)}</p></section>")
            else:
                out.append(self.block(r.choice(("advert", "notice", "side", "share", "form"))))
        if r.random() < 0.2:
            out.append(self.block(r.choice(("share", "comment", "foot", "side"))))
        inner = r.choice(("", "\n")).join(out)
        kind = r.random()
        if self.sections and kind < 0.75:
            inner = f"<article{self.attrs('article') if r.random() < 0.4 else ''}>{inner}" + ("" if self.sloppy and r.random() < 0.2 else "</article>")
            if r.random() < 0.3:
                inner = f"<main>{inner}</main>"
        elif self.sections and kind < 0.9:
            inner = f"<main>{inner}</main>"
        elif kind < 0.95 or not self.sections:
            inner = f"<div{self.attrs('article', always=r.random() < 0.7)}>{inner}</div>" if r.random() < 0.85 else inner
        return inner

    def page(self) -> str:
        r = self.r
        before = [self.block(x) for x in ("head", "menu", "notice", "advert", "form", "side") if r.random() < 0.45]
        after = [self.block(x) for x in ("comment", "side", "share", "advert", "notice", "form", "menu") if r.random() < 0.25]
        if r.random() < 0.8:
            after.append(self.block("foot"))
        if r.random() < 0.05:
            before, after = [], []
        r.shuffle(before)
        body = [*before, self.article(), *after]
        if r.random() < 0.3:
            cut = r.randint(0, len(before))
            last = r.randint(cut, len(before))
            body = [*body[:cut], f"<div{self.attrs('wrap', True)}>", *body[cut:len(before) + 1], "</div>", *after] if r.random() < 0.5 else [
                *body[:last], f"<div{self.attrs('wrap', True)}>", *body[last:-1], "</div>", *body[-1:]]
        end = "" if r.random() < 0.15 else "</body></html>"
        script = "<script>var t=\"</p>\";track(0);</script>" if r.random() < 0.6 else ""
        return f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{self.text(1, 8)}</title><style>p{{}}</style>{script}</head><body{self.attrs('wrap') if r.random() < 0.3 else ''}>" \
               f"{'<!-- x -->' * (r.random() < 0.3)}{''.join(body)}{end}"


def training_pages(pages: int, seed: int = SEED) -> list[str]:
    """Made pages in which each block of main text begins with ``MARK``."""
    return [_Page(seed * 1_000_003 + n).page() for n in range(pages)]


def labelled(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the pages' nodes, and whether a node holds main text."""
    nodes = Nodes()
    for page in pages:
        nodes.parse(page)
    own = np.zeros(len(nodes), np.int64)
    for leaf, pieces in nodes.texts.items():
        own[leaf] = any(MARK in p for p in pieces)
    running = np.concatenate([[0], np.cumsum(own)])
    at = np.arange(len(nodes))
    end = np.where(np.array(nodes.leaf, bool), at + 1, np.maximum(nodes.end, at + 1))
    return features(nodes), (running[end] - running[at] > 0).astype(np.int64)


# --- the model -------------------------------------------------------------------------
Tree = tuple[np.ndarray, ...]


def _grown(bins: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, curvature: np.ndarray, depth: int) -> tuple[Tree, np.ndarray]:
    """One tree by greatest gain, level by level: feature, threshold, left, right, value of each node; and the value of each row.

    ``bins`` has a row for each feature."""
    feature, threshold, left, right, value = [[x] for x in (0, np.inf, 0, 0, 0.0)]
    at = np.zeros(bins.shape[1], np.int64)
    twofold = np.array([f for f, e in enumerate(edges) if len(e) == 1], np.int64)
    others = [f for f, e in enumerate(edges) if len(e) > 1]
    both = np.stack([gradient, curvature], 1)
    flags = (bins[twofold] == 0).astype(np.float64)
    level = [0]
    for step in range(depth + 1):
        place = np.full(len(feature), -1)
        place[level] = np.arange(len(level))
        slot = place[at]
        slot[slot < 0] = len(level)  # rows that lie in leaves already
        n_slots = len(level) + 1
        g, h = (np.bincount(slot, weights=w, minlength=n_slots)[:-1] for w in (gradient, curvature))
        for n, leaf in enumerate(level):
            value[leaf] = float(-RATE * g[n] / (h[n] + SHRINK))
        if step == depth:
            break
        whole = g ** 2 / (h + SHRINK)
        best, split = np.full(len(level), 1e-6), [(0, 0)] * len(level)

        def offer(low_g, low_h, name):
            """Gains of cuts (nodes x cuts); ``name`` tells the feature and the edge of a cut."""
            high_g, high_h = g[:, None] - low_g, h[:, None] - low_h
            gain = low_g ** 2 / (low_h + SHRINK) + high_g ** 2 / (high_h + SHRINK) - whole[:, None]
            gain[(low_h < LEAST) | (high_h < LEAST)] = 0
            cut = gain.argmax(1)
            for n in np.flatnonzero(gain.max(1) > best):
                best[n], split[n] = gain[n, cut[n]], name(int(cut[n]))

        if len(twofold):
            sums = np.stack([flags @ (both * (slot == n)[:, None]) for n in range(len(level))])
            offer(sums[:, :, 0], sums[:, :, 1], lambda c: (int(twofold[c]), 0))
        for f in others:
            size = len(edges[f]) + 1
            cell = slot * size + bins[f]
            low_g, low_h = (np.bincount(cell, weights=w, minlength=n_slots * size).reshape(-1, size).cumsum(1)[:-1, :-1] for w in (gradient, curvature))
            offer(low_g, low_h, lambda c, f=f: (f, c))
        grown = []
        for n, leaf in enumerate(level):
            if best[n] > 1e-6:
                f, cut = split[n]
                first = len(feature)
                feature[leaf], threshold[leaf], left[leaf], right[leaf] = f, float(edges[f][cut]), first, first + 1
                for column, x in ((feature, 0), (threshold, np.inf), (value, 0.0)):
                    column += [x, x]
                left += [first, first + 1]
                right += [first, first + 1]
                rows = np.flatnonzero(at == leaf)
                at[rows] = first + (bins[f, rows] > cut)
                grown += [first, first + 1]
        level = grown
        if not level:
            break
    value = np.array(value)
    return (np.array(feature), np.array(threshold), np.array(left), np.array(right), value), value[at]


def boosted(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Tree]:
    """Trees that are added up to the logarithm of the odds, each fitted to the logistic loss of those before (Newton steps)."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    edges = [e[e < c.max()] for e, c in zip(edges, x.T, strict=True)]
    bins = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)])  # bin b: up to edge b
    margin, out = np.zeros(len(x)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree, step = _grown(bins, edges, p - y, p * (1 - p), depth)
        out.append(tree)
        margin += step
    return out


@lru_cache(maxsize=4)
def model(pages: int = TRAIN_PAGES, trees: int = TREES, depth: int = DEPTH) -> list[Tree]:
    """Boosted trees fitted on ``pages`` made pages; the same wherever and whenever they are fitted."""
    return boosted(*labelled(training_pages(pages)), trees, depth)


def probabilities(trees: list, x: np.ndarray) -> np.ndarray:
    margin = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, threshold, left, right, value in trees:
        at = np.zeros(len(x), np.int64)
        while True:
            step = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
            if (step == at).all():
                break
            at = step
        margin += value[at]
    return 1 / (1 + np.exp(-margin))


def decoded(nodes: Nodes, p: np.ndarray) -> list[bool]:
    """The most probable labelling in which every kept node's parent is kept; a leaf counts more the more words it has."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    weight = np.where(np.array(nodes.leaf, bool), 1 + np.log1p(nodes.words), 1.0)
    barred = (np.array(nodes.roles, np.int64) & DROP_BIT) > 0
    at = np.arange(len(nodes))
    end = np.where(np.array(nodes.leaf, bool), at + 1, np.maximum(nodes.end, at + 1))
    out = np.concatenate([[0.0], np.cumsum(weight * np.log1p(-p))])
    dropped = (out[end] - out[at]).tolist()
    kept = np.where(barred, -np.inf, weight * np.log(p)).tolist()
    parent = nodes.parent
    for n in range(len(nodes) - 1, -1, -1):  # children have higher numbers
        if parent[n] >= 0:
            kept[parent[n]] += max(kept[n], dropped[n])
    keep = [False] * len(nodes)
    for n in range(len(nodes)):
        keep[n] = kept[n] > dropped[n] and (parent[n] < 0 or keep[parent[n]])
    return keep


def texts(nodes: Nodes, trees: list) -> list[str]:
    """The main text of each page of ``nodes``."""
    keep = decoded(nodes, probabilities(trees, features(nodes)))
    out = []
    for first, last in nodes.pages:
        pieces, gap = [], False
        for n in range(first, last):
            if n in nodes.texts:
                gap |= nodes.gap[n]
                if keep[n]:
                    pieces += [" "] * gap + nodes.texts[n]
                    gap = False
        out.append(" ".join("".join(pieces).split()))
    return out


def extracted(pages: DataFrame, trees: list | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``)."""
    trees = trees or model()

    def run(batches):
        def rows():
            held, nodes, chars = [], Nodes(), 0

            def flush():
                for (page_id, url), text in zip(held, texts(nodes, trees), strict=True):
                    yield (page_id, url, text, len(text)), 2 * len(text)
            for b in batches:
                for part in slices(b.select(["page_id", "url", "html"])):
                    for page_id, url, page in zip(*(c.to_pylist() for c in part.columns), strict=True):
                        held.append((page_id, url))
                        nodes.parse(page or "")
                        chars += len(page or "")
                        if len(nodes) >= NODES or chars >= CHARS:
                            yield from flush()
                            held, nodes, chars = [], Nodes(), 0
            if held:
                yield from flush()
        yield from arrow_batches(rows(), _OUT)

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
