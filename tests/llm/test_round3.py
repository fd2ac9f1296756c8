"""Source divergence, vector codes and HTML extraction: brute force, held-out accuracy, odd tables."""

import hashlib
import html
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from veracity.llm import codes, divergence, htmltext
from veracity.llm.htmldom import Nodes

SF = "/root/testdata/sf0.001"


# --- source divergence -----------------------------------------------------------------
def brute_audit(rows, least, top):
    docs, n, groups = defaultdict(set), Counter(), set()
    for i, (lang, source, text) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""):
            term = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term)
            docs[lang, term].add(i)
            n[lang, source, term] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (k, t), ids in docs.items() if k == lang and len(ids) >= least)
        sources = sorted(s for k, s in groups if k == lang)

        def shares(counts):
            total = sum(counts)
            return [1 + 10 ** 9 * (c + 2) // (total + 2 * len(kept)) for c in counts]
        per = {s: shares([n[lang, s, t] for t in kept]) for s in sources}
        whole = shares([sum(n[lang, s, t] for s in sources) for t in kept])
        for s in sources:
            pairs = [(o, sum((p - q) ** 2 // (p + q) for p, q in zip(per[s], per[o], strict=True))) for o in sources if o != s]
            terms = [(t, (p - q) ** 2 // (p + q)) for t, p, q in zip(kept, per[s], whole, strict=True) if n[lang, s, t] and p > q]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found, 1) if part == "pair" or rank <= top]
    return sorted(out)


AUDIT = "doc_id long, text string, lang string, source string, value string, rank string, term string, n long"
AUDITED = pa.schema([(c, pa.string()) for c in ("lang", "source", "text")])


def audit_rows(seed, size, sources, vocabulary=40):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeÄéж") for _ in range(r.randint(1, 4))) for _ in range(vocabulary)]
    return [(r.choice(("en", "de", None, "")), "hot" if r.random() < 0.4 else f"s{r.randrange(sources)}",
             r.choice((" ", "-", "9\x01")).join(r.choice(words[:1 + r.randrange(vocabulary)]) for _ in range(r.randrange(40)))) for _ in range(size)]


@pytest.mark.parametrize("sources", [3, 300])  # 300: more groups than a tile has
def test_audit_matches_brute_force(spark, sources):
    rows = [*audit_rows(sources, 300, sources), (None, None, None), ("xx", "empty", ""), ("xx", "other", None), ("xx", None, "once"), ("zz", "alone", "Word " * 50)]
    df = spark.createDataFrame([(i, t, lang, s, "clash", "clash", "clash", 1) for i, (lang, s, t) in enumerate(rows)], AUDIT)
    assert sorted(map(tuple, divergence.audit(df, min_documents=4).collect())) == brute_audit(rows, 4, 10)


def test_audit_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], AUDIT)).collect() == []


def test_tiles_match_all_cells():
    r = np.random.default_rng(1)
    for rows, columns, share in ((1, 0, 0), (2, 1, 1), (5, 70, 0.1), (9, 300, 0.02), (17, 200, 0.9)):
        absent = r.integers(1, 50, rows)
        present = r.random((rows, columns)) < share
        shares = np.where(present, r.integers(1, 10 ** 9, (rows, columns)), absent[:, None])
        used = present.any(0)
        want = divergence._divergence(shares[:, None, :], shares[None, :, :]).sum(2)
        assert (divergence.tile(shares[:, used], absent, present[:, used], columns) == want).all()


def test_zero_quadrants_are_not_entered():
    leaves = np.zeros((8, 8), bool)
    leaves[0, 3] = leaves[5, 3] = True
    seen = list(divergence.traversed(divergence.occupied(leaves)))
    assert len(seen) == len(set(seen)) and {c for _, _, c in seen} == {3}
    assert {(min(i, j), max(i, j)) for i, j, _ in seen} == {(i, j) for i in range(8) for j in range(i, 8) if {i, j} & {0, 5}}


def test_long_texts_are_split_at_terms():
    text = ("abc Def-ж1" * 9).encode()
    whole = Counter(t for x in divergence.terms_of(text) for t in x if t)
    for piece in (1, 2, 3, 7):
        before, divergence.PIECE = divergence.PIECE, piece
        try:
            assert Counter(t for x in divergence.terms_of(text) for t in x if t) == whole
        finally:
            divergence.PIECE = before


@pytest.mark.parametrize("letters", [0, 1000])  # a source for each row and no text; long terms of one source
def test_counts_are_passed_on_by_their_bytes(monkeypatch, letters):
    monkeypatch.setattr(divergence, "HELD", 1_000_000)
    rows = [("en", "s" if letters else f"s{i}", f"{'ab'[i % 2]}{chr(0x4e00 + i) * (letters // 3)}" * 2 if letters else None) for i in range(60 * (100 if letters else 1000))]
    read, first, n, docs = 0, None, Counter(), Counter()

    def batches():
        nonlocal read
        for at in range(0, len(rows), len(rows) // 60):
            read += 1
            yield pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), x, strict=True)) for x in rows[at:at + len(rows) // 60]], AUDITED)

    for b in divergence._counted(batches()):
        first = first or read
        for x in b.to_pylist():
            n[x["lang"], x["source"], x["term"]] += x["n"]
            docs[x["lang"], x["source"], x["term"]] += x["docs"]
    want = Counter((lang, source, text) for lang, source, text in rows if text)
    assert {k: v for k, v in n.items() if k[2]} == want == {k: v for k, v in docs.items() if k[2]}
    assert {k[:2] for k in n if k[2] is None} == {x[:2] for x in rows}
    assert first <= 45  # the task has not read all its input by then


# --- vector codes ----------------------------------------------------------------------
def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dim = len(kept[0][2]) // parts
    cut = [[np.array(v[p * dim:(p + 1) * dim]) for p in range(parts)] for _, _, v in kept]
    books = [np.array([c[p] for c in cut[:entries]]) for p in range(parts)]

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (((c[p] - books[p][e]) ** 2).sum(), e)) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            for e in set(a[p] for a in at):
                mine = [c[p] for c, a in zip(cut, at, strict=True) if a[p] == e]
                books[p][e] = sum(mine) // len(mine)
    at = assign()
    errors = [sum(int(((c[p] - books[p][a[p]]) ** 2).sum()) for p in range(parts)) for c, a in zip(cut, at, strict=True)]
    labels = Counter()
    for (_, label, _), e in zip(kept, errors, strict=True):
        labels[label] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for row in b for x in row).encode()).hexdigest()
    return sorted((str(i), "".join(f"{x:02x}" for x in a), e, labels[label], sha) for (i, label, _), a, e in zip(kept, at, errors, strict=True))


VECTORS = "vec_id long, embedding array<float>, label int, code string, error string, ints int"


def test_codes_match_brute_force(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=8).astype(np.float32).tolist(), int(r.integers(3)) if i % 5 else None) for i in range(60)]
    rows += [(100 + i, rows[i % 3][1], 1) for i in range(30)]  # copies
    rows += [(7, rows[0][1], 0), (None, rows[1][1], 0), (200, [0.0] * 8, 2), (201, [float("nan")] + [0.0] * 7, 2), (202, None, 2), (203, [], 2),
             (204, [float("inf")] + [0.0] * 7, 2), (205, [None] + [1.0] * 7, 2), (206, [100.0] * 8, 2)]
    df = spark.createDataFrame([(*x, "clash", "clash", 0) for x in rows], VECTORS).repartition(5)
    for entries in (4, 256):
        got = sorted((str(x.vec_id), x.code, x.error, x.label_error, x.codebooks_sha256) for x in codes.compressed(df, entries=entries).collect())
        assert got == brute_codes(rows, entries=entries)


def test_codes_of_odd_tables(spark):
    assert codes.compressed(spark.createDataFrame([], VECTORS)).collect() == []
    other = [(1, [1.0] * 8, 1, "", "", 0), (2, [1.0] * 12, 1, "", "", 0), (3, [1.0] * 7, 1, "", "", 0), (4, [3e38] * 8, 1, "", "", 0)]
    assert [x.vec_id for x in codes.compressed(spark.createDataFrame(other, VECTORS)).collect()] == [1]


def test_equal_average_search_finds_the_nearest_with_fewer_comparisons():
    r = np.random.default_rng(0)
    for dim, n, size in ((16, 256, 400), (4, 7, 3), (1, 256, 2), (2, 256, 5000), (16, 256, 1 << 27)):
        parts, entries = r.integers(-size, size, (500, dim)), r.integers(-size, size, (n, dim))
        entries[n // 2] = entries[0]
        parts[5] = entries[0]
        index, best, compared = codes.nearest(parts, entries, step=2)
        away = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert (index == away.argmin(1)).all() and (best == away.min(1)).all()
        assert dim > 2 or compared.mean() < 0.5 * n or n < 10


# --- HTML extraction -------------------------------------------------------------------
def pages_of(folder):
    return pq.read_table(f"{folder}/pages.parquet").to_pydict()


def plain_article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner))).split())


def test_given_pages_give_their_articles(spark):
    table = pages_of(SF)
    got = {r.page_id: r.text for r in htmltext.extracted(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    assert got == {i: plain_article(h) for i, h in zip(table["page_id"], table["html"], strict=True)}


def test_held_out_accuracy():
    nodes = Nodes()
    pages = htmltext.training_pages(150, seed=4242)  # other layouts, words and texts than those fitted
    for p in pages:
        nodes.parse(p)
    found = wanted = both = 0
    for (a, b), text in zip(nodes.pages, htmltext.texts(nodes, htmltext.model()), strict=True):
        want = Counter(w for k in range(a, b) if k in nodes.texts and htmltext.MARK in "".join(nodes.texts[k]) for w in "".join(nodes.texts[k]).replace(htmltext.MARK, "").split())
        got = Counter(text.replace(htmltext.MARK, "").split())
        found, wanted, both = found + sum(got.values()), wanted + sum(want.values()), both + sum((want & got).values())
    assert both / found > 0.95 and both / wanted > 0.95


LAYOUT = """<html><body class="home has-sidebar"><header id=masthead><a href=/>Logo Times</a><p>The daily paper of the town.</p></header>
<nav><ul><li><a href=a>World</a><li><a href=b>Sport</a></ul></nav>
<div class="cookie-consent">We use cookies. Please accept them all to go on reading this page.<button>Accept</button></div>
<main><article><h1>Town &amp; river</h1><p>The river rose by two metres on Monday, the town council said.<p>Nobody was <i>hurt</i>, it added.
<div class="advertisement">Buy new boots now, only today, at half the price.</div>
<ul><li>First point of the council</li><li>Second point</li></ul><p>More is known on Friday&nbsp;at noon.</p></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I saw the river myself and it was much higher than that.</p></div></section></main>
<aside class="sidebar"><h3>Most read</h3><p>A dog found its way home after three years.</p></aside>
<form action=/s><label>Search</label><input name=q></form><footer>&copy; Logo Times. All rights reserved.</footer><script>var a = "<p>no</p>";</script></body></html>"""
WANTED = "Town & river The river rose by two metres on Monday, the town council said. Nobody was hurt, it added. First point of the council Second point More is known on Friday at noon."


def test_a_page_of_another_layout():
    nodes = Nodes()
    nodes.parse(LAYOUT)
    assert htmltext.texts(nodes, htmltext.model()) == [WANTED]


def test_decoding_keeps_nothing_below_what_is_dropped():
    r = np.random.default_rng(5)
    nodes = Nodes()
    for p in htmltext.training_pages(20, seed=11):
        nodes.parse(p)
    for _ in range(5):
        keep = htmltext.decoded(nodes, r.random(len(nodes)))
        assert all(keep[p] for p, k in zip(nodes.parent, keep, strict=True) if k and p >= 0) and any(keep) and not all(keep)


def test_decoding_is_the_best_labelling():
    nodes = Nodes()
    nodes.parse("<div><p>a</p><nav><p>b c d</p></nav></div>")
    n, r = len(nodes), np.random.default_rng(6)
    weight = np.where(np.array(nodes.leaf, bool), 1 + np.log1p(nodes.words), 1.0)
    for _ in range(30):
        p = r.random(n)
        score = {}
        for bits in range(1 << n):
            keep = [bool(bits >> k & 1) for k in range(n)]
            if all(keep[q] for q, k in zip(nodes.parent, keep, strict=True) if k and q >= 0):
                score[tuple(keep)] = (weight * np.log(np.where(keep, p, 1 - p))).sum()
        assert tuple(htmltext.decoded(nodes, p.copy())) == max(score, key=score.get)


@pytest.mark.parametrize("page", ["", "<", "a < b & c", "</p></div>", "<p", "<a href=\"x", "<!-- never ends", "<script>never ends", "<p>" * 3000, "<div>" * 3000 + "x", "<b>" * 2000 + "y",
                                  "</x>" * 3000, "<td><tr><table></li>", "<a \"" * 2000, "&am &amp &#x41; &bogus;", "\x00<\x00>", "<![CDATA[x]]><?php x ?>", "<p>é" * 500, "x" * 300_000])
def test_odd_pages_are_read(page):
    nodes = Nodes()
    nodes.parse(page)
    assert nodes.pages == [(0, len(nodes))] and nodes.end[0] == len(nodes)
    assert isinstance(htmltext.texts(nodes, htmltext.model())[0], str)


def test_extraction_of_odd_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "c", "c"), (None, "u", LAYOUT, "c", "c"), (1, "v", LAYOUT, "c", "c"), (3, "w", "", "c", "c"), (4, "x", LAYOUT.replace("Nobody", "Nobody " * 200_000), "c", "c")]
    got = [(r.page_id, r.url, r.n_chars) for r in htmltext.extracted(spark.createDataFrame(rows, schema)).collect()]
    assert got == [(1, None, 0), (None, "u", len(WANTED)), (1, "v", len(WANTED)), (3, "w", 0), (4, "x", len(WANTED) + 7 * 199_999 + 0)]
    assert htmltext.extracted(spark.createDataFrame([], schema)).collect() == []
