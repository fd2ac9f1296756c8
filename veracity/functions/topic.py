"""A topic query written as text, compiled to a Column.

Words and ``"phrases"`` match whole words whatever their case; ``OR``, ``AND``
and ``NOT`` (upper case), a leading ``-``, parentheses, ``lang:xx`` and
``is:flag``. Terms that stand side by side must all hold. ``NOT`` binds
closest, then ``AND``, then ``OR``. The tree is simplified before it becomes an
expression: nested lists of one kind are one, repeats are dropped, double
negations go, and all words of an ``OR`` are one regular expression, so a text
is searched once for them.

Every condition is true or false: a null text has no words, a null language
isn't any, a null flag isn't set; so negations of these hold.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracity.functions.common import as_col
from veracity.functions.text import topic_match

_PIECE = re.compile(r'\s*(?:(?P<open>\()|(?P<close>\))|(?P<minus>-)(?=\S)|(?P<field>[A-Za-z]+):(?P<value>[^\s()"]+)|"(?P<phrase>[^"]*)"|(?P<word>[^\s()"]+)|(?P<end>\Z)|(?P<bad>.))')


class TopicSyntaxError(ValueError):
    """What is wrong with a topic query, and where."""

    def __init__(self, query: str, at: int, what: str):
        super().__init__(f"{what} at {at}: {query[:at]}>>>{query[at:]}")
        self.at = at


class Node(NamedTuple):
    """``kind`` is any, all, not, term, lang or is; ``parts`` are nodes, or the one text of a leaf."""

    kind: str
    parts: tuple


def _pieces(query: str) -> list[tuple[str, str, int]]:
    out, at = [], 0
    while not out or out[-1][0] != "end":
        m = _PIECE.match(query, at)
        kind = m.lastgroup if m.lastgroup != "value" else "field"
        start = m.start(kind)
        if kind == "bad":
            raise TopicSyntaxError(query, start, "a quote that never ends" if m["bad"] == '"' else "an unexpected sign")
        if kind == "field":
            out.append((m["field"].lower(), m["value"], start))
        elif kind == "word" and m["word"] in ("OR", "AND", "NOT"):
            out.append((m["word"], m["word"], start))
        else:
            out.append((kind, m[kind], start))
        at = m.end()
    return out


def parse(query: str) -> Node:
    """The simplified tree of a topic query."""
    pieces = _pieces(query)
    place = 0

    def fail(what):
        raise TopicSyntaxError(query, pieces[place][2], what)

    def listed(kind, item, goes_on):
        parts = [item()]
        while goes_on():
            parts.append(item())
        return parts[0] if len(parts) == 1 else Node(kind, tuple(parts))

    def took(kind):
        nonlocal place
        if pieces[place][0] == kind:
            place += 1
            return True
        return False

    def any_of():
        return listed("any", all_of, lambda: took("OR"))

    def all_of():
        return listed("all", one, lambda: took("AND") or pieces[place][0] not in ("OR", "close", "end"))

    def one():
        nonlocal place
        kind, text, _ = pieces[place]
        if kind in ("minus", "NOT"):
            place += 1
            return Node("not", (one(),))
        if took("open"):
            inside = any_of()
            if not took("close"):
                fail("a missing )")
            return inside
        if kind in ("word", "phrase"):
            words = " ".join(text.split())
            if not words:
                fail("an empty phrase")
            place += 1
            return Node("term", (words.lower(),))
        if kind in ("lang", "is"):
            place += 1
            return Node(kind, (text.lower(),))
        fail("a term is missing" if kind in ("end", "close", "OR", "AND") else f"an unknown field {kind}:")

    tree = any_of()
    if pieces[place][0] != "end":
        fail("a ) too many")
    return simplified(tree)


def simplified(node: Node) -> Node:
    """The same condition with one list for nested ones, without repeats and double negations."""
    if node.kind == "not":
        inner = simplified(node.parts[0])
        return inner.parts[0] if inner.kind == "not" else Node("not", (inner,))
    if node.kind not in ("any", "all"):
        return node
    parts: dict[Node, None] = {}
    for p in map(simplified, node.parts):
        parts.update(dict.fromkeys(p.parts if p.kind == node.kind else (p,)))
    return Node(node.kind, tuple(parts)) if len(parts) > 1 else next(iter(parts))


def condition(node: Node, text, lang=None, flags: Mapping[str, object] | None = None) -> Column:
    """The Column of a tree; never null. A language or flag without a column is an error."""
    if node.kind == "term":
        return topic_match(text, node.parts)
    if node.kind == "lang":
        if lang is None:
            raise ValueError("the query asks for a language, and there is no such column")
        return F.coalesce(F.lower(as_col(lang)) == node.parts[0], F.lit(False))
    if node.kind == "is":
        if node.parts[0] not in (flags or {}):
            raise ValueError(f"the query asks for is:{node.parts[0]}, and there is no such flag")
        return F.coalesce(as_col(flags[node.parts[0]]).cast("boolean"), F.lit(False))
    if node.kind == "not":
        return ~condition(node.parts[0], text, lang, flags)
    terms = [p for p in node.parts if p.kind == "term"] if node.kind == "any" else []
    rest = [condition(p, text, lang, flags) for p in node.parts if p not in terms]
    found = [topic_match(text, [t.parts[0] for t in terms])] if terms else []
    return reduce(Column.__or__ if node.kind == "any" else Column.__and__, found + rest)


def topic_query(query: str, text="text", lang=None, flags: Mapping[str, object] | None = None) -> Column:
    """Whether a row meets the query."""
    return condition(parse(query), text, lang, flags)
