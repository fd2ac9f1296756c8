"""Chat formatting: a small template language compiled to Python closures.

A template is parsed to a syntax tree, constants are folded, and the tree is
turned into nested closures that yield ``(text, in_generation)`` pieces while
they walk over the messages. The language has ``{{ expr }}``, ``{% for m in
messages %}``, ``{% if %} / {% elif %} / {% else %} / {% endif %}`` and
``{% generation %} / {% endgeneration %}``; an expression has strings, ``true``
and ``false``, names, ``m.field``, ``loop.first``, ``loop.index``, ``~``
(concatenation), ``==``, ``!=``, ``not``, ``and``, ``or``, parentheses and the
filters of :data:`FILTERS`. Names resolve to the message's fields and the
given constants, nothing else: no attribute of a Python object can be reached.

Messages come from rows sorted by conversation and turn, and pieces leave as
rows of bounded size, so that a conversation of any length streams through.

Defined results: null texts and roles are empty, a null turn comes first, a
null conversation id is a conversation of its own; repeated rows are turns of
their own, and rows that tie on the turn go by role and text. An empty table
gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from veracity.llm.base import arrow_batches, arrow_rows

#: Marks of the format; inside texts a backslash breaks them.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|role|>")
TEMPLATE = (
    "{% for m in messages %}<s>{{ m.role | escape }}<|role|>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ '[INST]' ~ ' ' }}{{ m.text | escape }}{{ ' ' ~ '[/INST]' }}{% endif %}</s>\n{% endfor %}"
)
CHUNK = 1 << 20

_CONTROL_RE = re.compile("|".join(map(re.escape, CONTROL)))


def escape(text: str) -> str:
    """Double every backslash and put one after the first character of a mark."""
    text = text.replace("\\", "\\\\")
    return _CONTROL_RE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "trim": lambda s: s.strip(" \t\r\n"), "lower": str.lower, "upper": str.upper,
}

# --- parsing ---------------------------------------------------------------------------
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(==|!=|[~|().])|([A-Za-z_]\w*))")


class TemplateError(ValueError):
    pass


class _Expr:
    """Recursive descent over one expression; nodes are tuples with a kind first."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            if not (m := _TOKEN.match(source, at)):
                raise TemplateError(f"cannot read {source[at:]!r}")
            text, sign, name = m.groups()
            self.tokens.append(("str", re.sub(r"\\(.)", lambda x: {"n": "\n", "t": "\t"}.get(x[1], x[1]), text[1:-1], flags=re.S))
                               if text is not None else ("sign", sign) if sign else ("name", name))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values

    def take(self) -> tuple[str, str]:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self) -> tuple:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def chain(self, below: Callable[[], tuple], *signs: str) -> tuple:
        node = below()
        while self.peek(*signs):
            node = (self.take()[1], node, below())
        return node

    def either(self) -> tuple:
        return self.chain(self.both, "or")

    def both(self) -> tuple:
        return self.chain(self.negated, "and")

    def negated(self) -> tuple:
        if self.peek("not"):
            self.take()
            return ("not", self.negated())
        return self.chain(self.joined, "==", "!=")

    def joined(self) -> tuple:
        return self.chain(self.filtered, "~")

    def filtered(self) -> tuple:
        node = self.atom()
        while self.peek("|"):
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def atom(self) -> tuple:
        kind, value = self.take()
        if kind == "str":
            return ("const", value)
        if value == "(":
            node = self.either()
            if self.take()[1] != ")":
                raise TemplateError("a parenthesis isn't closed")
            return node
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false"):
            return ("const", value == "true")
        if self.peek("."):
            self.take()
            field_kind, field = self.take()
            if field_kind != "name" or field.startswith("_"):
                raise TemplateError(f"no field {field!r}")
            return ("field", value, field)
        return ("name", value)


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        parts += [("text", source[at:m.start()])] if m.start() > at else []
        parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts += [("text", source[at:])] if at < len(source) else []
    place = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal place
        nodes = []
        while place < len(parts):
            kind, body = parts[place]
            place += 1
            if kind == "text":
                nodes.append(("const", body))
            elif kind == "out":
                nodes.append(_Expr(body).whole())
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return ("block", *nodes), body
                if word == "for":
                    m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+messages", rest.strip())
                    if not m:
                        raise TemplateError(f"only messages can be walked over: {body!r}")
                    inner, _ = block("endfor")
                    nodes.append(("for", m[1], inner))
                elif word == "generation":
                    inner, _ = block("endgeneration")
                    nodes.append(("generation", inner))
                elif word == "if":
                    nodes.append(branch(rest))
                else:
                    raise TemplateError(f"unexpected tag {body!r}")
        if ends:
            raise TemplateError(f"{ends[0]} is missing")
        return ("block", *nodes), ""

    def branch(condition: str) -> tuple:
        then, end = block("elif", "else", "endif")
        if end.startswith("elif"):
            other = branch(end[4:])
        else:
            other = block("endif")[0] if end == "else" else ("block",)
        return ("if", _Expr(condition).whole(), then, other)

    return block()[0]


# --- folding ---------------------------------------------------------------------------
def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _apply(kind: str, *values):
    if kind == "~":
        return _text(values[0]) + _text(values[1])
    if kind in ("==", "!="):
        return (values[0] == values[1]) == (kind == "==")
    return not values[0]


def fold(node: tuple, constants: dict | None = None) -> tuple:
    """Compute what doesn't depend on messages and join neighbouring constants."""
    again = lambda x: fold(x, constants)
    kind = node[0]
    if kind == "name" and node[1] in (constants or {}):
        return ("const", constants[node[1]])
    if kind in ("~", "==", "!=", "not"):
        args = [again(x) for x in node[1:]]
        return ("const", _apply(kind, *(x[1] for x in args))) if all(x[0] == "const" for x in args) else (kind, *args)
    if kind in ("and", "or"):
        left, right = again(node[1]), again(node[2])
        if left[0] == "const":
            return right if bool(left[1]) == (kind == "and") else left
        return (kind, left, right)
    if kind == "filter":
        inner = again(node[2])
        return ("const", FILTERS[node[1]](_text(inner[1]))) if inner[0] == "const" else ("filter", node[1], inner)
    if kind == "if":
        condition = again(node[1])
        if condition[0] == "const":
            return again(node[2] if condition[1] else node[3])
        return ("if", condition, again(node[2]), again(node[3]))
    if kind in ("for", "generation"):
        return (*node[:-1], again(node[-1]))
    if kind == "block":
        flat: list[tuple] = []
        for x in map(again, node[1:]):
            for y in x[1:] if x[0] == "block" else (x,):
                if y[0] == "const" and flat and flat[-1][0] == "const":
                    flat[-1] = ("const", _text(flat[-1][1]) + _text(y[1]))
                elif y != ("const", ""):
                    flat.append(y)
        return ("block", *flat)
    return node


# --- closures --------------------------------------------------------------------------
Piece = tuple[str, bool]


def _value(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda env, v=node[1]: v
    if kind == "name":
        return lambda env, n=node[1]: env.get(n)
    if kind == "field":
        def field(env, owner=node[1], name=node[2]):
            held = env.get(owner)
            return held.get(name) if isinstance(held, dict) else None
        return field
    if kind == "filter":
        inner, f = _value(node[2]), FILTERS[node[1]]
        return lambda env: f(_text(inner(env)))
    args = [_value(x) for x in node[1:]]
    if kind == "and":
        return lambda env: args[0](env) and args[1](env)
    if kind == "or":
        return lambda env: args[0](env) or args[1](env)
    return lambda env: _apply(kind, *(a(env) for a in args))


def _pieces(node: tuple, marked: bool = False) -> Callable[[dict], Iterator[Piece]]:
    kind = node[0]
    if kind == "block":
        inner = [_pieces(x, marked) for x in node[1:]]
        return lambda env: itertools.chain.from_iterable(f(env) for f in inner)
    if kind == "generation":
        return _pieces(node[1], True)
    if kind == "if":
        condition, then, other = _value(node[1]), _pieces(node[2], marked), _pieces(node[3], marked)
        return lambda env: then(env) if condition(env) else other(env)
    if kind == "for":
        body = _pieces(node[2], marked)

        def walk(env):
            for i, message in enumerate(env["messages"]):
                yield from body({**env, node[1]: message, "loop": {"first": i == 0, "index": i + 1}})
        return walk
    value = _value(node)

    def out(env):
        if text := _text(value(env)):
            yield text, marked
    return out


def compile_template(source: str, constants: dict | None = None) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """``messages -> (text, in_generation) pieces``; messages may be an iterator."""
    run = _pieces(fold(parse(source), constants))
    return lambda messages: run({"messages": messages})


# --- Spark -----------------------------------------------------------------------------
_RENDERED = "conv_id long, chunk long, formatted string, loss array<struct<start:int,end:int>>"
_READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
         "formatted_chars long, loss_spans long")


_RENDERED_ARROW = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("formatted", pa.string()),
                             ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
_READ_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("loss_spans", pa.int64())])


def _render(template: str, constants: dict | None, chunk: int):
    def chunks(conv, pieces):
        n, size, held, loss = 0, 0, [], []
        for text, marked in pieces:
            held.append(text)
            if marked:
                if loss and loss[-1][1] == size:
                    loss[-1] = (loss[-1][0], size + len(text))
                else:
                    loss.append((size, size + len(text)))
            size += len(text)
            if size >= chunk:
                yield conv, n, "".join(held), [{"start": a, "end": b} for a, b in loss]
                n, size, held, loss = n + 1, 0, [], []
        if held or not n:
            yield conv, n, "".join(held), [{"start": a, "end": b} for a, b in loss]

    def run(batches):
        form = compile_template(template, constants)

        def out():
            rows = arrow_rows(batches, "conv_id", "role", "text")
            for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
                messages = ({"role": r or "", "text": t or ""} for _, r, t in group)
                for row in chunks(conv, form(messages)):
                    yield row, len(row[2])
        yield from arrow_batches(out(), _RENDERED_ARROW)
    return run


def render(messages: DataFrame, template: str = TEMPLATE, constants: dict | None = None, chunk: int = CHUNK) -> DataFrame:
    """Format conversations (rows ``conv_id, turn, role, text``).

    Returns ``conv_id, chunk, formatted, loss``: the formatted text in chunks
    of about ``chunk`` characters, most often one, and the spans under the
    loss mask within each. The rows of a conversation are neighbours, in
    order. Only its sort holds a conversation, and that spills."""
    parse(template)  # fails here rather than in a task
    return (
        messages.select("conv_id", "turn", "role", "text").repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_render(template, constants, chunk), _RENDERED)
    )


_TURN = re.compile(r"<s>(.*?)<\|role\|>(.*?)</s>\n", re.S)


class _Reader:
    """Digests of one conversation, fed with its chunks in order."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.chars = self.loss_chars = self.spans = 0
        self.rest = self.cut = ""

    def feed(self, text: str, loss: list[dict]) -> None:
        self.chars += len(text)
        self.rest += text
        at = 0
        while m := _TURN.match(self.rest, at):
            body = m[2]
            if body.startswith("[INST] "):
                body = body.removeprefix("[INST] ").removesuffix(" [/INST]")
            self.turns.update(f"{unescape(m[1])}\n{unescape(body)}\n".encode())
            self.n += 1
            at = m.end()
        self.rest = self.rest[at:]
        for span in loss:
            self.spans += 1
            masked = unescape(text[span["start"]:span["end"]])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())


def _read_back(batches):
    def out():
        for conv, group in itertools.groupby(arrow_rows(batches, "conv_id", "formatted", "loss"), key=lambda r: r[0]):
            reader = _Reader()
            for _, text, loss in group:
                reader.feed(text, loss)
            if reader.rest:
                raise ValueError(f"conversation {conv}: text outside turns: {reader.rest[:80]!r}")
            yield (conv, reader.n, reader.turns.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars, reader.spans), 300
    yield from arrow_batches(out(), _READ_ARROW)


def read_back(rendered: DataFrame) -> DataFrame:
    """Parse what :func:`render` made with :data:`TEMPLATE` back into turns.

    Needs the rows of a conversation together and in order, as they leave
    :func:`render`; no shuffle stands between the two."""
    return rendered.mapInArrow(_read_back, _READ)
