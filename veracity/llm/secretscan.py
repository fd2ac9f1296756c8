"""Secret scans: a keyword automaton, anchored expressions near its hits, checksums.

An Aho-Corasick automaton passes over a text once and reports the keywords
that a secret can begin with; an expression is tried only where its keyword
stands, anchored there. Kinds whose value carries its own checksum are kept
only if it holds. Hexadecimal runs have no keyword: one scan for runs that are
long enough finds those.

Matches of a kind are leftmost and don't overlap, those that are too short
included: as every match begins with a keyword, going through the hits in
order and skipping those inside the last match gives just that. Letter case is
ASCII's.

Defined results: a null text is empty and has no spans; each row is scanned by
itself, so ties and repeats don't matter; an empty table gives an empty one.
:func:`redacted` keeps the columns that came, :func:`scanned` those not named
like its own.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.llm.base import slices

# --- fixed values: the kinds' expressions ---------------------------------------------
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
#: Tokens of 30 base-62 characters and 6 that hold the CRC-32 of those.
CHECKED = r"(?:gh[oprsu]|npm)_[A-Za-z0-9]+"
# --------------------------------------------------------------------------------------

_BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase


def checksum62(body: str) -> str:
    """CRC-32 in six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = _BASE62[digit] + out
    return out


def _checked(m: re.Match) -> bool:
    value = m[0].partition("_")[2]
    return len(value) == 36 and checksum62(value[:30]) == value[30:]


#: kind: (keywords in lower case, expression, what else must hold), in listed order; hex has no keyword.
KINDS: dict[str, tuple[tuple[str, ...], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), re.compile(ASSIGN, re.I | re.A), lambda m: len(m[2]) >= 12),
    "access": (("akia",), re.compile(ACCESS), lambda m: len(m[0]) >= 18),
    "hex": ((), re.compile(HEX), lambda m: True),
    "checked": (("gho_", "ghp_", "ghr_", "ghs_", "ghu_", "npm_"), re.compile(CHECKED), _checked),
}
BASE = ("assign", "access", "hex")
_ASCII_LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}


@cache
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, (words, _, _) in KINDS.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start, then kind as listed."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):  # some capitals have two letters in lower case
        low = text.translate(_ASCII_LOWER)
    starts: dict[str, list[int]] = {}
    for last, (kind, length) in _automaton().iter(low):
        starts.setdefault(kind, []).append(last - length + 1)
    found = []
    for n, (kind, (words, expression, holds)) in enumerate(KINDS.items()):
        if not words:
            found += [(m.start(), n, m.end()) for m in expression.finditer(text)]
            continue
        at = 0
        for start in sorted(starts.get(kind, ())):
            if start >= at and (m := expression.match(text, start)):
                at = m.end()
                if holds(m):
                    found.append((start, n, at))
    kinds = list(KINDS)
    return [(kinds[n], start, end) for start, n, end in sorted(found)]


def redact(text: str | None, mark: str = "<SECRET>") -> str | None:
    """The text with every span, or run of spans that overlap, replaced."""
    out, at = [], 0
    for _, start, end in spans(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


_FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex")]
                      + [T.StructField(c, T.StringType()) for c in ("base_sha256", "spans")])


def summary(text: str | None) -> tuple:
    found = spans(text)
    listed = lambda kinds: ",".join(f"{k}:{a}:{b}" for k, a, b in found if k in kinds)
    counts = [sum(k == kind for k, _, _ in found) for kind in BASE]
    return *counts, hashlib.sha256(listed(BASE).encode()).hexdigest(), listed(KINDS)


@F.arrow_udf(_FOUND)
def _scan_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kinds = pa.struct([(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in _FOUND])
    for texts in batches:
        parts = [pa.StructArray.from_arrays(
            [pa.array(c, k.type) for c, k in zip(zip(*map(summary, part.to_pylist()), strict=True), kinds, strict=True)], fields=list(kinds))
            for part in slices(texts)]
        yield pa.concat_arrays(parts) if parts else pa.array([], kinds)


@F.arrow_udf(T.StringType())
def _redact_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.concat_arrays([pa.array(map(redact, part.to_pylist()), pa.string()) for part in slices(texts)] or [pa.array([], pa.string())])


#: Not evaluated again for each column that is made of their result.
_scan, _redact = _scan_all.asNondeterministic(), _redact_all.asNondeterministic()


def scanned(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_assign, n_access, n_hex, base_sha256, spans`` to every row."""
    own = [c for c in docs.columns if c not in _FOUND.names]
    return docs.withColumn("__found", _scan(F.col(text_col))).select(*own, "__found.*")


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with secrets replaced; ``n_chars``, if there, follows the text."""
    out = docs.withColumn(text_col, _redact(F.col(text_col)))
    if "n_chars" in docs.columns:
        chars = F.coalesce(F.length(text_col), F.lit(0)).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNull(), F.col("n_chars")).otherwise(chars))
    return out
