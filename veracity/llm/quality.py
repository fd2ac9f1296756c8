"""Quality rules as weak supervision.

Every rule looks at the statistics of one text and votes good (1), bad (-1)
or abstains (0). No vote decides alone: expectation-maximisation estimates,
for either quality, how often each rule casts each vote, and a text's
posterior probability of being good is what its votes say together.

Votes are compared over the whole corpus, but only the counts of vote
patterns are needed for that, at most ``3 ** len(RULES)`` rows whatever the
corpus holds. They are aggregated on the executors, the model is fitted on
them, and the posterior of each seen pattern goes back as a small table.

Defined results: a null text has no words and, as an empty one, fails the
base rules; rows repeat and tie freely, since each is judged alone; an empty
table gives an empty one; other columns pass through :func:`quality` untouched,
except that columns named as its own are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.llm.base import WORD_RE, slices, windows, word_ids

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Votes by name; thresholds are read in the order (good if, bad if).
RULES = ("length", "symbols", "dup_lines", "repeats", "word_length", "letters", "sentences", "bare_words")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in STATS] + [T.StructField("votes", T.StringType())])


def repeated_words(words: list[str], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words)
    if n <= width:
        return 0
    ids = word_ids(words)
    # no repeated window without a repeated pair and a repeated foursome: most texts end here
    for short in (2, 4):
        if short < width and (r := windows(ids, short)).max() + 1 == len(r):
            return 0
    rank = windows(ids, width)
    starts = np.flatnonzero(np.bincount(rank)[rank] > 1)
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int((np.cumsum(covered)[:n] > 0).sum())


def _vote(good: bool, bad: bool) -> int:
    return 1 if good and not bad else -1 if bad else 0


def judge(text: str | None) -> tuple:
    """Statistics of a text and its votes, a string of ``+``, ``-`` and ``0``."""
    text = text or ""
    words = WORD_RE.findall(text)
    n = len(words)
    chars = sum(map(len, words))
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD_RE.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeats = repeated_words(words)
    some = max(n, 1)
    letters = sum(map(str.isalpha, text)) / max(chars, 1)
    bare = sum(not w[0].isalnum() and len(w) == 1 for w in words) / some  # lone marks between words
    ends = sum(w[-1] in ".!?…" for w in words) / some
    votes = (
        _vote(n >= 60, n < 20),
        _vote(symbols <= 0.005 * n, symbols > 0.05 * n),
        _vote(lines >= 4 and not dup, dup > 0.3 * lines),
        _vote(n >= 60 and repeats <= 0.02 * n, repeats > 0.3 * n),
        _vote(3 <= chars / some <= 10, not 2 <= chars / some <= 16),
        _vote(letters >= 0.9, letters < 0.75),
        _vote(0.02 <= ends <= 0.3, n >= 40 and not 0.004 <= ends <= 0.5),
        _vote(bare <= 0.005, bare > 0.05),
    )
    return n, chars, symbols, dup, repeats, "".join("-0+"[v + 1] for v in votes)


@F.arrow_udf(_SCHEMA)
def _judge_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kinds = pa.struct([(f.name, pa.string() if f.name == "votes" else pa.int64()) for f in _SCHEMA])
    for texts in batches:
        parts = [pa.StructArray.from_arrays(
            [pa.array(c, k.type) for c, k in zip(zip(*map(judge, part.to_pylist()), strict=True), kinds, strict=True)], fields=list(kinds))
            for part in slices(texts)]
        yield pa.concat_arrays(parts) if parts else pa.array([], kinds)


#: Not evaluated a second time where a filter stands on its result.
_judged = _judge_all.asNondeterministic()


def fit_votes(patterns: list[str], counts: list[int], rounds: int = 100, prior: float = 0.9,
              weight: float = 0.05, tol: float = 1e-10) -> tuple[np.ndarray, dict[str, float]]:
    """Expectation-maximisation over vote patterns.

    Returns ``accuracy[rule, quality, vote]`` (quality 0 bad, 1 good; vote 0
    bad, 1 abstain, 2 good) and the posterior probability of good by pattern.
    ``weight`` is the weight, as a share of the corpus, of the belief that
    rules are more often right than wrong, which also keeps the two
    qualities from changing places. ``prior`` is the share of good texts to
    start from."""
    rules = len(patterns[0]) if patterns else len(RULES)
    votes = np.array([["-0+".index(v) for v in p] for p in patterns], int).reshape(-1, rules)
    seen = np.array(counts, float)
    total = max(seen.sum(), 1.0)
    belief = np.array([[0.50, 0.40, 0.10], [0.02, 0.38, 0.60]])
    onehot = np.eye(3)[votes]  # pattern, rule, vote
    share = prior
    accuracy = np.broadcast_to(belief, (rules, 2, 3)).copy()
    post = np.zeros(len(patterns))
    for _ in range(rounds):
        score = np.einsum("prv,rqv->pq", onehot, np.log(accuracy)) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))
        moved, post = float(np.abs(new - post).max(initial=0)), new
        for q, part in ((0, 1 - post), (1, post)):
            cast = np.einsum("p,prv->rv", seen * part, onehot) + weight * total * belief[q]
            accuracy[:, q] = cast / cast.sum(1, keepdims=True)
        share = (float(seen @ post) + weight * total * prior) / (total * (1 + weight)) if len(patterns) else prior
        if moved < tol:
            break
    return accuracy, dict(zip(patterns, post.tolist(), strict=True))


def judged(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the statistics and the ``votes`` to every row."""
    own = [c for c in docs.columns if c not in (*STATS, "votes")]
    return docs.withColumn("__judged", _judged(F.col(text_col))).select(*own, "__judged.*")


def posteriors(votes: DataFrame, **fit) -> DataFrame:
    """``votes`` and ``p_good`` for each pattern seen; at most ``3 ** rules`` rows."""
    seen = votes.groupBy("votes").count().collect()
    _, post = fit_votes([r["votes"] for r in seen], [r["count"] for r in seen], **fit)
    return votes.sparkSession.createDataFrame(sorted(post.items()), "votes string, p_good double")


def quality(stats: DataFrame, post: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add ``p_good``, ``base_failed`` and ``kept`` to rows from :func:`judged`."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = stats.drop("p_good", "base_failed", "kept").join(F.broadcast(post), "votes", "left")
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("p_good", F.lit(0.0)) >= threshold))


def quality_filter(docs: DataFrame, **fit) -> DataFrame:
    """The documents that the rules together take for good, columns as they came.

    The text is judged once for the model and once for the filter, so that no
    copy of the corpus is written in between."""
    text = docs.select("text")
    post = posteriors(judged(text).select("votes"), **fit)
    held = docs.withColumn("__row", F.struct(*docs.columns)).select("__row", F.col("__row.text").alias("text"))
    return quality(judged(held), post).filter("kept").select("__row.*")
