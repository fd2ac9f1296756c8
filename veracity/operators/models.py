"""Linear models on TF-IDF features.

A model is fitted by a truncated Newton method on every labelled row. The rows
stay on the executors (:class:`SparkRows`): a gradient or a product with the
Hessian is one pass over stored rows, whose partial vectors are added up in a
tree, so the driver holds coefficients only. Models that are fitted on the same
rows share their passes. A caller that names ``max_rows`` has a model of that
many rows, those with the smallest hash of the id, fitted in the driver's
memory; no query does. Scoring covers every row: a model is a table of
coefficients by term, at most ``TFIDF_MAX_FEATURES`` rows, joined to the term
weights.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.functions.common import hash32, sigmoid
from veracity.operators.features import broadcast_within, tfidf_fit, tfidf_rows, tfidf_transform
from veracity.operators.prefix import prefix_sums
from veracity.session import materialize

# --- fixed values that must equal the reference's -----------------------------
C_REG = 1.0
CALIBRATION_FOLDS = 3
# ------------------------------------------------------------------------------


def linear_score(docs: DataFrame, weights: DataFrame, coef: DataFrame, id_col: str,
                 intercept: float = 0.0) -> DataFrame:
    """M10 (linear form): P(real) = sigmoid(sum(weight * coef) + intercept).

    ``weights`` is the long TF-IDF table (:func:`tfidf_transform`); ``coef``
    is ``(term, coef)``, at most ``max_features`` rows. Documents without any
    vocabulary term get the intercept alone."""
    m = weights.join(broadcast_within(coef), "term").groupBy(id_col).agg(
        F.sum(F.col("weight") * F.col("coef")).alias("margin"))
    j = docs.select(id_col).join(m, id_col, "left")
    return j.select(id_col, sigmoid(F.coalesce(F.col("margin"), F.lit(0.0)) + F.lit(intercept)).alias("score"))


class Sparse(NamedTuple):
    """Rows of a sparse matrix as coordinates, with labels 0/1."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    label: np.ndarray
    width: int

    def times(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * v[self.column], len(self.label))

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], self.width)

    def only(self, rows: np.ndarray) -> "Sparse":
        place = np.cumsum(rows) - 1
        keep = rows[self.row]
        return Sparse(place[self.row[keep]], self.column[keep], self.value[keep], self.label[rows], self.width)


def _balanced(label: np.ndarray) -> np.ndarray:
    """M4 for the sample: ``n / (classes * n_class)`` for each row."""
    n = np.bincount(label, minlength=2)
    return (len(label) / (max((n > 0).sum(), 1) * np.maximum(n, 1)))[label]


def _logistic(z):
    p = 1 / (1 + np.exp(np.clip(z, -500, 500)))  # share of the wrong class
    return np.logaddexp(0, -z), -p, p * (1 - p)


def _squared_hinge(z):
    gap = np.maximum(0, 1 - z)
    return gap ** 2, -2 * gap, 2.0 * (gap > 0)


LOSSES = {"logistic": (_logistic, 0.0), "squared_hinge": (_squared_hinge, 1.0)}


class Local:
    """The objective ``sum(w_i * loss(y_i * margin_i))`` over rows in memory; ``theta`` ends with the intercept."""

    def __init__(self, x: Sparse, loss: str, c: float):
        self.x, self.f = x, LOSSES[loss][0]
        self.width, self.y, self.w = x.width, 2.0 * x.label - 1, c * _balanced(x.label)

    def _margin(self, t):
        return self.x.times(t[:-1]) + t[-1]

    def _back(self, r):
        return np.append(self.x.back(r), r.sum())

    def value(self, theta) -> float:
        return float(self.w @ self.f(self.y * self._margin(theta))[0])

    def slope(self, theta) -> np.ndarray:
        return self._back(self.w * self.y * self.f(self.y * self._margin(theta))[1])

    def bend(self, theta):
        """The product with the Hessian at ``theta``, as a function."""
        curve = self.w * np.maximum(self.f(self.y * self._margin(theta))[2], 1e-12)
        return lambda v: self._back(curve * self._margin(v))

    def answer(self, theta, v=None):
        return np.append(self.value(theta), self.slope(theta)) if v is None else self.bend(theta)(v)


#: Partial vectors that are added up at once, in a task or on the driver.
FAN_IN = 32
#: Share of a sum over all rows that may be rounding: what falls by less is judged by its slope.
ROUNDING = 1e-12
#: Tasks of a pass for each core.
WAVES = 2


class Lists:
    """Rows of an Arrow batch of ``label, indices, weights`` as a sparse matrix."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.width, self.label = width, batch.column("label").to_numpy().astype(np.int64)
        ends = batch.column("indices").offsets.to_numpy()
        self.count, self.some = np.diff(ends), np.diff(ends) > 0
        self.first = (ends[:-1] - ends[0])[self.some]
        self.column, self.value = batch.column("indices").flatten().to_numpy().astype(np.int64), batch.column("weights").flatten().to_numpy()

    def times(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.count))
        if len(self.first):
            out[self.some] = np.add.reduceat(self.value * v[self.column], self.first)
        return out

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * np.repeat(r, self.count), self.width)


def _by_fold(batches, width: int) -> Iterator[tuple[int, Lists]]:
    """The rows of each batch, where the fold changes in pieces; without that column all are of fold 0."""
    for b in batches:
        fold = b.column("fold").to_numpy() if "fold" in b.schema.names else np.zeros(b.num_rows, np.int64)
        cut = [0, *(np.flatnonzero(np.diff(fold)) + 1).tolist(), b.num_rows]
        for at, to in zip(cut, cut[1:]):
            if to > at:
                yield int(fold[at]), Lists(b.slice(at, to - at), width)


class SparkRows:
    """The same objective over rows on the executors: a stored table ``(label, indices, weights)``, or with ``fold``,
    of which the rows of the fold ``without`` are left out.

    A pass reads the table once. A task adds its rows up to one vector;
    ``FAN_IN`` vectors at a time are added up by a task of the next level,
    until the driver adds the last few. Sums of floats depend on how rows are
    dealt to tasks in their last digits."""

    _PART = pa.schema([("task", pa.int64()), ("part", pa.binary())])

    def __init__(self, rows: DataFrame, width: int, loss: str, c: float, without: int | None = None):
        self.rows = rows.coalesce(WAVES * rows.sparkSession.sparkContext.defaultParallelism)
        self.width, self.loss, self.without = width, loss, without
        own = rows if without is None else rows.filter(F.col("fold") != without)
        counts = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a class
        total = sum(counts.values())
        self.weight = np.array([c * total / (max(len(counts), 1) * max(counts.get(k, 0), 1)) for k in (0, 1)])

    def answers(self, asked: Sequence[tuple["SparkRows", np.ndarray, np.ndarray | None]]) -> list[np.ndarray]:
        """What several objectives over these rows give, in one pass: for ``theta, None`` the value
        and then the slope, for ``theta, v`` the product of the Hessian at ``theta`` with ``v``."""
        width, schema = self.width, self._PART
        sizes = [width + 1 + (v is None) for _, _, v in asked]
        told = self.rows.sparkSession.sparkContext.broadcast([(o.loss, o.weight, o.without, theta, v) for o, theta, v in asked])

        def run(batches):
            out = [np.zeros(n) for n in sizes]
            for fold, x in _by_fold(batches, width):
                y = 2.0 * x.label - 1
                for total, (loss, weight, without, theta, v) in zip(out, told.value, strict=True):
                    if fold == without:
                        continue
                    w, (value, slope, curve) = weight[x.label], LOSSES[loss][0](y * (x.times(theta[:-1]) + theta[-1]))
                    r = w * y * slope if v is None else w * np.maximum(curve, 1e-12) * (x.times(v[:-1]) + v[-1])
                    if v is None:
                        total[0] += w @ value
                    total[-width - 1:-1] += x.back(r)
                    total[-1] += r.sum()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([np.concatenate(out).tobytes()], pa.binary())], schema=schema)

        def add(key, table):
            total = sum(np.frombuffer(p.as_py()) for p in table.column("part"))
            return pa.Table.from_arrays([pa.array([key[0].as_py()]), pa.array([total.tobytes()], pa.binary())], schema=schema)

        parts, n = self.rows.mapInArrow(run, "task long, part binary"), self.rows.rdd.getNumPartitions()
        while n > FAN_IN:
            parts, n = parts.select(F.floor(F.col("task") / FAN_IN).alias("task"), "part").groupBy("task").applyInArrow(add, "task long, part binary"), -(-n // FAN_IN)
        total = sum((np.frombuffer(r.part) for r in parts.select("part").collect()), np.zeros(sum(sizes)))
        told.destroy()
        return np.split(total, np.cumsum(sizes)[:-1])

    def answer(self, theta, v=None) -> np.ndarray:
        return self.answers([(self, theta, v)])[0]

    def value(self, theta) -> float:
        return float(self.answer(theta)[0])

    def slope(self, theta) -> np.ndarray:
        return self.answer(theta)[1:]

    def bend(self, theta):
        return lambda v: self.answer(theta, v)

    def margins(self, *thetas) -> DataFrame:
        """``margin, label`` of every row, and its ``fold``, by whose number one of several ``thetas`` is taken."""
        width = self.width

        def run(batches):
            for fold, x in _by_fold(batches, width):
                theta = thetas[fold if len(thetas) > 1 else 0]
                yield pa.RecordBatch.from_arrays([pa.array(x.times(theta[:-1]) + theta[-1]), pa.array(x.label, pa.int32()), pa.array(np.full(len(x.label), fold, np.int32))],
                                                 names=["margin", "label", "fold"])
        return self.rows.mapInArrow(run, "margin double, label int, fold int")


def _solved(solvers: Sequence[Generator], answers: Callable[[dict], dict]) -> list:
    """What solvers return that ask for a value at a time; ``answers`` gets what all of them ask, by their number."""
    asked, found = {k: next(s) for k, s in enumerate(solvers)}, [None] * len(solvers)
    while asked:
        told = answers(asked)
        for k in list(asked):
            try:
                asked[k] = solvers[k].send(told[k])
            except StopIteration as end:
                found[k] = end.value
                del asked[k]
    return found


def _newton(width: int, on_intercept: float, tol: float, steps: int) -> Generator:
    """Minimises an objective plus ``|b|^2 / 2``; asks for the objective's answer to ``theta, v``."""
    ridge = np.append(np.ones(width), on_intercept)

    def at(theta):
        value, slope = np.split((yield theta, None), [1])
        return float(value[0]) + float((ridge * theta * theta).sum()) / 2, slope + ridge * theta
    theta = np.zeros(width + 1)
    now, gradient = yield from at(theta)
    for _ in range(steps):
        if np.abs(gradient).max() < tol:
            break
        move, left = np.zeros_like(theta), -gradient
        along, size = left.copy(), float(left @ left)
        goal = max(size * min(0.25, size ** 0.5) ** 2, (tol / 100) ** 2)  # no finer than rounded scores can show
        for _ in range(200):  # conjugate gradients
            bent = (yield theta, along) + (ridge + 1e-12) * along
            step = size / float(along @ bent)
            move += step * along
            left -= step * bent
            size, before = float(left @ left), size
            if size < goal:
                break
            along = left + size / before * along
        rate, fall, noise = 1.0, float(gradient @ move), ROUNDING * abs(now)
        then, slope = yield from at(theta + move)
        while then > now + 1e-4 * rate * fall + noise and rate > 1e-10:
            rate /= 2
            then, slope = yield from at(theta + rate * move)
        if then >= now - noise and np.abs(slope).max() >= np.abs(gradient).max():  # what is left to gain is lost in rounding
            break
        theta, now, gradient = theta + rate * move, then, slope
    return theta


def newton(objective, on_intercept: float, tol: float = 1e-8, steps: int = 100) -> np.ndarray:
    """Minimise an objective plus ``|b|^2 / 2``; ``on_intercept`` is the intercept's share of that."""
    return _solved([_newton(objective.width, on_intercept, tol, steps)], lambda asked: {k: objective.answer(*x) for k, x in asked.items()})[0]


def newton_together(objectives: Sequence[SparkRows], tol: float = 1e-8, steps: int = 100) -> list[np.ndarray]:
    """The same for several objectives over the same stored rows: a pass answers what all of them need next."""
    return _solved([_newton(o.width, LOSSES[o.loss][1], tol, steps) for o in objectives],
                   lambda asked: dict(zip(asked, objectives[0].answers([(objectives[k], *x) for k, x in asked.items()]), strict=True)))


def fit_linear(x: Sparse, loss: str, c: float = C_REG, tol: float = 1e-8, steps: int = 100) -> tuple[np.ndarray, float]:
    """Minimise ``c * sum(w_i * loss(y_i * margin_i)) + |b|^2 / 2`` with balanced weights.

    The squared hinge regularises the intercept too, as that objective's usual
    solver does. Returns coefficients and intercept."""
    theta = newton(Local(x, loss, c), LOSSES[loss][1], tol, steps)
    return theta[:-1], float(theta[-1])


def _platt(n0: int, n1: int, steps: int) -> Generator:
    """Newton steps for ``sigmoid(a * margin + b)``; asks for loss, gradient and Hessian at ``a, b``."""
    a, b = 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    now = yield a, b
    for _ in range(steps):
        loss, ga, gb, haa, hab, hbb = now
        if max(abs(ga), abs(gb)) < 1e-9:
            break
        move = np.linalg.solve(np.array([[haa, hab], [hab, hbb]]) + 1e-12 * np.eye(2), np.array([ga, gb]))
        rate, noise = 1.0, ROUNDING * abs(loss)
        then = yield a - move[0], b - move[1]
        while then[0] > loss + noise and rate > 1e-10:
            rate /= 2
            then = yield a - rate * move[0], b - rate * move[1]
        if then[0] >= loss - noise and max(abs(then[1]), abs(then[2])) >= max(abs(ga), abs(gb)):
            break
        a, b, now = a - rate * move[0], b - rate * move[1], then
    return float(a), float(b)


def fit_platt(margin: np.ndarray, label: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """M9: ``a, b`` of ``sigmoid(a * margin + b)`` for smoothed targets (Newton steps)."""
    n = np.bincount(label, minlength=2)
    target = np.where(label == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))

    def sums(a, b):
        z = a * margin + b
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        r, h = p - target, np.maximum(p * (1 - p), 1e-12)
        return (np.logaddexp(0, z) - target * z).sum(), r @ margin, r.sum(), h @ margin ** 2, h @ margin, h.sum()
    return _solved([_platt(n[0], n[1], steps)], lambda asked: {k: sums(*x) for k, x in asked.items()})[0]


def fit_platt_on_executors(rows: DataFrame, steps: int = 100) -> tuple[float, float]:
    """The same for a stored table ``margin, label``."""
    return fit_platt_by_fold(rows.withColumn("fold", F.lit(0)), 1, steps)[0]


def fit_platt_by_fold(rows: DataFrame, folds: int, steps: int = 100) -> list[tuple[float, float]]:
    """The same for each fold of a stored table ``margin, label, fold``; a step of all is one aggregate, six sums a fold of which reach the driver."""
    n = {(r["fold"], r["label"]): r["n"] for r in rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [(n.get((k, 0), 0), n.get((k, 1), 0)) for k in range(folds)]

    def sums(k, a, b):
        n0, n1 = counts[k]
        target = F.when(F.col("label") == 1, (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2))
        z = F.lit(a) * F.col("margin") + F.lit(b)
        p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - target * z
        r, h, m = p - target, F.greatest(p * (1 - p), F.lit(1e-12)), F.col("margin")
        return [F.coalesce(F.sum(F.when(F.col("fold") == k, x)), F.lit(0.0)) for x in (loss, r * m, r, h * m * m, h * m, h)]

    def answers(asked):
        told = iter(rows.agg(*[x.alias(f"s{k}_{i}") for k, ab in asked.items() for i, x in enumerate(sums(k, *ab))]).first())
        return {k: tuple(next(told) for _ in range(6)) for k in asked}
    return _solved([_platt(*c, steps) for c in counts], answers)


class LinearModel(NamedTuple):
    """``vocab`` (term, index, df, idf), ``coef`` (term, coef array) and, for
    each part of the average, ``(intercept, a, b)``: P = sigmoid(a * margin + b)."""

    vocab: DataFrame
    coef: DataFrame
    parts: list[tuple[float, float, float]]


def fit_sample(train: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> tuple[DataFrame, Sparse]:
    """For a caller that names ``max_rows``: vocabulary of all training rows, and the TF-IDF rows to fit on.

    Rows without a label are no training rows. All texts are counted for the
    vocabulary, those of the rows to fit on again; no counts are stored."""
    train = train.filter(F.col(label_col).isNotNull())
    vocab = materialize(tfidf_fit(train, id_col, text_col))
    chosen = train.select(id_col, F.col(label_col).cast("int").alias("label")).orderBy(hash32(id_col, "fit"), id_col).limit(max_rows).toPandas()
    ids = train.sparkSession.createDataFrame(chosen[[id_col]], train.select(id_col).schema) if len(chosen) else train.select(id_col).limit(0)
    weights = tfidf_transform(train.join(F.broadcast(ids), id_col, "left_semi"), vocab, id_col, text_col)
    cells = weights.select(id_col, "index", "weight").orderBy(id_col, "index").toPandas()
    place = {i: n for n, i in enumerate(chosen[id_col])}
    return vocab, Sparse(cells[id_col].map(place).to_numpy(np.int64), cells["index"].to_numpy(np.int64), cells["weight"].to_numpy(np.float64),
                         chosen["label"].to_numpy(np.int64), max(vocab.count(), 1))


def fit_rows(train: DataFrame, id_col: str, text_col: str, label_col: str = "label",
             folds: int = CALIBRATION_FOLDS) -> tuple[DataFrame, DataFrame]:
    """Vocabulary, and every labelled row as ``label, fold, indices, weights``, stored.

    The rows of a class take turns in the folds, in the order of the id's hash, as in :func:`stratified_folds`;
    their places are running sums over ranges. A document is all rows of an id: one of these has its terms.
    A row without a term has empty lists."""
    train = train.filter(F.col(label_col).isNotNull())
    vocab = materialize(tfidf_fit(train, id_col, text_col))
    cells = tfidf_rows(train, vocab, id_col, text_col)
    n = train.select(id_col, F.col(label_col).cast("int").alias("label")).groupBy(id_col, "label").agg(F.count(F.lit(1)).alias("n"))
    placed = prefix_sums(n.withColumn("h", hash32(id_col, "fit")), ["h", id_col], ["n"], ["label"])
    last = placed.groupBy(id_col).agg(F.max("label").alias("last")).withColumnRenamed(id_col, "__id")
    placed = placed.join(last, F.col(id_col) == F.col("__id"), "left").select(
        id_col, "label", "cum_n", (F.col("label") == F.col("last")).alias("whole"), F.explode(F.sequence(F.col("cum_n") - F.col("n"), F.col("cum_n") - 1)).alias("place"))
    placed = placed.withColumn("whole", F.col("whole") & (F.col("place") == F.col("cum_n") - 1))
    rows = placed.join(cells.withColumnRenamed(id_col, "__id"), F.col("whole") & (F.col(id_col) == F.col("__id")), "left")
    return vocab, materialize(rows.select(
        "label", F.pmod("place", F.lit(folds)).cast("int").alias("fold"),
        F.coalesce("indices", F.array().cast("array<int>")).alias("indices"), F.coalesce("weights", F.array().cast("array<double>")).alias("weights")).sortWithinPartitions("fold"))


def _model(vocab: DataFrame, coefficients: list[np.ndarray], parts) -> LinearModel:
    spark = vocab.sparkSession
    rows = [(n, [float(c[n]) for c in coefficients]) for n in range(len(coefficients[0]))]
    coef = vocab.join(F.broadcast(spark.createDataFrame(rows, "index int, coef array<double>")), "index").select("term", "coef")
    return LinearModel(vocab, materialize(coef), parts)


def fit_logreg(train: DataFrame, id_col: str, text_col: str, label_col: str = "label", c: float = C_REG,
               max_rows: int | None = None, rows: tuple[DataFrame, DataFrame] | None = None, tol: float = 1e-8) -> LinearModel:
    """M7: L2 logistic regression with balanced class weights, on all rows, by the executors; ``rows``: those
    of :func:`fit_rows`, if they are there already."""
    if max_rows is None:
        vocab, rows = rows or fit_rows(train, id_col, text_col, label_col)
        theta = newton(SparkRows(rows, max(vocab.count(), 1), "logistic", c), LOSSES["logistic"][1], tol)
        return _model(vocab, [theta[:-1]], [(float(theta[-1]), 1.0, 0.0)])
    vocab, x = fit_sample(train, id_col, text_col, label_col, max_rows)
    b, intercept = fit_linear(x, "logistic", c)
    return _model(vocab, [b], [(intercept, 1.0, 0.0)])


def stratified_folds(label: np.ndarray, folds: int = CALIBRATION_FOLDS) -> np.ndarray:
    """Fold of each row: the rows of a class, in their order, take turns."""
    out = np.empty(len(label), np.int64)
    for value in np.unique(label):
        own = np.flatnonzero(label == value)
        out[own] = np.arange(len(own)) % folds
    return out


def fit_svm(train: DataFrame, id_col: str, text_col: str, label_col: str = "label", c: float = C_REG, max_rows: int | None = None,
            folds: int = CALIBRATION_FOLDS, rows: tuple[DataFrame, DataFrame] | None = None, tol: float = 1e-8) -> LinearModel:
    """M8, M9: squared-hinge SVMs with balanced weights on all folds but one,
    Platt scaling on that one, and the average of the calibrated scores; on
    all rows, by the executors, in passes that the folds share; ``rows``: those
    of :func:`fit_rows` with as many folds, if they are there already."""
    if max_rows is None:
        vocab, rows = rows or fit_rows(train, id_col, text_col, label_col, folds)
        objectives = [SparkRows(rows, max(vocab.count(), 1), "squared_hinge", c, without=k) for k in range(folds)]
        thetas = newton_together(objectives, tol)
        calibrated = fit_platt_by_fold(materialize(objectives[0].margins(*thetas)), folds)
        return _model(vocab, [t[:-1] for t in thetas], [(float(t[-1]), *ab) for t, ab in zip(thetas, calibrated, strict=True)])
    vocab, x = fit_sample(train, id_col, text_col, label_col, max_rows)
    fold = stratified_folds(x.label, folds)
    coefficients, parts = [], []
    for k in range(folds):
        b, intercept = fit_linear(x.only(fold != k), "squared_hinge", c)
        held = x.only(fold == k)
        coefficients.append(b)
        parts.append((intercept, *fit_platt(held.times(b) + intercept, held.label)))
    return _model(vocab, coefficients, parts)


def score(model: LinearModel, docs: DataFrame, id_col: str, text_col: str, weights: DataFrame | None = None) -> DataFrame:
    """``(id, score)`` of every row of ``docs``; ``weights``: of these by the model's vocabulary, if they are there already."""
    weights = tfidf_transform(docs, model.vocab, id_col, text_col) if weights is None else weights
    margins = weights.join(broadcast_within(model.coef), "term").groupBy(id_col).agg(
        *[F.sum(F.col("weight") * F.col("coef")[k]).alias(f"__m{k}") for k in range(len(model.parts))])
    scores = [sigmoid(F.lit(a) * (F.coalesce(f"__m{k}", F.lit(0.0)) + F.lit(c)) + F.lit(b)) for k, (c, a, b) in enumerate(model.parts)]
    return docs.select(id_col).join(margins, id_col, "left").select(id_col, (sum(scores) / F.lit(float(len(scores)))).alias("score"))


MODELS = {"TF-IDF + LogReg": fit_logreg, "TF-IDF + SVM": fit_svm}


def model_tournament(train: DataFrame, test: DataFrame, id_col: str, text_col: str, label_col: str = "label",
                     models: Sequence[str] = tuple(MODELS)) -> DataFrame:
    """Fit every candidate on all rows; return the long
    ``(model, id, label, score)`` table for :func:`evaluate.model_comparison`.
    The candidates share the training rows and a vocabulary, so these and the
    test rows' weights are made once."""
    rows = fit_rows(train, id_col, text_col, label_col)
    weights = materialize(tfidf_transform(test, rows[0], id_col, text_col))
    labels = test.select(id_col, label_col)
    out = None
    for name in models:
        s = score(MODELS[name](train, id_col, text_col, label_col, rows=rows), test, id_col, text_col, weights)
        s = s.join(labels, id_col).select(F.lit(name).alias("model"), id_col, label_col, "score")
        out = s if out is None else out.unionByName(s)
    return out
