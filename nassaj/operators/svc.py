"""Linear support vectors with squared hinge loss, many problems in the same passes.

A problem is one class against the others, with a weight of the loss and a fold left out, and minimises
``|w|^2 / 2 + C * sum(max(0, 1 - t * (w x + b))^2)``, with the intercept b as the weight of a constant feature 1, so
that it is regularised too. Newton's method: each step solves for the direction by conjugate gradients, which need
products with the Hessian and never the Hessian. Gradients and products are sums over the rows: every pass over the
vectors makes them for all problems that are still open, so that a grid over classes, weights and folds reads the
vectors no more often than its slowest problem alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LinearSVCModel, OneVsRestModel
from pyspark.ml.linalg import DenseVector
from pyspark.ml.wrapper import JavaParams, _py2java
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nassaj.operators.sizes import kept

#: Numbers of all weights that are sent together; more problems go one group after the other.
WEIGHTS = 1 << 24
CG_STEPS = 50
HALVINGS = 40


class Problem(NamedTuple):
    C: float
    positive: float
    left_out: int = -1


def problems_of(classes: int, C: float, left_out: int = -1) -> list[Problem]:
    """One against the others; for two classes one problem serves both."""
    return [Problem(C, float(k), left_out) for k in ([1] if classes == 2 else range(classes))]


def _plain(vectors: DataFrame) -> DataFrame:
    """``label, fold, indices, values``, on about as many tasks as run at a time: each sends one sum per problem."""
    v = F.unwrap_udt("features")
    values = v["values"]
    indices = F.coalesce(v["indices"], F.transform(values, lambda _, i: i))
    fold = F.col("fold").cast("int") if "fold" in vectors.columns else F.lit(-2)
    tasks = 4 * vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.select(F.col("label").cast("double"), fold.alias("fold"), indices.alias("indices"), values.alias("values")).coalesce(tasks)


class _Rows:
    """A batch as flat arrays."""

    #: What a packed batch holds, each as the bytes of an array.
    PARTS = {"label": np.float64, "fold": np.int32, "lengths": np.int64, "indices": np.int32, "values": np.float64}

    def __init__(self, label, fold, lengths, indices, values) -> None:
        self.label, self.fold, self.indices, self.values = label, fold, indices, values
        self.row = np.repeat(np.arange(len(lengths)), lengths)

    @staticmethod
    def parts(batch: pa.RecordBatch) -> list[np.ndarray]:
        label, fold, indices, values = batch.columns
        flat = [label, fold, indices.value_lengths(), indices.flatten(), values.flatten()]
        return [x.to_numpy(zero_copy_only=False).astype(kind) for x, kind in zip(flat, _Rows.PARTS.values(), strict=True)]

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Rows:
        return cls(*cls.parts(batch))

    @classmethod
    def packed(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[_Rows]:
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                yield cls(*(np.frombuffer(x.as_buffer(), kind) for x, kind in zip(row, cls.PARTS.values(), strict=True)))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * w[self.indices], len(self.label)) + w[-1]

    def gathered(self, r: np.ndarray, size: int) -> np.ndarray:
        """The sum of the rows' vectors, weighted by ``r``, and of ``r``."""
        return np.append(np.bincount(self.indices, self.values * r[self.row], size), r.sum())

    def missed(self, problem: Problem, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signs, and by how much each row misses its margin; 0 for rows left out."""
        sign = np.where(self.label == problem.positive, 1.0, -1.0)
        short = np.maximum(0.0, 1 - sign * self.times(w))
        return sign, np.where(self.fold == problem.left_out, 0.0, short)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per batch."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in _Rows.parts(batch)], list(_Rows.PARTS))


def _add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for df in batches:
        for p, values in zip(df["p"].tolist(), df["total"], strict=True):
            sums[p] = sums[p] + values if p in sums else np.array(values, float)
    for p, values in sums.items():
        yield pd.DataFrame({"p": [p], "total": [values.tolist()]})


class _Passes:
    """Sums over all packed rows, for some of the problems."""

    def __init__(self, rows: DataFrame, size: int, problems: list[Problem]) -> None:
        self.rows, self.size, self.problems = rows, size, problems

    def _sum(self, some: np.ndarray, w: np.ndarray, width: int, of: Callable) -> np.ndarray:
        size, wanted = self.size, [self.problems[p] for p in some]
        sent = self.rows.sparkSession.sparkContext.broadcast(w)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = np.zeros((len(wanted), width))
            for rows in _Rows.packed(batches):
                for k, problem in enumerate(wanted):
                    totals[k] += of(rows, problem, sent.value[k], size)
            lists = pa.array(totals.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(wanted)), pa.int32()), lists], ["p", "total"])

        parts = self.rows.mapInArrow(run, "p int, total array<double>")
        found = parts.repartition(min(len(wanted), 64), "p").mapInPandas(_add_up, "p int, total array<double>").collect()
        sent.destroy()
        out = np.zeros((len(wanted), width))
        for r in found:  # a row per problem
            out[r["p"]] = r["total"]
        return out

    def gradient(self, some: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values and gradients at the weights."""

        def of(rows: _Rows, problem: Problem, w: np.ndarray, size: int) -> np.ndarray:
            sign, short = rows.missed(problem, w)
            return np.append(rows.gathered(-2 * sign * short, size), short @ short)

        C = np.array([self.problems[p].C for p in some])
        sums = self._sum(some, w, self.size + 2, of)
        return (w * w).sum(1) / 2 + C * sums[:, -1], w + C[:, None] * sums[:, :-1]

    def hessian(self, some: np.ndarray, w: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Products of the Hessians at ``w`` with ``v``."""

        def of(rows: _Rows, problem: Problem, both: np.ndarray, size: int) -> np.ndarray:
            _, short = rows.missed(problem, both[0])
            return rows.gathered(2 * (short > 0) * rows.times(both[1]), size)

        C = np.array([self.problems[p].C for p in some])
        return v + C[:, None] * self._sum(some, np.stack([w, v], 1), self.size + 1, of)


def _direction(passes: _Passes, some: np.ndarray, w: np.ndarray, g: np.ndarray, exact: np.ndarray) -> np.ndarray:
    """Conjugate gradients for ``H s = -g``, until what is left is a share ``exact`` of the gradient."""
    s, left, search = np.zeros_like(g), -g, -g
    norm = (left * left).sum(1)
    goal = exact**2 * norm
    live = np.arange(len(some))
    for _ in range(CG_STEPS):
        product = passes.hessian(some[live], w[live], search[live])
        step = norm[live] / (search[live] * product).sum(1)
        s[live] += step[:, None] * search[live]
        left[live] = left[live] - step[:, None] * product
        new = (left[live] ** 2).sum(1)
        search[live] = left[live] + (new / norm[live])[:, None] * search[live]
        norm[live] = new
        live = live[new > goal[live]]
        if not len(live):
            break
    return s


def _solve(passes: _Passes, tol: float, max_iter: int) -> np.ndarray:
    count = len(passes.problems)
    w = np.zeros((count, passes.size + 1))
    value, g = passes.gradient(np.arange(count), w)
    start = np.maximum(np.linalg.norm(g, axis=1), np.finfo(float).tiny)
    for _ in range(max_iter):
        share = np.linalg.norm(g, axis=1) / start
        some = np.flatnonzero(share > tol)
        if not len(some):
            break
        s = _direction(passes, some, w[some], g[some], np.minimum(0.1, share[some]))
        slope = (g[some] * s).sum(1)
        step, todo = np.ones(len(some)), np.arange(len(some))
        for _ in range(HALVINGS):
            at = some[todo]
            tried = w[at] + step[todo, None] * s[todo]
            value_at, g_at = passes.gradient(at, tried)
            good = value_at <= value[at] + 1e-4 * step[todo] * slope[todo] + 1e-14 * np.abs(value[at])
            w[at[good]], value[at[good]], g[at[good]] = tried[good], value_at[good], g_at[good]
            todo = todo[~good]
            if not len(todo):
                break
            step[todo] /= 2
        else:  # rounding is all that is left
            g[some[todo]] = 0
    return w


def solve(vectors: DataFrame, problems: list[Problem], tol: float, max_iter: int) -> np.ndarray:
    """The weights of every problem, the intercept last.

    ``vectors`` has ``label`` and ``features``, and ``fold`` where problems leave one out. A problem is solved when its gradient has
    fallen to ``tol`` of that at zero.
    """
    first = vectors.select("features").first()
    if first is None:
        raise ValueError("no rows to learn from")
    size, packed = first["features"].size, _plain(vectors).mapInArrow(_pack, ", ".join(f"{k} binary" for k in _Rows.PARTS))
    most = max(1, WEIGHTS // (size + 1))
    groups = [problems[i : i + most] for i in range(0, len(problems), most)]
    with kept(packed) as rows:  # a pass reads arrays, and no vector is taken apart again
        return np.concatenate([_solve(_Passes(rows, size, group), tol, max_iter) for group in groups])


def held_out_counts(vectors: DataFrame, classes: int, candidates: list[list[Problem]], weights: list[np.ndarray]) -> DataFrame:
    """``candidate, fold, truth, prediction, n`` of every row, predicted where its fold was left out; in one pass.

    A candidate is a list of problems over all folds.
    """
    by_fold = [
        {fold: np.stack([w for q, w in zip(problems, ws, strict=True) if q.left_out == fold]) for fold in {q.left_out for q in problems}}
        for problems, ws in zip(candidates, weights, strict=True)
    ]
    sent = vectors.sparkSession.sparkContext.broadcast(by_fold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, int] = {}
        for batch in batches:
            rows = _Rows.of(batch)
            for c, folds in enumerate(sent.value):
                for fold, ws in folds.items():
                    margins = np.stack([rows.times(w) for w in ws], 1)
                    chosen = (margins[:, 0] > 0).astype(int) if classes == 2 else margins.argmax(1)
                    mine = rows.fold == fold
                    for key, n in zip(*np.unique(np.stack([rows.label[mine], chosen[mine]], 1), axis=0, return_counts=True), strict=True):
                        place = (c, int(fold), float(key[0]), float(key[1]))
                        counts[place] = counts.get(place, 0) + int(n)
        columns = list(zip(*counts, strict=True)) or [(), (), (), ()]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x, k) for x, k in zip(columns, kinds, strict=True)), pa.array(list(counts.values()), pa.int64())],
            ["candidate", "fold", "truth", "prediction", "n"],
        )

    found = _plain(vectors).mapInArrow(run, "candidate int, fold int, truth double, prediction double, n bigint")
    return found.groupBy("candidate", "fold", "truth", "prediction").agg(F.sum("n").alias("n"))


def fitted(vectors: DataFrame, weights: np.ndarray) -> Model:
    """Spark's own model of one problem, or of one for each class."""
    sc = vectors.sparkSession.sparkContext

    def one(w: np.ndarray) -> LinearSVCModel:
        made = JavaParams._new_java_obj(
            "org.apache.spark.ml.classification.LinearSVCModel", f"SquaredHinge_{abs(hash(w.tobytes())):x}", _py2java(sc, DenseVector(w[:-1])), float(w[-1])
        )
        return LinearSVCModel(made)

    if len(weights) == 1:
        return one(weights[0])
    return OneVsRestModel([one(w) for w in weights])._set(classifier=LinearSVC())  # asked for when it is saved


class SquaredHingeSVC(Estimator):
    """Fits ``label`` by ``features``; labels are 0, 1, .. below ``classes``."""

    @keyword_only
    def __init__(self, *, classes: int, C: float, tol: float, max_iter: int) -> None:
        super().__init__()
        self.classes, self.C, self.tol, self.max_iter = classes, C, tol, max_iter

    def _fit(self, dataset: DataFrame) -> Model:
        return fitted(dataset, solve(dataset, problems_of(self.classes, self.C), self.tol, self.max_iter))
