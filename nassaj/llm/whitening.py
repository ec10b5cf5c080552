"""Whitening of embeddings by spectrum slicing.

Every component c becomes the whole number ``x = floor(scale * c) + offset``. Sums, and the covariance of the centred
vectors, are gathered over all rows; both have as many rows as the vectors have dimensions. Its leading eigenpairs
are found one by one, each in a task of its own:

1. The pivots of LDL^T of ``V - s I`` tell, by their signs, how many eigenvalues lie above s. Halving a common interval by
   these counts, the k-th eigenvalue is boxed in until no other lies in its box or in the boxes beside it.
2. Rayleigh quotient iteration from the middle of the box converges to its eigenpair, at the end cubically.
3. Counts just above and just below certify that the value found is the k-th.

Eigenvalues closer than ``TIE`` of the largest possible one share or touch a box at the last width. They are solved
together: inverse iteration gives the space they span, and the same slicing splits V inside it.

Vectors that are null or empty, or hold a null, a non-finite entry or one beyond 2^46 (where ``scale * c`` leaves the whole
numbers that doubles tell apart), take no part. Where lengths differ, the commonest is fitted (of equally common ones the
longest) and others take no part. Rows with null or repeated ids count as rows. Directions whose variance is
below ``LEAST`` of the largest possible are no components: equal vectors, or a single one, have none. No rows: no
rows. ``deviation`` beyond the range of long is null. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nassaj.llm.staging import release, stage

TIE = 2.0**-30
LEAST = 1e-10
_EPS = np.finfo(float).eps
_BK = (1 + 17**0.5) / 8  # the pivot rule of Bunch and Kaufman


# --- one symmetric matrix ---------------------------------------------------------
def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed ``shift``: the positive pivots of LDL^T of ``v - shift I``."""
    w = v - shift * np.eye(len(v))
    none = _EPS * max(np.abs(w).max(), np.finfo(float).tiny)
    positive = 0
    while len(w):
        side = np.abs(w[1:, 0])
        r = int(side.argmax()) + 1 if len(side) else 0
        most, own = side[r - 1] if len(side) else 0.0, abs(w[0, 0])
        if max(own, most) <= none:  # an eigenvalue at the shift itself
            w = w[1:, 1:]
            continue
        size = 1
        if own < _BK * most:
            column = np.abs(w[:, r])
            column[r] = 0
            if own * column.max() < _BK * most**2:
                size = 1 if abs(w[r, r]) >= _BK * column.max() else 2
                order = np.arange(len(w))
                order[[size - 1, r]] = order[[r, size - 1]]
                w = w[np.ix_(order, order)]
        if size == 1:
            positive += w[0, 0] > 0
            w = w[1:, 1:] - np.outer(w[1:, 0], w[0, 1:] / w[0, 0])
        else:  # such a pair of pivots has one of each sign
            positive += 1
            w = w[2:, 2:] - w[2:, :2] @ np.linalg.solve(w[:2, :2], w[:2, 2:])
    return int(positive)


def largest(v: np.ndarray) -> float:
    """A bound of all eigenvalues of a matrix without negative ones."""
    return float(min(np.trace(v), np.abs(v).sum(1).max()))


def box(v: np.ndarray, k: int) -> tuple[float, float, bool]:
    """Bounds of the k-th largest eigenvalue, and whether another lies in or beside the box at the last width."""
    bound = largest(v)
    low, high = -bound / 64, bound * (1 + 1 / 64)
    while True:
        width = high - low
        if above(v, low - width) == k and above(v, high + width) == k - 1:
            return low, high, False
        if width <= TIE * bound:
            return low, high, True
        middle = low + width / 2
        if above(v, middle) >= k:
            low = middle
        else:
            high = middle


def _solve(v: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    for nudge in (0, 1, -1, 64, -64):
        try:
            found = np.linalg.solve(v - (shift + nudge * _EPS * largest(v)) * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found
    raise ArithmeticError("no solution near an eigenvalue")


def rayleigh(v: np.ndarray, k: int, low: float, high: float) -> tuple[float, np.ndarray]:
    """The eigenpair in a box that no other eigenvalue lies beside, certified to be the k-th."""
    scale, d = largest(v), len(v)
    for seed in range(8):
        x = np.random.default_rng([k, seed]).normal(size=d)
        for _ in range(4 + 4 * seed):  # others lie three times as far from the middle at least
            x = _solve(v, (low + high) / 2, x)
            x /= np.linalg.norm(x)
        value, settled = float(x @ v @ x), False
        for _ in range(12):
            done, settled = settled, np.linalg.norm(v @ x - value * x) <= 4 * _EPS * scale
            if done:
                break  # a step after the residual is down to rounding, for what lies close by
            x = _solve(v, value, x)
            x /= np.linalg.norm(x)
            value = float(x @ v @ x)
        near = max(8 * np.linalg.norm(v @ x - value * x), 64 * d * _EPS * scale)
        if low <= value <= high and above(v, value - near) >= k > above(v, value + near):
            return value, x
    raise ArithmeticError(f"eigenvalue {k} was not certified")


def together(v: np.ndarray, low: float, high: float, members: int) -> list[tuple[float, np.ndarray]]:
    """The eigenpairs of a box that holds ``members`` eigenvalues, largest first."""
    if above(v, low) - above(v, high) != members:
        raise ArithmeticError(f"{members} close eigenvalues were not certified")
    x = np.random.default_rng(members).normal(size=(len(v), members))
    for _ in range(6):
        x = np.linalg.qr(_solve(v, (low + high) / 2, x))[0]
    inside = x.T @ v @ x - low * np.eye(members)
    inside = (inside + inside.T) / 2
    spread = np.abs(inside - np.trace(inside) / members * np.eye(members)).max()
    if spread <= 64 * len(v) * _EPS * largest(v):  # equal as far as doubles tell
        return [(float(c @ v @ c), c) for c in x.T]
    return [(float(c @ v @ c), c) for c in (x @ y for _, y in leading(inside, members))]


def clusters(v: np.ndarray, boxes: list[tuple[float, float, bool]]) -> list[tuple[int, int, float, float]]:
    """``first, members, low, high`` of runs of eigenvalues whose boxes touch; single ones are runs of one.

    A run that goes on beyond the last box is followed to its end.
    """
    boxes = list(boxes)
    slack = TIE * largest(v) / 8
    while boxes and boxes[-1][2] and len(boxes) < len(v):
        following = box(v, len(boxes) + 1)
        if boxes[-1][0] - following[1] > slack:
            break
        boxes.append(following)
    runs: list[tuple[int, int, float, float]] = []
    for k, (low, high, tied) in enumerate(boxes, 1):
        if tied and runs and boxes[k - 2][2] and runs[-1][2] - high <= slack:
            first, members, _, top = runs[-1]
            runs[-1] = (first, members + 1, low, top)
        else:
            runs.append((k, 1, low, high))
    return runs


def _pairs(v: np.ndarray, run: tuple[int, int, float, float]) -> list[tuple[float, np.ndarray]]:
    first, members, low, high = run
    return [rayleigh(v, first, low, high)] if members == 1 else together(v, low, high, members)


def leading(v: np.ndarray, k: int) -> list[tuple[float, np.ndarray]]:
    """The k largest eigenpairs."""
    runs = clusters(v, [box(v, i) for i in range(1, k + 1)])
    return _orthogonal([pair for run in runs for pair in _pairs(v, run)][:k])


def _orthogonal(pairs: list[tuple[float, np.ndarray]]) -> list[tuple[float, np.ndarray]]:
    """Without what rounding left of the directions before; it shows where eigenvalues are small against the largest."""
    q, r = np.linalg.qr(np.stack([x for _, x in pairs], 1))
    return [(e, c * s) for (e, _), c, s in zip(pairs, q.T, np.sign(np.diag(r)), strict=True)]


def sliced(spark, v: np.ndarray, k: int) -> list[tuple[float, np.ndarray]]:
    """The k largest eigenpairs, a task for each box and for each run of eigenvalues."""
    sent = spark.sparkContext.broadcast(v)

    def boxed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows = [(n, *box(sent.value, n)) for n in df["k"].tolist()]
            yield pd.DataFrame(rows, columns=["k", "low", "high", "tied"])

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for run in df[["first", "members", "low", "high"]].itertuples(index=False, name=None):
                pairs = _pairs(sent.value, run)
                yield pd.DataFrame({
                    "k": range(run[0], run[0] + len(pairs)), "value": [e for e, _ in pairs], "vector": [x.tolist() for _, x in pairs],
                })

    numbers = spark.range(1, k + 1, 1, k).select(F.col("id").cast("int").alias("k"))
    found = numbers.mapInPandas(boxed, "k int, low double, high double, tied boolean").collect()  # k rows
    runs = clusters(v, [(r["low"], r["high"], r["tied"]) for r in sorted(found, key=lambda r: r["k"])])
    table = spark.createDataFrame(runs, "first int, members int, low double, high double").repartition(len(runs), "first")
    pairs = table.mapInPandas(solved, "k int, value double, vector array<double>").collect()  # a row per component
    return _orthogonal([(r["value"], np.array(r["vector"])) for r in sorted(pairs, key=lambda r: r["k"])][:k])


# --- all rows ---------------------------------------------------------------------
def whole_numbers(vector: Column, scale: int, offset: int) -> Column:
    """The components as whole numbers, or null where the vector takes no part."""
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= 2.0**46, F.lit(False)))
    made = F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("bigint"))
    return F.when((F.size(vector) > 0) & usable, made)


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _add_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By length of vector: its rows (at place -1) and the sum of every place."""
    sums: dict[int, list[int]] = {}
    for batch in batches:
        column = batch.column(0)
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
        for d in np.unique(sizes).tolist():
            at = ends[sizes == d]
            x = values[(at - d)[:, None] + np.arange(d)]
            total = sum(part.sum(0).astype(object) for part in np.array_split(x, -(-len(x) // 512)))
            known = sums.setdefault(d, [0] * (d + 1))
            sums[d] = [a + b for a, b in zip(known, [len(x), *total.tolist()], strict=True)]
    for d, totals in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * len(totals), pa.int32()), pa.array(range(-1, d), pa.int32()), pa.array(map(Decimal, totals), pa.decimal128(38, 0))],
            ["d", "place", "total"],
        )


def _add_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for df in batches:
        for i, values in zip(df["i"].tolist(), df["line"], strict=True):
            sums[i] = sums[i] + values if i in sums else np.array(values, float)
    for i, values in sums.items():
        yield pd.DataFrame({"i": [i], "line": [values.tolist()]})


def covariance(rows: DataFrame, n: int, size: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Of what ``centred`` makes of the vectors, over all rows: products are summed in the tasks, then line by line."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        products = np.zeros((size + 1, size))  # the last line holds the sums
        for batch in batches:
            y = centred(_matrix(batch))
            products[:size] += y.T @ y
            products[size] += y.sum(0)
        lines = pa.array(products.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), lines], ["i", "line"])

    lines = rows.select("x").mapInArrow(gather, "i int, line array<double>")
    found = lines.repartition("i").mapInPandas(_add_rows, "i int, line array<double>").collect()  # size + 1 rows
    total = np.array([r["line"] for r in sorted(found, key=lambda r: r["i"])])
    mean = total[size] / n
    v = total[:size] / n - np.outer(mean, mean)
    return (v + v.T) / 2


def whiten(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 32, scale: int = 64, offset: int = 1_000_000
) -> DataFrame:
    """``<id>, component, n, deviation, whitened, explained, identity_error`` for each row and leading component.

    ``deviation`` is the exact sum of ``(n * x - S)^2`` of the row, ``whitened`` its centred vector on the
    component's direction over the root of its eigenvalue, ``explained`` the eigenvalue's share of all variance, and
    ``identity_error`` how far the covariance of all whitened rows is from the identity at most. The model is fitted
    when called; rows are whitened when the result is read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id).alias("id"), whole_numbers(F.col(vector), scale, offset).alias("x")).where("x IS NOT NULL")
    out = f"id {rows.schema['id'].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    sums = rows.select("x").mapInArrow(_add_lengths, "d int, place int, total decimal(38,0)")
    sums = stage(sums.groupBy("d", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total")), "whiten-sums")
    common = sums.where("place = -1").orderBy(F.desc("total"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], out).withColumnRenamed("id", id)
    d, n = common["d"], int(common["total"])
    totals = [int(r["total"]) for r in sums.where((F.col("d") == d) & (F.col("place") >= 0)).orderBy("place").collect()]
    release(sums)
    rows = rows.where(F.size("x") == d)
    whole = np.array([s // n for s in totals], np.int64)
    part = np.array([s % n / n for s in totals])

    v = covariance(rows, n, d, lambda x: (x - whole) - part)
    k = min(components, above(v, LEAST * largest(v)))
    if not k:
        return spark.createDataFrame([], out).withColumnRenamed("id", id)
    pairs = [(e, c * np.sign(c[np.abs(c).argmax()])) for e, c in sliced(spark, v, k)]
    values = np.array([e for e, _ in pairs])
    turn = np.stack([c for _, c in pairs], 1) / np.sqrt(values)
    explained = values / np.trace(v)
    error = float(np.abs(covariance(rows, n, k, lambda x: ((x - whole) - part) @ turn) - np.eye(k)).max())
    rest = np.array([s % n for s in totals], np.int64)

    def deviations(x: np.ndarray) -> pa.Array:
        far = (np.abs(x - whole).max(initial=0).item() + 1) * n
        whole_type = np.int64 if far**2 * d < 2**62 else object
        y = (x - whole).astype(whole_type) * n - rest.astype(whole_type)
        return pa.array([s if s < 2**63 else None for s in (y * y).sum(1).tolist()], pa.int64())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, n, np.int64)), deviations(x).take(each), pa.array((((x - whole) - part) @ turn).ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error)),
            ], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, out).withColumnRenamed("id", id)
