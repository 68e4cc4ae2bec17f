"""Ridge and elastic net for whole grids from Gram matrices.

One pass over the training rows of all folds sums X'X and X'y per fold, row by
row of the matrix.  A task per fold solves every penalty from them, and one more
pass scores every (fold, side, penalty) at once.  Neither depends on how many
penalties there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.models import array_sums as A
from pitwall.models.dictionary import Encoder, sparse_parts
from pitwall.session import materialise

#: Slots up to which a Gram matrix is made: a task holds one of them.
MAX_SLOTS = 4096
_FITTED = "fold int, point int, intercept double, coefficients array<double>, violation double, n long"


class Rows:
    """A batch of encoded rows: categorical slots and a dense block of the numbers after them."""

    def __init__(self, batch: pa.RecordBatch, size: int, dense: int):
        ends = batch.column("indices").offsets.to_numpy()
        row = np.repeat(np.arange(len(batch)), np.diff(ends))
        index = batch.column("indices").flatten().to_numpy(zero_copy_only=False)
        value = batch.column("values").flatten().to_numpy(zero_copy_only=False)
        self.size, self.first = size, size - dense
        number = index >= self.first
        self.numbers = np.zeros((len(batch), dense))
        self.numbers[row[number], index[number] - self.first] = value[number]
        self.row, self.slot = row[~number], index[~number]
        self.y = batch.column("label").to_numpy(zero_copy_only=False)

    def add_to(self, g: np.ndarray, y0: float) -> None:
        """Add (X, 1, y - y0)' (X, 1, y - y0)."""
        f = self.first
        dense = np.column_stack([self.numbers, np.ones(len(self.y)), self.y - y0])
        g[f:, f:] += dense.T @ dense
        np.add.at(g[:f, f:], self.slot, dense[self.row])
        # every pair of categories of a row, the row's own entries being neighbours
        counts = np.bincount(self.row, minlength=len(self.y))
        partners, start = counts[self.row], (np.cumsum(counts) - counts)[self.row]
        left = np.repeat(np.arange(len(self.row)), partners)
        right = np.repeat(start, partners) + np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners)
        np.add.at(g, (self.slot[left], self.slot[right]), 1.0)
        g[f:, :f] = g[:f, f:].T

    def times(self, w: np.ndarray) -> np.ndarray:
        """Products with the columns of ``w`` (size x points)."""
        out = self.numbers @ w[self.first:]
        np.add.at(out, self.row, w[self.slot])
        return out


def _folds(batch: pa.RecordBatch, by: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    key = batch.column(by).to_numpy(zero_copy_only=False)
    for k in np.unique(key):
        yield int(k), batch.filter(pa.array(key == k))


def _gram_rows(sizes: dict[int, tuple[int, int, float]]):
    """Rows of fold, label, indices and values to rows of the Gram matrices: key = fold * stride + row."""
    stride = max(s[0] for s in sizes.values()) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, part in _folds(batch, "fold"):
                size, dense, y0 = sizes[fold]
                g = held.setdefault(fold, np.zeros((size + 2, size + 2)))
                Rows(part, size, dense).add_to(g, y0)
        for fold, g in held.items():
            yield A.partial_rows({fold * stride + i: r for i, r in enumerate(g)})

    return run, stride


def gram(rows: DataFrame, sizes: dict[int, tuple[int, int, float]]) -> DataFrame:
    """(fold, i, s): row i of the Gram matrix of (X, 1, y - y0) per fold.

    ``rows`` has fold, label, indices and values; ``sizes`` gives each fold's
    slots, how many of the last are numbers, and y0.
    """
    for size, _, _ in sizes.values():
        if size > MAX_SLOTS:
            raise ValueError(f"{size} slots: a Gram matrix of more than {MAX_SLOTS} does not fit a task, use an iterative solver")
    run, stride = _gram_rows(sizes)
    partial = rows.select("fold", "label", "indices", "values").mapInArrow(run, A.PARTIAL)
    total = partial.repartition("key").mapInPandas(A.add_all, A.PARTIAL)
    # tasks of other spreads hold sums of the same row
    whole = total.withColumn("spread", F.lit(0)).repartition("key").mapInPandas(A.add_all, A.PARTIAL)
    return whole.select(F.floor(F.col("key") / stride).cast("int").alias("fold"), (F.col("key") % stride).cast("int").alias("i"), "s")


# ------------------------------------------------------------ solving

def centred(g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float]:
    """(A, b, column means, mean of y - y0, n): X'X / n and X'y / n around the means."""
    p = len(g) - 2
    n = g[p, p]
    mx, my = g[:p, p] / n, g[p + 1, p] / n
    return g[:p, :p] / n - np.outer(mx, mx), g[:p, p + 1] / n - mx * my, mx, my, n


def solve_ridge(a: np.ndarray, b: np.ndarray, n: float, alphas: Sequence[float]) -> list[np.ndarray]:
    """|y - Xw|^2 + alpha |w|^2 for all alphas from one eigendecomposition."""
    values, vectors = np.linalg.eigh(a)
    turned = vectors.T @ b
    return [vectors @ (turned / (np.maximum(values, 0.0) + alpha / n)) for alpha in alphas]


def solve_net(a: np.ndarray, b: np.ndarray, alpha: float, l1: float, w: np.ndarray, steps: int = 10_000, tol: float = 1e-9) -> np.ndarray:
    """|y - Xw|^2 / 2n + alpha (l1 |w|_1 + (1 - l1) |w|^2 / 2) on the Gram matrix, from ``w``.

    Signs are guessed, the quadratic on the active slots is solved outright, and the
    way there is followed to its best point with a sign change or the end.  Every step
    lowers the objective, so a sign pattern never comes back.
    """
    lasso, ridge = alpha * l1, alpha * (1 - l1)
    # a trace of a ridge tells equal columns apart
    h = a + (ridge + 1e-10 * max(float(np.trace(a)) / max(len(b), 1), 1e-30)) * np.eye(len(b))
    if lasso == 0:
        return np.linalg.solve(h, b)
    usable, slack = np.diag(a) > 1e-12, tol * max(float(np.abs(b).max()), 1e-30)

    w, many = w.copy(), 16
    for _ in range(steps):
        slope = b - h @ w
        on = w != 0
        excess = np.where(on | ~usable, 0.0, np.abs(slope) - lasso)
        settled = not on.any() or np.abs(slope[on] - lasso * np.sign(w[on])).max() <= slack
        if settled and excess.max() <= slack:
            break
        sign = np.sign(w)
        if settled:
            enter = np.argsort(-excess)[:many]
            enter = enter[excess[enter] > slack]
            sign[enter] = np.sign(slope[enter])
            on[enter] = True
        at = np.flatnonzero(on)
        part = h[np.ix_(at, at)]
        way = np.linalg.solve(part, b[at] - lasso * sign[at]) - w[at]
        with np.errstate(divide="ignore", invalid="ignore"):
            cross = -w[at] / way
        times = np.append(np.unique(cross[(cross > 0) & (cross < 1)]), 1.0)
        tries = w[at] + times[:, None] * way
        tries[np.abs(cross[None, :] - times[:, None]) <= 1e-14 * times[:, None]] = 0.0
        # the change of the objective itself: its value would hide small steps
        change = (-times * (way @ slope[at]) + 0.5 * times ** 2 * (way @ part @ way)
                  + lasso * (np.abs(tries) - np.abs(w[at])).sum(1))
        best = int(change.argmin())
        if change[best] < 0:
            w[at], many = tries[best], 16
        elif many > 1:
            many = 1  # several at once may lead nowhere, the worst one alone does not
        else:
            break
    return w


def violation(a: np.ndarray, b: np.ndarray, w: np.ndarray, lasso: float, ridge: float) -> float:
    """How far the optimality conditions are missed, relative to the largest gradient at 0."""
    slope = b - a @ w - ridge * w
    off = np.where(w != 0, np.abs(slope - lasso * np.sign(w)), np.maximum(np.abs(slope) - lasso, 0.0))
    return float(off.max() / max(np.abs(b).max(), 1e-30)) if len(b) else 0.0


def _solver(points: list[dict], offsets: dict[int, float]):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("i")
        fold, which = int(frame["fold"].iloc[0]), int(frame["path"].iloc[0])
        a, b, mx, my, n = centred(np.stack(frame["s"].to_numpy()))
        out, mine = [], [(i, p) for i, p in enumerate(points) if p["path"] == which]
        if mine and "l1_ratio" not in mine[0][1]:
            found = zip(mine, solve_ridge(a, b, n, [p["alpha"] for _, p in mine]))
            solved = [(i, w, 0.0, p["alpha"] / n) for (i, p), w in found]
        else:
            solved, w = [], np.zeros(len(b))
            for i, p in sorted(mine, key=lambda e: -e[1]["alpha"]):  # from the sparsest on, each from the one before
                w = solve_net(a, b, p["alpha"], p["l1_ratio"], w)
                solved.append((i, w, p["alpha"] * p["l1_ratio"], p["alpha"] * (1 - p["l1_ratio"])))
        for i, w, lasso, ridge in solved:
            out.append((fold, i, offsets[fold] + my - float(mx @ w), w, violation(a, b, w, lasso, ridge), int(round(n))))
        return pd.DataFrame(out, columns=["fold", "point", "intercept", "coefficients", "violation", "n"]).astype({"fold": "int32", "point": "int32"})

    return run


def solve(grams: DataFrame, points: Sequence[dict], offsets: dict[int, float]) -> DataFrame:
    """(fold, point, intercept, coefficients, violation, n) for every point: dicts of alpha and,
    for elastic nets, l1_ratio.  Points of one l1_ratio are a path that one task follows."""
    ratios = sorted({p["l1_ratio"] for p in points if "l1_ratio" in p})
    tagged = [{**p, "path": 1 + ratios.index(p["l1_ratio"]) if "l1_ratio" in p else 0} for p in points]
    paths = sorted({p["path"] for p in tagged})
    dealt = grams.withColumn("path", F.explode(F.array(*[F.lit(i) for i in paths])))
    return dealt.groupBy("fold", "path").applyInPandas(_solver(tagged, offsets), _FITTED)


# ------------------------------------------------------------ folds

def encode(splits: Sequence[tuple[DataFrame, DataFrame]], encoders: Sequence[Encoder]) -> DataFrame:
    """Both sides of all folds as rows (fold, side, label, indices, values), written once;
    side 0 is training.  Each fold's rows went through its own encoder."""
    out = None
    for i, ((train, valid), encoder) in enumerate(zip(splits, encoders)):
        for side, df in enumerate((train, valid)):
            part = encoder.parts(df, "indices", "values").select(
                F.lit(i).alias("fold"), F.lit(side).alias("side"), F.col("label").cast("double").alias("label"), "indices", "values")
            out = part if out is None else out.unionByName(part)
    return materialise(out)


def by_fold(encoders: Sequence[Encoder] | Mapping[int, Encoder]) -> dict[int, Encoder]:
    return dict(encoders) if isinstance(encoders, Mapping) else dict(enumerate(encoders))


def fit_grid(rows: DataFrame, encoders: Sequence[Encoder] | Mapping[int, Encoder], points: Sequence[dict]) -> DataFrame:
    """The fits of all points in all folds, written."""
    train = rows.where("side = 0")
    means = {r["fold"]: r["m"] for r in train.groupBy("fold").agg(F.avg("label").alias("m")).collect()}  # one row a fold
    sizes = {i: (e.size, len(e.numbers), float(means[i])) for i, e in by_fold(encoders).items()}
    return materialise(solve(gram(train, sizes), points, {i: s[2] for i, s in sizes.items()}))


def _scorer(weights: dict[int, tuple[np.ndarray, np.ndarray]], dense: dict[int, int], y0: float):
    """Per (fold, side) and point: rows, squared and absolute errors, labels and squared labels around y0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, part in _folds(batch, "key"):
                w, b = weights[key // 2]
                x = Rows(part, len(w), dense[key // 2])
                error = x.times(w) + b - x.y[:, None]
                y = x.y - y0
                one = np.stack([np.full(len(b), len(y)), (error * error).sum(0), np.abs(error).sum(0),
                                np.full(len(b), y.sum()), np.full(len(b), (y * y).sum())])
                sums[key] = sums[key] + one.ravel() if key in sums else one.ravel()
        if sums:
            yield A.partial_rows(sums)

    return run


def score_grid(rows: DataFrame, fits: DataFrame, encoders: Sequence[Encoder], points: Sequence[dict]) -> list[list[tuple[dict, dict]]]:
    """Per point and fold: metrics on training and validation rows, from one pass over each fold.

    The coefficients of one fold at a time come to the driver: points x slots numbers.
    """
    y0 = float(rows.agg(F.avg("label")).first()[0])
    tagged = rows.select((F.col("fold") * 2 + F.col("side")).alias("key"), "fold", "label", "indices", "values")
    sums = {}
    for i, e in enumerate(encoders):
        own = {r["point"]: (np.array(r["coefficients"]), r["intercept"]) for r in fits.where(F.col("fold") == i).toLocalIterator()}
        weights = {i: (np.column_stack([own[p][0] for p in range(len(points))]).reshape(e.size, len(points)),
                       np.array([own[p][1] for p in range(len(points))]))}
        mine = tagged.where(F.col("fold") == i).drop("fold")
        sums |= A.collected(mine.mapInArrow(_scorer(weights, {i: len(e.numbers)}, y0), A.PARTIAL))

    def metrics(key: int, point: int) -> dict:
        n, sse, sae, sy, syy = sums[key].reshape(5, -1)[:, point]
        sst = syy - sy * sy / n
        return {"rmse": float(np.sqrt(sse / n)), "mae": float(sae / n), "r2": float(1 - sse / sst) if sst > 0 else None}

    return [[(metrics(2 * f, p), metrics(2 * f + 1, p)) for f in range(len(encoders))] for p in range(len(points))]


# ------------------------------------------------------------ one fit as a model

class LinearFit(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A solved fit as a stage: ``features`` to ``prediction``."""

    weights = Param(Params._dummy(), "weights", "coefficient of each slot", TypeConverters.toListFloat)
    start = Param(Params._dummy(), "start", "intercept", TypeConverters.toFloat)

    def __init__(self, coefficients: Sequence[float] = (), intercept: float = 0.0):
        super().__init__()
        self._set(weights=[float(w) for w in coefficients], start=float(intercept))

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.weights))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.start)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        w, w0 = np.array(self.getOrDefault(self.weights)), self.intercept

        @F.arrow_udf("double")
        def margin(indices: pa.Array, values: pa.Array) -> pa.Array:
            index = indices.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(indices)), np.diff(indices.offsets.to_numpy()))
            parts = w[index] * values.flatten().to_numpy(zero_copy_only=False)
            return pa.array(w0 + np.bincount(row, parts, minlength=len(indices)))

        found = sparse_parts("features")
        return dataset.withColumn("prediction", margin(found["indices"], found["values"]))
