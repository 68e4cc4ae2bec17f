"""Ridge and elastic net for whole grids where one or two categories have most of the slots.

Slots of one category never meet in a row, so their part of the Gram matrix is
diagonal, and that of two nested ones (each value of the inner goes with one value
of the outer) becomes so by eliminating the inner first.  All other slots, the
numbers and the intercept are the core, which is dense and small.  A fit solves the
core alone and finds the many slots from it, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.models import array_sums as A
from pitwall.models.dictionary import Encoder
from pitwall.models.gram import _FITTED, _folds, by_fold
from pitwall.session import materialise

#: Slots that the core may have.
MAX_CORE = 2048


def layout(encoder: Encoder, max_core: int | None = None) -> tuple[list[int], int]:
    """Places of the categories that are eliminated, inner one first, and the slots of the core."""
    core, many = encoder.size, []
    for i in sorted(range(len(encoder.categories)), key=lambda i: -encoder.categories[i]["slots"]):
        if core <= (MAX_CORE if max_core is None else max_core):
            break
        many.append(i)
        core -= encoder.categories[i]["slots"]
    return sorted(many, key=lambda i: (-encoder.categories[i]["slots"], -i)), core


def solvable(rows: DataFrame, encoders: Sequence[Encoder] | Mapping[int, Encoder]) -> bool:
    """Is there a small core in each fold, with one or two nested categories outside it?"""
    for fold, e in by_fold(encoders).items():
        many, core = layout(e)
        if core > MAX_CORE or not 1 <= len(many) <= 2:
            return False
        if len(many) == 2:
            # the first entries of a training row are its categories, in order
            inner, outer = (F.col("indices")[i] for i in many)
            per = rows.where((F.col("fold") == fold) & (F.col("side") == 0)).groupBy(inner.alias("i")).agg(F.min(outer).alias("a"), F.max(outer).alias("b"))
            if per.where(F.col("a") != F.col("b")).limit(1).count():
                return False
    return True


def _sums(plans: dict[int, dict]):
    """Per fold: a row for each slot outside the core (core sums, y, outer slot), then the rows of the core."""
    stride = max(p["size"] for p in plans.values()) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[dict, np.ndarray]] = {}
        for batch in batches:
            for fold, part in _folds(batch, "fold"):
                p = plans[fold]
                ends = part.column("indices").offsets.to_numpy()
                row = np.repeat(np.arange(len(part)), np.diff(ends))
                index = part.column("indices").flatten().to_numpy(zero_copy_only=False)
                value = part.column("values").flatten().to_numpy(zero_copy_only=False)
                place = p["place"][index]
                dense = np.zeros((len(part), p["core"] + 2))
                inside = place >= 0
                dense[row[inside], place[inside]] = value[inside]
                dense[:, p["core"]] = 1.0
                dense[:, p["core"] + 1] = part.column("label").to_numpy(zero_copy_only=False) - p["y0"]
                slots, core = held.setdefault(fold, ({}, np.zeros((p["core"] + 2, p["core"] + 2))))
                core += dense.T @ dense
                own = [index[(index >= lo) & (index < hi)] for lo, hi in p["many"]]
                for mine in own:
                    wide = np.column_stack([dense, own[-1]])
                    which, at = np.unique(mine, return_inverse=True)
                    add = np.zeros((len(which), wide.shape[1]))
                    np.add.at(add, at, wide)
                    for k, s in zip(which.tolist(), add):
                        slots[k] = slots[k] + s if k in slots else s
        for fold, (slots, core) in held.items():
            yield A.partial_rows({fold * stride + k: s for k, s in slots.items()})
            yield A.partial_rows({fold * stride + stride - 1: core.ravel()})

    return run, stride


class Arrow:
    """The quadratic w'Hw / 2 - b'w of one fold, H in its parts; w is (inner, outer, core, intercept), ``order`` names its slots."""

    def __init__(self, plan: dict, slots: dict[int, np.ndarray], core: np.ndarray):
        c = plan["core"]
        g = core.reshape(c + 2, c + 2)
        self.n, self.c = g[c, c], c
        keys = [np.arange(lo, hi) for lo, hi in plan["many"]]
        rows = [np.stack([slots[int(k)] for k in ks]) if len(ks) else np.zeros((0, c + 3)) for ks in keys]
        self.cross = np.concatenate([r[:, :c + 1] for r in rows]) / self.n
        self.count = self.cross[:, c]
        y = np.concatenate([r[:, c + 1] for r in rows]) / self.n
        self.split = len(keys[0]) if len(keys) == 2 else 0  # inner slots
        if self.split:
            self.parent = np.rint(rows[0][:, c + 2] / rows[0][:, c]).astype(int) - plan["many"][1][0]
        self.m = len(self.count)
        # an outer slot with the rows of one inner slot is the same column twice
        self.twice = np.zeros(self.m + c + 1, dtype=bool)
        if self.split:
            same = self.count[:self.split] == self.count[self.split:][self.parent]
            self.twice[self.split + self.parent[same]] = True
        self.core = g[:c + 1, :c + 1] / self.n
        self.b = np.concatenate([y, g[:c + 1, c + 1] / self.n])
        self.order = np.concatenate([*keys, plan["slots"]]).astype(int)
        self.top = np.abs(self.b[:-1] - self.b[-1] * np.concatenate([self.count, self.core[:c, c]])).max() if len(self.b) > 1 else 0.0

    def _to_outer(self, inner: np.ndarray) -> np.ndarray:
        out = np.zeros((self.m - self.split, *inner.shape[1:]))
        np.add.at(out, self.parent, inner)
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        many, core = w[:self.m], w[self.m:]
        top = self.count * many + self.cross @ core
        if self.split:
            s = self.split
            top[:s] += self.count[:s] * many[s:][self.parent]
            top[s:] += self._to_outer(self.count[:s] * many[:s])
        return np.concatenate([top, self.cross.T @ many + self.core @ core])

    def solve(self, on: np.ndarray, ridge: float, tiny: float, rhs: np.ndarray) -> np.ndarray:
        """w on the slots ``on`` (the intercept always is, without a penalty), 0 elsewhere."""
        s, m = self.split, self.m
        keep, kept = on[:m], np.append(on[m:-1], True)
        d, r = np.where(keep, self.count + ridge + tiny, 1.0), np.where(keep, rhs[:m], 0.0)
        x = np.where(keep[:, None], self.cross, 0.0) * kept
        if s:
            # both on: the inner slot takes its share of the outer one along
            f = np.where(keep[:s] & keep[s:][self.parent], self.count[:s] / d[:s], 0.0)
            d[s:] -= self._to_outer(f * np.where(keep[:s], self.count[:s], 0.0))
            r[s:] -= self._to_outer(f * r[:s])
            x[s:] -= self._to_outer(f[:, None] * x[:s])
        penalty = np.append(np.where(kept[:-1], ridge + tiny, 1.0), 0.0)
        h = self.core * np.outer(kept, kept) + np.diag(penalty) - x.T @ (x / d[:, None])
        core = np.linalg.solve(h, np.where(kept, rhs[m:], 0.0) - x.T @ (r / d))
        many = (r - x @ core) / d
        if s:
            many[:s] -= f * many[s:][self.parent]
        return np.concatenate([np.where(keep, many, 0.0), core * kept])


def fit(h: Arrow, lasso: float, ridge: float, w: np.ndarray, steps: int = 2000, tol: float = 1e-9) -> np.ndarray:
    """|y - Xw|^2 / 2n + lasso |w|_1 + ridge |w|^2 / 2, the intercept being free, from ``w``.

    All slots that want to move do so at once; what would change its sign stops at 0 if that lowers
    the objective, else the way is followed to its lowest point.  Every step lowers the objective.
    """
    tiny = 1e-10 * max(float(h.count.sum() + np.trace(h.core[:-1, :-1])) / max(len(w) - 1, 1), 1e-30)
    free = np.zeros(len(w), dtype=bool)
    free[-1] = True
    if lasso == 0:
        return h.solve(~free, ridge, tiny, h.b)
    penal, slack = np.where(free, 0.0, ridge + tiny), tol * max(h.top, 1e-30)
    # without a ridge too many at once zigzag between columns that are nearly dependent
    all_at_once, many = ridge > 0, len(w) if ridge > 0 else 64
    w = w.copy()
    for _ in range(steps):
        slope = h.b - h.times(w) - penal * w
        on = (w != 0) & ~free
        # without a ridge the weight of a column that is there twice may stay on one of them
        excess = np.where(on | free | (h.twice & (ridge == 0)), 0.0, np.abs(slope) - lasso)
        settled = max(np.abs(slope[on] - lasso * np.sign(w[on])).max() if on.any() else 0.0, abs(slope[-1])) <= slack
        if settled and excess.max() <= slack:
            break
        sign = np.where(on, np.sign(w), 0.0)
        if settled or all_at_once and many == len(w):
            enter = np.flatnonzero(excess > slack)
            enter = enter[np.argsort(-excess[enter])[:many]]
            sign[enter] = np.sign(slope[enter])
        goal = h.solve((sign != 0), ridge, tiny, h.b - lasso * sign)
        # a slot that wants to enter against its slope does not
        stopped = (goal * sign < 0) & ~free
        moved = False
        for part in (np.where(stopped, 0.0, goal), None):
            if part is None:
                way = goal - w
                with np.errstate(divide="ignore", invalid="ignore"):
                    cross = np.where(~free & (w != 0) & (way != 0), -w / way, np.inf)
                wrong = (w == 0) & stopped
                way[wrong] = 0.0
                cross[~((cross > 0) & (cross <= 1))] = np.inf
                falls = float(slope @ way) - lasso * float((np.where(w != 0, np.sign(w), np.sign(way)) * way * ~free).sum())
                bend = float(way @ (h.times(way) + penal * way))
                order = np.argsort(cross)
                order, t = order[np.isfinite(cross[order])], None
                for i in order:  # the slope along the way jumps at each change of a sign
                    if falls - bend * cross[i] <= 0:
                        break
                    falls -= 2 * lasso * abs(way[i])
                    if falls - bend * cross[i] <= 0:
                        t = cross[i]
                        break
                t = min(max(falls / bend, 0.0), 1.0) if t is None and bend > 0 else t or 0.0
                part = w + t * way
                part[np.abs(cross - t) <= 1e-14 * max(t, 1e-300)] = 0.0
            step = part - w
            change = float(-slope @ step + 0.5 * step @ (h.times(step) + penal * step) + lasso * (np.abs(part) - np.abs(w))[:-1].sum())
            if change < 0:
                w, moved = part, True
                break
        if moved:
            continue
        if many == 1:
            break
        many = 16 if many > 16 else 1
    return w


def _solver(points: list[dict], plans: dict[int, dict], stride: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        fold, which = int(frame["fold"].iloc[0]), int(frame["path"].iloc[0])
        plan = plans[fold]
        found = {int(k) % stride: s for k, s in zip(frame["key"], frame["s"])}
        core = found.pop(stride - 1)
        h = Arrow(plan, found, core)
        out, w = [], np.zeros(len(h.b))
        mine = [(i, p) for i, p in enumerate(points) if p["path"] == which]
        for i, p in sorted(mine, key=lambda e: -e[1]["alpha"]):
            net = "l1_ratio" in p
            lasso, ridge = (p["alpha"] * p["l1_ratio"], p["alpha"] * (1 - p["l1_ratio"])) if net else (0.0, p["alpha"] / h.n)
            w = fit(h, lasso, ridge, w)
            slope = (h.b - h.times(w))[:-1] - ridge * w[:-1]
            off = np.where(w[:-1] != 0, np.abs(slope - lasso * np.sign(w[:-1])), np.maximum(np.abs(slope) - lasso, 0.0))
            coefficients = np.zeros(plan["size"])
            coefficients[h.order] = w[:-1]
            out.append((fold, i, plan["y0"] + w[-1], coefficients, float(off.max() / max(h.top, 1e-30)), int(round(h.n))))
        return pd.DataFrame(out, columns=["fold", "point", "intercept", "coefficients", "violation", "n"]).astype({"fold": "int32", "point": "int32"})

    return run


def fit_grid(rows: DataFrame, encoders: Sequence[Encoder] | Mapping[int, Encoder], points: Sequence[dict]) -> DataFrame:
    """``gram.fit_grid`` for rows with many slots, written."""
    if not solvable(rows, encoders):
        raise ValueError(f"more than {MAX_CORE} slots besides one category or two nested ones: use an iterative solver")
    train = rows.where("side = 0")
    means = {r["fold"]: r["m"] for r in train.groupBy("fold").agg(F.avg("label").alias("m")).collect()}  # one row a fold
    plans = {}
    for fold, e in by_fold(encoders).items():
        many, core = layout(e)
        spans = [(e.categories[i]["offset"], e.categories[i]["offset"] + e.categories[i]["slots"]) for i in many]
        inside = np.ones(e.size, dtype=bool)
        for lo, hi in spans:
            inside[lo:hi] = False
        place = np.where(inside, np.cumsum(inside) - 1, -1)
        plans[fold] = {"many": spans, "core": core, "size": e.size, "place": place, "slots": np.flatnonzero(inside), "y0": float(means[fold])}
    run, stride = _sums(plans)
    partial = train.select("fold", "label", "indices", "values").mapInArrow(run, A.PARTIAL)
    total = partial.withColumn("spread", F.lit(0)).repartition("key").mapInPandas(A.add_all, A.PARTIAL)
    ratios = sorted({p["l1_ratio"] for p in points if "l1_ratio" in p})
    tagged = [{**p, "path": 1 + ratios.index(p["l1_ratio"]) if "l1_ratio" in p else 0} for p in points]
    dealt = materialise(total.select(F.floor(F.col("key") / stride).cast("int").alias("fold"), "key", "s"))
    dealt = dealt.withColumn("path", F.explode(F.array(*[F.lit(i) for i in sorted({p["path"] for p in tagged})])))
    return materialise(dealt.groupBy("fold", "path").applyInPandas(_solver(tagged, plans, stride), _FITTED))
