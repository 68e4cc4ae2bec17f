"""Pivot cells: rows dealt to near pivots level by level, with measured radii.

A cell above ``block`` rows is cut by pivots that a farthest-first walk picks
from a bounded sample of it; every row goes to its nearest pivot.  A cell's
centre is one of its rows and its radius the distance of the farthest one, taken
over all of them, so the triangle inequality bounds every distance to the cell.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.session import materialise

#: Pivots of a cell, and rows of the sample they are picked from.
FAN, SAMPLE = 16, 512
_SHARES = 1 << 30


def distance(x: Column, y: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))


def meet(many: DataFrame, spread: str, few: DataFrame, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
         schema: str, limit: int) -> DataFrame:
    """Rows of both sides with the same ``cell``, in groups of about ``limit`` rows of
    ``many`` at most; ``few`` is repeated for each group of its cell."""
    groups = many.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("groups"))
    left = many.join(groups, "cell").withColumn("part", F.pmod(F.xxhash64(spread), "groups").cast("int")).drop("groups")
    right = few.join(groups, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
    return left.groupBy("cell", "part").cogroup(right.groupBy("cell", "part")).applyInPandas(fn, schema)


def balls(rows: DataFrame) -> DataFrame:
    """(cell, n, centre, radius) of rows with key, cell and x."""
    centre = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min_by("x", "key").alias("centre"))
    far = rows.join(centre.select("cell", "centre"), "cell").groupBy("cell").agg(F.max(distance(F.col("x"), F.col("centre"))).alias("radius"))
    return centre.join(far, "cell")


def _pivots(fan: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        x = np.stack(frame["x"].to_numpy())
        near, picked = np.full(len(x), np.inf), [0]
        while len(picked) <= fan:
            near = np.minimum(near, ((x - x[picked[-1]]) ** 2).sum(1))
            if len(picked) == fan or near.max() == 0:
                break
            picked.append(int(near.argmax()))
        return pd.DataFrame({"cell": frame["cell"].iloc[0], "child": np.arange(len(picked), dtype="int32"), "x": [frame["x"].iloc[p] for p in picked]})

    return run


def _deal(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    if rows.empty or pivots.empty:
        return pd.DataFrame({"key": [], "child": []}).astype({"key": "int64", "child": "int32"})
    x = np.stack(rows["x"].to_numpy())
    gap = np.stack([((x - p) ** 2).sum(1) for p in pivots["x"]], axis=1)
    return pd.DataFrame({"key": rows["key"].to_numpy(), "child": pivots["child"].to_numpy()[gap.argmin(1)]})


def grow(points: DataFrame, block: int, fan: int = FAN) -> tuple[DataFrame, list[DataFrame]]:
    """(rows with their last cell, levels) of rows with a unique ``key`` and ``x``.

    A level is (cell, parent, n, centre, radius, last).  Rows that are all one
    point are cut by key, so no cell stays above ``block`` rows for good.
    """
    rows = materialise(points.withColumn("cell", F.lit(0).cast("long")))
    levels, closed, parents = [], None, None
    while True:
        level = balls(rows).withColumn("last", F.col("n") <= block)
        level = level.join(parents, "cell") if parents is not None else level.withColumn("parent", F.lit(None).cast("long"))
        level = materialise(level)
        levels.append(level)
        done = rows.join(level.where("last").select("cell"), "cell", "left_semi")
        closed = done if closed is None else closed.unionByName(done)
        large = level.where(~F.col("last")).select("cell", "n", "radius")
        if large.isEmpty():
            return closed, levels
        depth = len(levels)
        left = rows.join(large, "cell")
        draw = F.xxhash64("key", F.lit(depth))
        chosen = left.where((F.col("radius") > 0) & (F.pmod(draw, F.lit(_SHARES)) < F.lit(_SHARES * 2.0 * SAMPLE) / F.col("n")))
        first = F.row_number().over(Window.partitionBy("cell").orderBy(draw, "key"))
        sample = chosen.withColumn("r", first).where(F.col("r") <= SAMPLE).select("cell", "key", "x")
        pivots = materialise(sample.groupBy("cell").applyInPandas(_pivots(fan), "cell long, child int, x array<double>"))
        dealt = meet(left.select("cell", "key", "x"), "key", pivots, _deal, "key long, child int", 16 * block)
        by_key = F.pmod(F.xxhash64("key", F.lit(-depth)), F.lit(fan)).cast("int")
        moved = left.drop("n", "radius").join(dealt, "key", "left").withColumn("child", F.coalesce("child", by_key))
        moved = materialise(moved.withColumn("parent", F.col("cell")).withColumn("cell", F.xxhash64("parent", "child")).drop("child"))
        parents = materialise(moved.select("cell", "parent").distinct())
        rows = moved.drop("parent")


def follow(start: DataFrame, levels: list[DataFrame], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(q, cell) of the last cells reached from the root by what ``keep`` leaves of the
    pairs of each level; ``start`` has q and whatever ``keep`` looks at besides the level."""
    out, frontier = None, None
    for level in levels:
        if frontier is None:
            pairs = start.join(F.broadcast(level.drop("parent")), F.lit(True))  # the root is one row
        else:
            pairs = frontier.join(start, "q").join(level, "parent").drop("parent")
        kept = materialise(keep(pairs).select("q", "cell", "last"))
        last = kept.where("last").select("q", "cell")
        out = last if out is None else out.unionByName(last)
        frontier = kept.where(~F.col("last")).select("q", F.col("cell").alias("parent"))
    return out
