"""Exact k nearest neighbours on array columns, and the models built on them.

Both sides are dealt into pivot cells.  A query cell first meets the training
cells nearest to it, which bounds the k-th distance of each of its rows; then it
meets only the cells that the triangle inequality cannot rule out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.models import cells
from pitwall.models.blocks import BLOCK_ROWS
from pitwall.session import materialise

_FOUND = "key bigint, neighbor_id bigint, dist2 double, target double"
#: Cells that a query cell meets first; more if these have too few rows.
FIRST_CELLS = 2
#: Relative slack of bounds, far above rounding.
SLACK = 1e-9


def _nearest_in_cell(k: int):
    def run(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"key": [], "neighbor_id": [], "dist2": [], "target": []})
        if q.empty or t.empty:
            return none
        p, x = np.stack(q["x"].to_numpy()), np.stack(t["x"].to_numpy())
        keys, ids, y = q["key"].to_numpy(), t["neighbor_id"].to_numpy(), t["target"].to_numpy(dtype=float)
        limit = q["limit"].to_numpy(dtype=float)
        # rough distances around a row of the cell, so that an offset of all rows costs no digits
        ps, xs = p - x[0], x - x[0]
        pn, xn = (ps * ps).sum(1), (xs * xs).sum(1)
        rough = pn[:, None] + xn[None, :] - 2.0 * (ps @ xs.T)
        error = (pn + xn.max()) * (1e-13 * (p.shape[1] + 8))  # bounds what the products round off
        m = min(k, len(ids))
        kth = np.partition(rough, m - 1, axis=1)[:, m - 1]
        bar = np.minimum(kth, limit * (1 + SLACK)) + 2 * error
        rows, columns = np.nonzero(rough <= bar[:, None])
        if not len(rows):
            return none
        exact = ((p[rows] - x[columns]) ** 2).sum(1)
        order = np.lexsort((ids[columns], exact, rows))
        rows, columns, exact = rows[order], columns[order], exact[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < k
        rows, columns = rows[keep], columns[keep]
        return pd.DataFrame({"key": keys[rows], "neighbor_id": ids[columns], "dist2": exact[keep], "target": y[columns]})

    return run


def _first(found: DataFrame, by: str, k: int) -> DataFrame:
    best = Window.partitionBy(by).orderBy("dist2", "neighbor_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _gap(q_radius: str = "q_radius"):
    """Least distance between rows of a query cell and rows of a cell."""
    d = cells.distance(F.col("q_centre"), F.col("centre"))
    return d - (F.col(q_radius) + F.col("radius")) - (d + F.col(q_radius) + F.col("radius")) * SLACK


def _search(queries: DataFrame, train: DataFrame, k: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(key, neighbor_id, dist2, target) with the first k among them, and the (q, cell) pairs that met."""
    rows, levels = cells.grow(train, block_rows)
    asked, own = cells.grow(queries, block_rows)
    last = own[0].where("last")
    for level in own[1:]:
        last = last.unionByName(level.where("last"))
    start = materialise(last.select(F.col("cell").alias("q"), F.col("centre").alias("q_centre"), F.col("radius").alias("q_radius")))

    def nearest_cells(pairs: DataFrame) -> DataFrame:
        order = Window.partitionBy("q").orderBy("d", "cell")
        placed = pairs.withColumn("d", cells.distance(F.col("q_centre"), F.col("centre"))).withColumns({
            "place": F.row_number().over(order), "before": F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
        return placed.where((F.col("place") <= FIRST_CELLS) | (F.col("before") < k))

    def look(pairs: DataFrame, limits: DataFrame) -> DataFrame:
        met = limits.withColumnRenamed("cell", "q").join(pairs, "q").select("cell", "key", "x", "limit")
        return cells.meet(met, "key", rows.select("cell", "neighbor_id", "x", "target"), _nearest_in_cell(k), _FOUND, block_rows)

    near = materialise(cells.follow(start, levels, nearest_cells))
    unknown = asked.withColumn("limit", F.lit(float("inf")))
    found = materialise(look(near, unknown))
    kth = _first(found, "key", k).groupBy("key").agg(F.max("dist2").alias("d"), F.count(F.lit(1)).alias("n"))
    bounded = materialise(asked.join(kth.where(F.col("n") == k).select("key", "d"), "key", "left").select(
        "key", "x", "cell", F.coalesce("d", F.lit(float("inf"))).alias("limit")))
    reach = start.join(bounded.groupBy(F.col("cell").alias("q")).agg(F.sqrt(F.max("limit")).alias("far")), "q")
    far = materialise(cells.follow(reach, levels, lambda pairs: pairs.where(_gap() <= F.col("far"))).join(near, ["q", "cell"], "left_anti"))
    # a row skips the cells that its own bound rules out
    ball = levels[0].where("last")
    for level in levels[1:]:
        ball = ball.unionByName(level.where("last"))
    met = bounded.withColumnRenamed("cell", "q").join(far, "q").join(ball.select("cell", "centre", "radius"), "cell")
    d = cells.distance(F.col("x"), F.col("centre"))
    met = met.where(d - F.col("radius") - (d + F.col("radius")) * SLACK <= F.sqrt("limit")).select("cell", "key", "x", "limit")
    more = cells.meet(met, "key", rows.select("cell", "neighbor_id", "x", "target"), _nearest_in_cell(k), _FOUND, block_rows)
    return found.unionByName(more), near.unionByName(far)


def nearest(train: DataFrame, queries: DataFrame, k: int, *, id_col: str, features: str,
            target: str | None = None, skip_self: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, neighbor_id, dist2, target, rank): the k nearest train rows of each query.

    Exact by squared Euclidean distance, ties to the smaller id.  Equal queries
    are searched once, and of equal train rows only the smallest ids take part.
    """
    return _nearest(train, queries, k, id_col, features, target, skip_self, block_rows)[0]


def _nearest(train, queries, k, id_col, features, target, skip_self, block_rows):
    x = F.col(features).cast("array<double>").alias("x")
    y = (F.col(target).cast("double") if target else F.lit(0.0)).alias("target")
    deep = k + skip_self
    t = train.select(F.col(id_col).cast("bigint").alias("neighbor_id"), x, y)
    t = t.withColumn("r", F.row_number().over(Window.partitionBy("x").orderBy("neighbor_id"))).where(F.col("r") <= deep).drop("r")
    q = materialise(queries.select(F.col(id_col).cast("bigint").alias("query_id"), x))
    distinct = q.groupBy("x").agg(F.min("query_id").alias("key"))
    found, met = _search(distinct, t.withColumn("key", F.col("neighbor_id")), deep, block_rows)
    near = _first(found, "key", deep)
    named = q.join(distinct, "x").select("query_id", "key").join(near.drop("rank"), "key").drop("key")
    if skip_self:
        named = named.where(F.col("query_id") != F.col("neighbor_id"))
    return _first(named, "query_id", k).select("query_id", "neighbor_id", "dist2", "target", "rank"), met


def _weighted(neighbours: DataFrame, weights: str) -> DataFrame:
    """Add the weight of each neighbour; a neighbour at distance 0 takes it all."""
    if weights == "uniform":
        return neighbours.withColumn("w", F.lit(1.0))
    if weights != "distance":
        raise ValueError(f"unknown weights {weights!r}")
    closest = F.min("dist2").over(Window.partitionBy("query_id"))
    return neighbours.withColumn("w", F.when(closest == 0, F.when(F.col("dist2") == 0, 1.0).otherwise(0.0))
                                 .otherwise(1.0 / F.sqrt(F.nullif(F.col("dist2"), F.lit(0.0)))))


def knn_classify(train, queries, k=7, *, id_col, features, target, weights="uniform", **kw) -> DataFrame:
    """(query_id, prediction): weighted vote, ties to the smaller class."""
    near = _weighted(nearest(train, queries, k, id_col=id_col, features=features, target=target, **kw), weights)
    votes = near.groupBy("query_id", "target").agg(F.sum("w").alias("v"))
    return votes.groupBy("query_id").agg(
        F.min_by("target", F.struct(-F.round("v", 9), F.col("target"))).alias("prediction"))


def knn_regress(train, queries, k=7, *, id_col, features, target, weights="uniform", **kw) -> DataFrame:
    """(query_id, prediction): weighted mean of the neighbours."""
    near = _weighted(nearest(train, queries, k, id_col=id_col, features=features, target=target, **kw), weights)
    return near.groupBy("query_id").agg((F.sum(F.col("w") * F.col("target")) / F.sum("w")).alias("prediction"))
