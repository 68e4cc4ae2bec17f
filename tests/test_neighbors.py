import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.models import cells
from pitwall.models import neighbors as NN


def _frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in r], float(i % 3)) for i, r in zip(ids, x)],
                                 "id long, x array<double>, target double").repartition(4)


def _slow(train, queries, k, skip):
    out = {}
    for i, p in queries:
        d = sorted((((p - x) ** 2).sum(), j) for j, x in train if not (skip and i == j))
        out[i] = [(j, v) for v, j in d[:k]]
    return out


def _got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["neighbor_id"], r["dist2"]))
    return {i: [(j, d) for _, j, d in sorted(rows)] for i, rows in out.items()}


@pytest.mark.parametrize("offset", [0.0, 1e7])
def test_clusters_meet_few_cells_and_lose_nothing(spark, offset):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.5, size=(60, 3)) for c in rng.normal(0, 40, size=(8, 3))]) + offset
    x = np.concatenate([x, np.repeat(x[:1], 50, axis=0)])  # and one point many times
    df = _frame(spark, x)
    got, met = NN._nearest(df, df, 4, "id", "x", "target", True, 40)
    rows = list(enumerate(x))
    assert _got(got) == _slow(rows, rows, 4, True)
    _, levels = cells.grow(df.select(F.col("id").alias("key"), "x"), 40)
    last = sum(level.where("last").count() for level in levels)
    assert met.count() < 0.5 * last * last


def test_other_queries_ties_and_fewer_rows_than_k(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, size=(90, 2)).astype(float)
    q = rng.integers(-1, 5, size=(40, 2)).astype(float)
    train, queries = _frame(spark, x), _frame(spark, q, range(500, 540))
    want = _slow(list(enumerate(x)), list(zip(range(500, 540), q)), 7, False)
    assert _got(NN.nearest(train, queries, 7, id_col="id", features="x", block_rows=9)) == want
    few = _got(NN.nearest(train.where("id < 3"), queries, 7, id_col="id", features="x", block_rows=9))
    assert all(len(v) == 3 for v in few.values()) and len(few) == 40


def test_cells_of_equal_rows_are_cut_by_key(spark):
    df = _frame(spark, np.ones((200, 2)))
    rows, levels = cells.grow(df.select(F.col("id").alias("key"), "x"), 20, fan=4)
    sizes = [r["n"] for level in levels for r in level.where("last").collect()]
    assert sum(sizes) == rows.count() == 200 and max(sizes) <= 20
