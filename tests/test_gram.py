import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.evaluation import tournament as T
from pitwall.models import estimators as M
from pitwall.models import gram as G
from pitwall.models import prep
from pitwall.models import wide as W


@pytest.fixture(scope="module")
def cars_rows(spark):
    rng = np.random.default_rng(7)
    n = 400
    team = rng.integers(0, 6, n)
    driver = team * 3 + rng.integers(0, 3, n)
    grid = rng.integers(1, 20, n).astype(float)
    laps = rng.normal(60, 5, n)
    y = 90_000 + 40 * grid - 3 * laps + team * 100 + rng.normal(0, 50, n)
    rows = [(i, f"d{driver[i]}", f"t{team[i]}", None if i % 17 == 0 else float(grid[i]), float(laps[i]), float(y[i]), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "id long, driverId string, constructorId string, grid double, laps double, label double, fold int").repartition(4)


def splits(df, k=3):
    return T.stratified_splits(df, "fold", k)


def matrix(encoder, df):
    rows = encoder.parts(df, "indices", "values").orderBy("id").collect()
    x = np.zeros((len(rows), encoder.size))
    for r, row in enumerate(rows):
        x[r, row["indices"]] = row["values"]
    return x, np.array([r["label"] for r in rows])


NET = [{"alpha": a, "l1_ratio": r} for a in (0.01, 1.0, 10.0) for r in (0.0, 0.25, 1.0)]
RIDGE = [{"alpha": a} for a in (0.01, 1.0, 500.0)]


def test_fits_and_scores_match_dense_matrices(spark, cars_rows):
    parts = splits(cars_rows)
    encoders = [prep.fit_preprocessor(t, ["driverId", "constructorId"], ["grid", "laps"]).stages[0] for t, _ in parts]
    points = RIDGE + NET
    rows = G.encode(parts, encoders)
    fits = G.fit_grid(rows, encoders, points)
    found = {(r["fold"], r["point"]): r for r in fits.collect()}
    scored = G.score_grid(rows, fits, encoders, points)
    assert len(found) == 3 * len(points)
    for f, ((train, valid), e) in enumerate(zip(parts, encoders)):
        x, y = matrix(e, train)
        v, yv = matrix(e, valid)
        xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
        for i, p in enumerate(points):
            r = found[(f, i)]
            w = np.array(r["coefficients"])
            assert r["n"] == n and r["violation"] < 1e-6
            slope = xc.T @ (yc - xc @ w) / n
            if "l1_ratio" not in p:
                assert np.allclose(slope, p["alpha"] / n * w, atol=1e-6 * np.abs(xc.T @ yc / n).max())
            else:
                lasso, ridge = p["alpha"] * p["l1_ratio"], p["alpha"] * (1 - p["l1_ratio"])
                off = np.where(w != 0, np.abs(slope - ridge * w - lasso * np.sign(w)), np.maximum(np.abs(slope) - lasso, 0))
                assert off.max() < 1e-6 * np.abs(xc.T @ yc / n).max()
            for side, (m, t) in enumerate(((x, y), (v, yv))):
                e_ = m @ w + r["intercept"] - t
                got = scored[i][f][side]
                assert got["rmse"] == pytest.approx(np.sqrt((e_ ** 2).mean())) and got["mae"] == pytest.approx(np.abs(e_).mean())
                assert got["r2"] == pytest.approx(1 - (e_ ** 2).sum() / ((t - t.mean()) ** 2).sum())


def test_search_agrees_with_the_estimator(spark, cars_rows):
    parts = splits(cars_rows)
    candidate = M.Candidate("ridge", RIDGE[1:], M.ridge, "linear", gram=True)
    common = dict(categories=["driverId", "constructorId"], numbers=["grid", "laps"])
    got = {str(r["params"]): r for r in T.gram_search(parts, [candidate], **common)["ridge"]}
    want = T.grid_search(parts, candidate, score=T.score_numbers, refit="r2", min_frequency=1, use_smote=False, smote_k=5, classify=False, **common)
    for r in want:
        assert got[str(r["params"])]["cv_rmse_mean"] == pytest.approx(r["cv_rmse_mean"], rel=1e-3)


def test_grids_are_whole():
    pool = {c.name: c for c in M.regressors()}
    assert len(pool["ridge"].grid) == 14 and len(pool["elasticnet"].grid) == 77


def test_too_many_slots(spark, cars_rows, monkeypatch):
    monkeypatch.setattr(G, "MAX_SLOTS", 3)
    candidate = M.Candidate("ridge", RIDGE, M.ridge, "linear", gram=True)
    assert T.gram_search(splits(cars_rows), [candidate], categories=["driverId"], numbers=["grid"]) is None
    with pytest.raises(ValueError):
        G.gram(cars_rows.withColumns({"indices": F.array(F.lit(0)), "values": F.array(F.lit(1.0))}), {0: (9, 1, 0.0)})


@pytest.mark.parametrize("categories, core", [(["driverId", "constructorId"], 9), (["driverId", "constructorId"], 2), (["driverId"], 3)])
def test_many_slots_are_fitted_as_few_are(spark, cars_rows, monkeypatch, categories, core):
    """One large category, and two nested ones, outside the dense core."""
    parts = splits(cars_rows)
    encoders = [prep.fit_preprocessor(t, categories, ["grid", "laps"]).stages[0] for t, _ in parts]
    points = RIDGE + NET
    rows = G.encode(parts, encoders)
    want = {(r["fold"], r["point"]): r for r in G.fit_grid(rows, encoders, points).collect()}
    monkeypatch.setattr(W, "MAX_CORE", core)
    assert W.solvable(rows, encoders)
    fits = W.fit_grid(rows, encoders, points).collect()
    assert len(fits) == len(want)
    for r in fits:
        a, b = want[r["fold"], r["point"]], r
        assert b["violation"] < 1e-6 and a["n"] == b["n"]
        if "l1_ratio" not in points[r["point"]]:
            assert np.allclose(a["coefficients"], b["coefficients"], atol=1e-3) and a["intercept"] == pytest.approx(b["intercept"])


def test_crossed_categories_are_not_eliminated(spark, cars_rows, monkeypatch):
    parts = splits(cars_rows.withColumn("other", F.col("id") % 11))
    encoders = [prep.fit_preprocessor(t, ["driverId", "other"], ["grid"]).stages[0] for t, _ in parts]
    monkeypatch.setattr(W, "MAX_CORE", 2)
    assert not W.solvable(G.encode(parts, encoders), encoders)
