"""Rows written as vectors, medians by column, fits with many slots as models, shares of a margin."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pitwall.evaluation import tournament as T
from pitwall.models import estimators as M
from pitwall.models import gram, prep, wide

CATEGORIES, NUMBERS = ["driverId", "constructorId"], ["grid", "laps"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    n = 600
    team = rng.integers(0, 6, n)
    driver = team * 3 + rng.integers(0, 3, n)
    grid = rng.integers(1, 20, n).astype(float)
    laps = rng.normal(60, 5, n)
    y = 9_000 + 40 * grid - 3 * laps + team * 100 + rng.normal(0, 50, n)
    made = [(i, f"d{driver[i]}", f"t{team[i]}", None if i % 17 == 0 else float(grid[i]), float(laps[i]), float(y[i]), i % 3) for i in range(n)]
    return spark.createDataFrame(made, "id long, driverId string, constructorId string, grid double, laps double, label double, fold int").repartition(4)


def test_written_vectors_are_those_of_the_transform(rows):
    pre = prep.fit_preprocessor(rows, CATEGORIES, NUMBERS)
    a, b = ({r["id"]: r["features"] for r in df.select("id", "features").collect()} for df in (pre.transform(rows), pre.stages[0].written(rows, "id")))
    assert a == b and len(a) == 600


def test_medians_of_columns_that_fit_no_task(spark, rows, monkeypatch):
    df = rows.select("grid", "laps", F.when(F.col("id") % 7 == 0, F.col("label")).alias("few"), F.lit(None).cast("double").alias("none"))
    want = {c: [r[c] for r in df.select(c).collect() if r[c] is not None] for c in df.columns}
    for limit in (10**6, 100):
        monkeypatch.setattr(prep, "COLUMN_ROWS", limit)
        got = prep.learn_numbers(df, df.columns)
        assert got.fill == {c: float(np.median(v)) if v else 0.0 for c, v in want.items()}


def prepared(rows, name):
    candidate = next(c for c in M.regressors() if c.name == name)
    train, valid = T.stratified_splits(rows, "fold", 3)[0]
    return candidate, T.Prepared(train, valid, candidate, categories=CATEGORIES, numbers=NUMBERS, min_frequency=1, use_smote=False,
                                 smote_k=5, seed=1, classify=False)


@pytest.mark.parametrize("name, params", [("ridge", {"alpha": 5.0}), ("elasticnet", {"alpha": 1.0, "l1_ratio": 0.5})])
def test_a_fit_with_many_slots_is_solved_not_iterated(rows, monkeypatch, tmp_path, name, params):
    candidate, ready = prepared(rows, name)
    want = ready.model(candidate, params, 1)
    monkeypatch.setattr(gram, "MAX_SLOTS", 8)
    monkeypatch.setattr(wide, "MAX_CORE", 8)
    model = ready.model(candidate, params, 1)
    assert isinstance(model, gram.LinearFit)
    a, b = ([r[0] for r in m.transform(ready.valid).orderBy("id").select("prediction").collect()] for m in (want, model))
    assert np.allclose(a, b, rtol=2e-4)
    PipelineModel(stages=[model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(ready.valid).orderBy("id").select("prediction").collect()
    assert [r[0] for r in again] == b


def test_a_search_with_many_slots_needs_no_iteration(rows, monkeypatch):
    splits = T.stratified_splits(rows, "fold", 3)
    # the middle fold has few slots, the others many
    splits[1] = (splits[1][0].where("driverId < 'd3'"), splits[1][1])
    pool = [M.Candidate("ridge", [{"alpha": 1.0}, {"alpha": 50.0}], M.ridge, gram=True),
            M.Candidate("elasticnet", [{"alpha": 0.1, "l1_ratio": 0.5}], M.elastic_net, gram=True)]
    common = dict(categories=CATEGORIES, numbers=NUMBERS)
    want = T.gram_search(splits, pool, **common)
    monkeypatch.setattr(gram, "MAX_SLOTS", 20)
    monkeypatch.setattr(wide, "MAX_CORE", 8)
    got = T.gram_search(splits, pool, **common)
    for name, points in want.items():
        assert [p["params"] for p in got[name]] == [p["params"] for p in points]
        assert [p["cv_r2_mean"] for p in got[name]] == pytest.approx([p["cv_r2_mean"] for p in points], abs=1e-5)


def test_shares_of_the_margin_give_the_same_importances(rows):
    df = rows.select("id", *CATEGORIES, *NUMBERS, (F.col("label") > 9_500).cast("int").alias("label"))
    pre = prep.fit_preprocessor(df, CATEGORIES, NUMBERS)
    model = M.logistic({"C": 1.0}, M.Facts(600), 1).fit(pre.transform(df))
    features = [*NUMBERS, *CATEGORIES]
    want = T.permutation_importance(PipelineModel(stages=[*pre.stages, model]).transform, df, features, ids=["id"], repeats=3).collect()
    got = T.linear_permutation_importance(model, pre.stages[0].written(df, "id", "label"), features, ids=["id"], repeats=3).collect()
    assert got == want and got[0]["importance_mean"] > 0


def test_slots_are_put_together_by_compiled_code(rows):
    pre = prep.fit_preprocessor(rows, CATEGORIES, NUMBERS)
    plan = pre.stages[0].parts(rows, "indices", "values")._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "array_remove" in plan
