"""Trees on sparse rows against MLlib's on the same rows."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from pitwall.models import estimators as M
from pitwall.models import trees as S
from pitwall.models.prep import fit_preprocessor


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    made = []
    for i in range(600):
        a, b = int(rng.integers(0, 40) ** 2 // 40), int(rng.integers(0, 4))
        x, u = float(rng.integers(0, 12)), float(rng.normal())
        y = 3.0 * (a == 7) + (x > 5) * (1 + b) + u + float(rng.normal()) / 3
        made.append((i, f"a{a}", None if i % 50 == 0 else f"b{b}", x, u, y, float(y > 2), 1.0 + i % 3))
    df = spark.createDataFrame(made, "id long, a string, b string, x double, u double, y double, c double, w double")
    pre = fit_preprocessor(df, ["a", "b"], ["x", "u"], kind="tree")
    return pre, pre.transform(df).cache()


def both(model, plain, rows, column="prediction"):
    got = {r["id"]: r[column] for r in model.transform(rows).select("id", column).collect()}
    want = {r["id"]: r[column] for r in plain.transform(rows).select("id", column).collect()}
    assert len(got) == 600
    return np.array([got[i] for i in range(600)]), np.array([want[i] for i in range(600)])


def test_boosted_trees_are_those_of_mllib(rows, monkeypatch):
    _, rows = rows
    monkeypatch.setattr(S, "STEPS", 2)
    for label, sparse, plain in (("y", M.boosted_regressor, GBTRegressor), ("c", M.boosted_classifier, GBTClassifier)):
        mine = rows.withColumn("label", F.col(label))
        p = {"n_estimators": 6, "learning_rate": 0.3, "max_depth": 3}
        model = sparse(p, M.Facts(600), 42).fit(mine)
        assert isinstance(model, S.TreesModel)
        reference = plain(maxIter=6, stepSize=0.3, maxDepth=3, seed=42).fit(mine)
        got, want = both(model, reference, mine)
        assert np.allclose(got, want, rtol=1e-9, atol=1e-9)
        # two slots may split a node alike: only their importances depend on which is taken
        assert np.allclose(model.featureImportances.toArray(), reference.featureImportances.toArray(), atol=1e-3)


def test_single_trees_with_weights_are_those_of_mllib(rows):
    # a number of few values, as MLlib counts rows by weight where it has to choose cuts
    rows = rows[1].drop("features")
    rows = fit_preprocessor(rows, ["a", "b"], ["x"], kind="tree").transform(rows).cache()
    for label, plain, classify in (("y", DecisionTreeRegressor, False), ("c", DecisionTreeClassifier, True)):
        mine = rows.withColumn("label", F.col(label))
        spec = S.Spec(1, 5, 4, "all", False, classify, 42, bootstrap=False)
        model = S.SparseTrees(spec, plain()).setWeightCol("w").fit(mine)
        reference = plain(maxDepth=5, minInstancesPerNode=4, weightCol="w").fit(mine)
        got, want = both(model, reference, mine)
        assert np.allclose(got, want) and len(model.trees[0].column) > 15


def test_forest_draws_slots_and_rows(spark, rows, tmp_path, monkeypatch):
    pre, rows = rows
    mine = rows.withColumn("label", F.col("c"))
    p = {"n_estimators": 20, "max_depth": 6, "min_samples_leaf": 2}
    model = M.forest_classifier(p, M.Facts(600), 42).fit(mine)
    reference = RandomForestClassifier(numTrees=20, maxDepth=6, minInstancesPerNode=2, seed=42).fit(mine)
    truth = np.array([r["c"] for r in mine.orderBy("id").collect()])
    got, want = both(model, reference, mine)
    assert np.mean(got == truth) > np.mean(want == truth) - 0.05 > 0.7
    assert len({tuple(t.column) for t in model.trees}) > 10
    # groups of few nodes and another deal of the rows give the same forest
    monkeypatch.setattr(S, "CELLS", 60)
    again = M.forest_classifier(p, M.Facts(600), 42).fit(mine.repartition(3, "x"))
    assert [t.column for t in again.trees] == [t.column for t in model.trees]
    # stored with its encoder and loaded
    PipelineModel(stages=[*pre.stages, model]).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).stages[-1]
    a, b = both(model, loaded, mine, "probability")
    assert np.array_equal(np.array(a.tolist()), np.array(b.tolist()))


def test_a_row_costs_its_columns_not_the_slots(spark):
    """20 000 categories: MLlib keeps 20 000 numbers a row, here a row has 5 bytes besides its ids."""
    df = spark.range(20_000).select("id", F.concat(F.lit("d"), "id").alias("d"), (F.col("id") % 9).cast("double").alias("x"))
    made = fit_preprocessor(df, ["d"], ["x"], kind="tree").transform(df.withColumn("label", F.col("x") * 2))
    model = M.boosted_regressor({"n_estimators": 2, "learning_rate": 1.0, "max_depth": 3}, M.Facts(20_000), 42).fit(made)
    assert model.transform(made).where(F.abs(F.col("prediction") - F.col("label")) > 2).count() == 0
    facts = made.schema["features"].metadata["slots"]
    parts = made.select("id", "label", F.lit(1.0).alias("weight"), S.sparse_parts("features").alias("f")).select("id", "label", "weight", "f.*")
    kept = S._compact(parts, model.layout).first()
    assert facts["size"] == 20_001 and len(kept["slots"]) + len(kept["bins"]) == 5
