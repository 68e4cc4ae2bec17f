import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from pitwall.evaluation import clusters as CL
from pitwall.evaluation import tournament as T
from pitwall.models.blocks import block_pairs
from pitwall.models import clustering as C
from pitwall.models import estimators as M
from pitwall.models import neighbors as NN
from pitwall.models import prep
from pitwall.models.smote import smote
from pitwall.operators import sampling as G


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(c, 1.0, size=(n, 3)) for c, n in ((0, 60), (4, 40), (9, 20))])
    label = np.repeat([0, 1, 2], [60, 40, 20])
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], int(label[i])) for i in range(len(x))],
                               "id long, x array<double>, label int").repartition(3)
    return df, x, label


def _distances(x):
    return np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(2))


@pytest.mark.parametrize("block_rows", [17, 1000])
def test_nearest_matches_brute_force(cloud, block_rows):
    df, x, _ = cloud
    d = _distances(x)
    np.fill_diagonal(d, np.inf)
    got = {}
    for r in NN.nearest(df, df, 4, id_col="id", features="x", skip_self=True, block_rows=block_rows).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["neighbor_id"]))
    for i in range(len(x)):
        assert [n for _, n in sorted(got[i])] == list(np.argsort(d[i], kind="stable")[:4])


def test_knn_votes(cloud):
    df, x, label = cloud
    out = NN.knn_classify(df, df, 5, id_col="id", features="x", target="label", weights="distance").collect()
    # at distance 0 the row itself decides
    assert all(r["prediction"] == label[r["query_id"]] for r in out)
    mean = {r["query_id"]: r["prediction"] for r in
            NN.knn_regress(df, df, 3, id_col="id", features="x", target="label").collect()}
    near = np.argsort(_distances(x), axis=1, kind="stable")[:, :3]
    assert all(abs(mean[i] - label[near[i]].mean()) < 1e-12 for i in range(len(x)))


@pytest.mark.parametrize("block_rows", [19, 1000])
def test_silhouette_and_indices(cloud, block_rows):
    df, x, label = cloud
    d, s = _distances(x), []
    for i in range(len(x)):
        own = label == label[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, label == c].mean() for c in set(label) - {label[i]})
        s.append((b - a) / max(a, b))
    assert CL.silhouette_exact(df, "id", "x", "label", block_rows).first()[0] == pytest.approx(np.mean(s), abs=1e-9)
    centres = np.array([x[label == c].mean(0) for c in range(3)])
    sizes = np.array([(label == c).sum() for c in range(3)])
    between = (sizes * ((centres - x.mean(0)) ** 2).sum(1)).sum()
    within = sum(((x[label == c] - centres[c]) ** 2).sum() for c in range(3))
    assert CL.calinski_harabasz(df, "x", "label", 3).first()[0] == pytest.approx(between * (len(x) - 3) / (within * 2))
    spread = [np.sqrt(((x[label == c] - centres[c]) ** 2).sum(1)).mean() for c in range(3)]
    gaps = _distances(centres)
    db = np.mean([max((spread[i] + spread[j]) / gaps[i, j] for j in range(3) if j != i) for i in range(3)])
    assert CL.davies_bouldin(df, "x", "label", 3).first()[0] == pytest.approx(db)


def test_smote_balances_and_interpolates(cloud):
    df, x, label = cloud
    made = smote(df, id_col="id", features="x", label="label", k=3).collect()
    counts = {c: sum(r["label"] == c for r in made) for c in range(3)}
    assert counts == {0: 60, 1: 60, 2: 60}
    for r in made:
        if r["synthetic"]:
            pts = x[label == r["label"]]
            assert (np.array(r["x"]) >= pts.min(0) - 1e-9).all() and (np.array(r["x"]) <= pts.max(0) + 1e-9).all()
    again = smote(df.repartition(5), id_col="id", features="x", label="label", k=3).collect()
    assert sorted(map(str, made)) == sorted(map(str, again))


def _vectors(df):
    return df.withColumn("features", array_to_vector("x"))


@pytest.mark.parametrize("alpha", [0.5, 20.0])
def test_ridge_matches_closed_form(spark, alpha):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 4))
    y = x @ np.array([3.0, -2.0, 0.0, 1.0]) + 5 + rng.normal(size=200)
    df = _vectors(spark.createDataFrame([([float(v) for v in r], float(t)) for r, t in zip(x, y)], "x array<double>, label double"))
    model = M.ridge({"alpha": alpha}, M.Facts(200, float(np.std(y, ddof=1))), 1).fit(df)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-3)


def test_preprocessor_groups_rare_and_ignores_unknown(spark):
    train = spark.createDataFrame([(i, "a" if i < 12 else "b" if i < 23 else f"r{i}", float(i)) for i in range(26)],
                                  "id long, driverId string, grid double")
    test = spark.createDataFrame([(0, "a", 1.0), (1, "r24", None), (2, "never", 3.0)], "id long, driverId string, grid double")
    pre = prep.fit_preprocessor(train, ["driverId", "absent"], ["grid", "lat"], min_frequency=10)
    rows = {r["id"]: r["v"] for r in pre.transform(test).select("id", vector_to_array("features").alias("v")).collect()}
    assert rows[0][:3] == [1.0, 0.0, 0.0] and rows[1][:3] == [0.0, 0.0, 1.0] and rows[2][:3] == [0.0, 0.0, 0.0]
    values = np.arange(26.0)
    assert rows[0][3] == pytest.approx((1.0 - values.mean()) / values.std())
    assert rows[1][3] == pytest.approx((12.5 - values.mean()) / values.std())  # the median fills
    with pytest.raises(ValueError):
        prep.fit_preprocessor(train, ["absent"], ["lat"])


def test_tournament_and_store(spark, cloud, tmp_path):
    df, _, _ = cloud
    rows = df.select("id", F.col("x")[0].alias("grid"), F.col("x")[1].alias("round"), (F.col("label") > 0).cast("int").alias("label"))
    folded = G.fold_stratified(rows, ["id"], "label", 5)
    pool = [c for c in M.classifiers() if c.name in ("logreg", "knn", "rf")]
    table, best = T.tournament(rows, rows, T.stratified_splits(folded), pool, categories=[], numbers=["grid", "round"],
                               classify=True, use_smote=True, smote_k=3)
    got = {r["model"]: r for r in table.collect()}
    assert set(got) == {"logreg", "knn", "rf"} and all(0.8 < r["cv_f1_macro_mean"] <= 1 for r in got.values())
    assert best["cv"] == max(r["cv_f1_macro_mean"] for r in got.values())
    pre = prep.fit_preprocessor(rows, [], ["grid", "round"])
    ready = pre.transform(rows)
    logit = M.logistic({"C": 1.0}, M.Facts(rows.count()), 1).fit(ready)
    whole = PipelineModel(stages=[*pre.stages, logit])
    whole.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    a = [r[0] for r in whole.transform(rows).orderBy("id").select("prediction").collect()]
    assert a == [r[0] for r in loaded.transform(rows).orderBy("id").select("prediction").collect()]
    top = T.feature_importance(logit, ready).collect()
    assert len(top) == 2 and top[0]["importance"] >= top[1]["importance"] and top[0]["feature"] in ("grid__n", "round__n")
    drops = {r["feature"]: r["importance_mean"] for r in
             T.permutation_importance(whole.transform, rows, ["grid", "round"], ids=["id"], repeats=2).collect()}
    assert set(drops) == {"grid", "round"} and max(drops.values()) > 0


def test_folds_of_time_never_train_on_the_future(spark, cars):
    folds = G.fold_time_series(cars, 5)
    rows = folds.join(G.races_of(cars), "raceId").collect()
    for i in range(5):
        train = [r["raceId"] for r in rows if r["fold"] == i and r["role"] == "train"]
        valid = [r["raceId"] for r in rows if r["fold"] == i and r["role"] == "valid"]
        assert len(valid) == 10 and max(train) < min(valid)
    splits = T.race_splits(cars, folds, 5)
    assert splits[4][1].count() == 80


def test_cluster_report(spark, cloud):
    df, _, _ = cloud
    rows = df.select(F.col("id").alias("raceId"), *[F.col("x")[i].alias(f"f{i}") for i in range(3)], (F.col("id") % 7).alias("year"))
    out = C.cluster_report(rows, k_final=3, k_min=2, k_max=4, n_init=2)
    facts = out["metrics"].first()
    assert facts["n_features"] == 3 and facts["n_samples"] == 120 and facts["silhouette_squared"] > 0.4
    assert out["labels"].count() == 120 and out["profile"].count() == 3 and out["points"].columns[-2:] == ["pc1", "pc2"]
    assert C.best_k(out["search"]).first()["k"] in (2, 3)
    assert out["model"].transform(rows).select("cluster").distinct().count() == 3


def test_log_target_and_target_mode(spark):
    df = spark.createDataFrame([(1.0, -2.0, 5.0), (3.0, 1.0, float("nan"))], "target_reg double, target_resid double, circuit_baseline_pace double")
    assert prep.log_target(df, "target_reg", "y")[1] and not prep.log_target(df, "target_resid", "y")[1]
    rows, residual = prep.choose_target(df, "residual")
    assert residual and [r["y"] for r in rows.collect()] == [-2.0, 1.0] and "target_reg" not in rows.columns
    with pytest.raises(ValueError):
        prep.choose_target(df, "other")


def test_class_weights_shuffle_no_class(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = prep.class_weights(spark.range(40).select("id", (F.col("id") % 4 == 0).cast("int").alias("label")), "label")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {(r["label"], round(r["weight"], 9)) for r in out.collect()} == {(0, round(40 / 60, 9)), (1, 2.0)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_silhouette_sends_rows_to_few_blocks(spark, monkeypatch):
    """Blocks grow with the table, and a block's distances are taken in chunks."""
    asked = []
    monkeypatch.setattr(CL, "block_pairs", lambda *a: asked.append(a[-1]) or block_pairs(*a))
    monkeypatch.setattr(CL, "CHUNK_ROWS", 7)
    monkeypatch.setattr(CL, "BLOCK_ROWS", 10)
    rows = spark.range(400).select("id", F.array(F.col("id") % 17 / 3, F.col("id") % 5 + 0.0).alias("x"), (F.col("id") % 3).alias("c"))
    wide = CL.silhouette_exact(rows, "id", "x", "c").first()[0]
    assert asked == [25] and wide == pytest.approx(CL.silhouette_exact(rows, "id", "x", "c", 400).first()[0], abs=1e-12)
