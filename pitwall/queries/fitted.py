"""Model fitting, search and the tables around fitted models (checked by rows)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.evaluation import classification as E
from pitwall.evaluation import regression as RG
from pitwall.evaluation import tournament as T
from pitwall.models import estimators as M
from pitwall.models import gram, prep, wide
from pitwall.models.clustering import points_2d
from pitwall.models.dictionary import sparse_parts
from pitwall.models.smote import new_rows, smote
from pitwall.operators import sampling as G
from pitwall.operators.quantiles import scalar_of
from pitwall.plans import features as P
from pitwall.queries import query
from pitwall.queries import roles as R
from pitwall.queries.basic import integrated
from pitwall.queries.histories import _CLS as _CLS_SQL
from pitwall.queries.histories import _REG_SQL, cls_input, reg_input
from pitwall.session import materialise, shared_folder

IDS = ["raceId", "driverId"]
_kept = R.kept


def _with_id(df: DataFrame) -> DataFrame:
    # one number for both: races up to 2^32, drivers up to 2^31; beyond that the job fails instead of mixing rows
    fits = (F.col("driverId") >= 0) & (F.col("driverId") < 1 << 31) & (F.abs("raceId") < 1 << 32)
    number = F.shiftleft(F.col("raceId").cast("bigint"), 31) + F.col("driverId")
    return df.withColumn("id", F.when(fits, number).otherwise(F.raise_error(F.lit("raceId or driverId beyond the range of row ids")).cast("bigint")))


def cls_table(spark, sf) -> DataFrame:
    return _kept(spark, sf, "cls", lambda *a: _with_id(cls_input(*a))).withColumnRenamed("target_cls", "label")


def reg_table(spark, sf) -> DataFrame:
    return _kept(spark, sf, "reg", lambda *a: _with_id(reg_input(*a)))


def _sides(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split.where(F.col("split") == "train").drop("split"), split.where(F.col("split") == "test").drop("split")


def cls_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    return _sides(_kept(spark, sf, "cls_split", lambda *a: G.split_stratified(cls_table(*a), IDS, "label")))


def reg_sides(spark, sf, mode: str = "pace") -> tuple[DataFrame, DataFrame, bool]:
    rows, residual = prep.choose_target(reg_table(spark, sf), mode)
    return *_sides(G.split_time(rows.withColumn("label", F.col("y")), IDS, 1999)), residual


_CLS = dict(categories=prep.CLS_CATEGORIES, numbers=prep.CLS_NUMBERS, min_frequency=10, use_smote=False, smote_k=5, classify=True)
_REG = dict(categories=prep.REG_CATEGORIES, numbers=prep.REG_NUMBERS, min_frequency=1, use_smote=False, smote_k=5, classify=False)


def _candidate(pool, name: str) -> M.Candidate:
    return next(c for c in pool if c.name == name)


def _fit_cls(spark, sf, name: str, params: dict | None = None, weighted: bool | None = None):
    train, test = cls_sides(spark, sf)
    candidate = _candidate(M.classifiers(), name)
    if weighted is not None:
        candidate = M.Candidate(candidate.name, candidate.grid, candidate.build, candidate.kind, weighted, candidate.smote)
    ready = T.Prepared(train, test, candidate, seed=42, **_CLS)
    model = ready.model(candidate, params or candidate.grid[-1], 42)
    return ready, model


def _cls_query(key: str, name: str, params: dict | None = None):
    @query(key)
    def run(spark, sf):
        ready, model = _fit_cls(spark, sf, name, params)
        facts = materialise(E.macro_metrics(model.transform(ready.valid)).withColumn("model", F.lit(name)))
        ready.release()
        return facts

    return run


_cls_query("model_logreg", "logreg")
_cls_query("model_linear_svc", "linear_svc")
_cls_query("model_rf_cls", "rf", _candidate(M.classifiers(full=True), "rf").grid[0])  # 300 trees, a point of the whole grid
_cls_query("model_gbt_cls", "gbt")


def _fit_reg(spark, sf, name: str, mode: str = "pace"):
    train, test, residual = reg_sides(spark, sf, mode)
    candidate = _candidate(M.regressors(), name)
    ready = T.Prepared(train, test, candidate, seed=42, **_REG)
    return ready, ready.model(candidate, candidate.grid[-1], 42), train, test, residual


def _reg_query(key: str, name: str):
    @query(key)
    def run(spark, sf):
        ready, model, *_ = _fit_reg(spark, sf, name)
        facts = materialise(RG.regression_metrics(model.transform(ready.valid), "label", "prediction").withColumn("model", F.lit(name)))
        ready.release()
        return facts

    return run


def _reg_grid(spark, sf, name: str):
    """All points of a linear candidate on the hold-out: fits, and metrics per point."""
    train, test, _ = reg_sides(spark, sf)
    encoder = prep.fit_preprocessor(train, prep.REG_CATEGORIES, prep.REG_NUMBERS).stages[0]
    points = _candidate(M.regressors(), name).grid
    rows = gram.encode([(train, test)], [encoder])
    fits = gram.fit_grid(rows, [encoder], points) if encoder.size <= gram.MAX_SLOTS else wide.fit_grid(rows, [encoder], points)
    return fits, points, gram.score_grid(rows, fits, [encoder], points)


def _grid_query(key: str, name: str):
    @query(key)
    def run(spark, sf):
        _, points, scores = _reg_grid(spark, sf, name)
        rows = [(name, float(p["alpha"]), float(p.get("l1_ratio", 0.0)), *(sides[0][1][m] for m in T.REG_METRICS)) for p, sides in zip(points, scores)]
        return spark.createDataFrame(rows, "model string, alpha double, l1_ratio double, rmse double, mae double, r2 double")

    return run


_grid_query("model_ridge", "ridge")
_grid_query("model_elasticnet", "elasticnet")

#: Rows on each side of ``reg_sides``; both are large enough for a split by time from sf0.01 on.
_REG_SIDES_SQL = f"SELECT count(*) FILTER (year <= 1999) AS a, count(*) FILTER (year > 1999) AS b, count(*) AS n FROM ({_REG_SQL}) WHERE target_reg IS NOT NULL"
_N_TRAIN = f"(SELECT CASE WHEN a >= 200 AND b >= 200 THEN a ELSE n - CAST(ceil(n * 0.2::DOUBLE) AS BIGINT) END FROM ({_REG_SIDES_SQL}))"


def _optimal(spark, sf, name: str):
    """Every fit of a grid: rows it saw, and whether it meets its optimality conditions to a millionth."""
    fits, points, _ = _reg_grid(spark, sf, name)
    known = spark.createDataFrame([(i, float(p["alpha"]), float(p.get("l1_ratio", 0.0))) for i, p in enumerate(points)], "point int, alpha double, l1_ratio double")
    return fits.join(known, "point").select("alpha", "l1_ratio", F.col("n").alias("n_train"), (F.col("violation") < 1e-6).alias("optimal"))


@query("model_ridge_optimal", f"""SELECT unnest([{", ".join(f"{a}::DOUBLE" for a in M.ALPHAS)}]) AS alpha, 0.0::DOUBLE AS l1_ratio, {_N_TRAIN} AS n_train, true AS optimal""")
def model_ridge_optimal(spark, sf):
    return _optimal(spark, sf, "ridge")


@query("model_elasticnet_optimal", f"""SELECT alpha, l1_ratio, {_N_TRAIN} AS n_train, true AS optimal FROM
  (SELECT unnest([{", ".join(f"{a}::DOUBLE" for a in M.NET_ALPHAS)}]) AS alpha), (SELECT unnest([{", ".join(f"{a}::DOUBLE" for a in M.NET_RATIOS)}]) AS l1_ratio)""")
def model_elasticnet_optimal(spark, sf):
    return _optimal(spark, sf, "elasticnet")


@query("prep_gram_folds", R.with_ctes(R.DATED) + """, long AS (SELECT raceId, driverId, raceId % 3 AS fold, unnest([
    {'name': 'constructorId=' || constructorId, 'x': 1.0::DOUBLE}, {'name': 'grid', 'x': coalesce(CAST(grid AS DOUBLE), 0)},
    {'name': 'laps', 'x': coalesce(CAST(laps AS DOUBLE), 0)}, {'name': 'rows', 'x': 1}, {'name': 'label', 'x': CAST(points AS DOUBLE)}], recursive := true) FROM dated)
SELECT CAST(a.fold AS INT) AS fold, a.name AS a, b.name AS b, round(sum(a.x * b.x), 6) AS s FROM long a JOIN long b USING (raceId, driverId) GROUP BY ALL HAVING round(sum(a.x * b.x), 6) <> 0""")
def prep_gram_folds(spark, sf):
    """X'X, X'1 and X'y per fold, by the names of the slots."""
    rows = R.dated(spark, sf).select("raceId", "driverId", "constructorId", F.coalesce(F.col("grid").cast("double"), F.lit(0.0)).alias("grid"),
                                     F.coalesce(F.col("laps").cast("double"), F.lit(0.0)).alias("laps"), F.col("points").cast("double").alias("label"))
    rows = materialise(rows.withColumn("fold", (F.col("raceId") % 3).cast("int")))
    encoder = prep.fit_preprocessor(rows, ["constructorId"], ["grid", "laps"], kind="tree").stages[0]
    sums = gram.gram(encoder.parts(rows, "indices", "values"), {f: (encoder.size, 2, 0.0) for f in range(3)})
    names = encoder.table(spark).select(F.col("slot").cast("int").alias("i"), F.concat(F.lit("constructorId="), "value").alias("name")).unionByName(
        spark.createDataFrame([(encoder.size - 2 + i, n) for i, n in enumerate(("grid", "laps", "rows", "label"))], "i int, name string"))
    long = sums.select("fold", "i", F.posexplode("s").alias("j", "s")).where(F.round("s", 6) != 0)
    return (long.join(names.select("i", F.col("name").alias("a")), "i").join(names.select(F.col("i").alias("j"), F.col("name").alias("b")), "j")
            .select("fold", "a", "b", F.round("s", 6).alias("s")))


_reg_query("model_rf_reg", "rf")
_reg_query("model_gbt_reg", "gbt")


@query("model_baseline")
def model_baseline(spark, sf):
    """The two plain models on the primary table: podium by logistic regression,
    finishing position by a random forest."""
    rows = P.add_base_features(integrated(spark, sf, R.written_cars(spark, sf))).select("raceId", "driverId", *P.PRIMARY_FEATURES, "is_podium", "positionOrder").dropna()
    rows = materialise(rows)
    pre = prep.fit_preprocessor(rows, [], P.PRIMARY_FEATURES, kind="linear")
    cls = G.split_stratified(rows.withColumn("label", F.col("is_podium")), IDS, "label")
    reg = G.split_random(rows.withColumn("label", F.col("positionOrder")), IDS)
    train = pre.transform(cls.where(F.col("split") == "train"))
    logit = M.logistic({"C": 1.0, "max_iter": 1000}, M.Facts(train.count()), 42).fit(train)
    accuracy = E.macro_metrics(logit.transform(pre.transform(cls.where(F.col("split") == "test"))))
    forest = M.forest_regressor({"n_estimators": 50, "max_depth": 8}, M.Facts(1), 42).fit(pre.transform(reg.where(F.col("split") == "train")))
    position = RG.regression_metrics(forest.transform(pre.transform(reg.where(F.col("split") == "test"))), "label", "prediction")
    return accuracy.select("accuracy", scalar_of(position.select("mae", "rmse", "r2")).alias("p")).select("accuracy", "p.*")


@query("model_store", _CLS_SQL + """, t AS (SELECT CAST(sum(n) AS BIGINT) AS n FROM (SELECT round(count(*) * 0.2::DOUBLE) AS n FROM cls GROUP BY target_cls))
SELECT n AS n_rows, n AS n_same FROM t""")
def model_store(spark, sf):
    """Save and load a whole pipeline; the loaded one predicts the same."""
    train, test = cls_sides(spark, sf)
    pre = prep.fit_preprocessor(train, prep.CLS_CATEGORIES, prep.CLS_NUMBERS, min_frequency=10)
    model = M.logistic({"C": 1.0}, M.Facts(train.count()), 42).fit(pre.stages[0].written(train, "label"))
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    whole = PipelineModel(stages=[*pre.stages, model])
    whole.write().overwrite().save(path)
    a = whole.transform(test).select(*IDS, F.col("prediction").alias("a"))
    b = PipelineModel.load(path).transform(test).select(*IDS, F.col("prediction").alias("b"))
    return a.join(b, IDS).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("a") == F.col("b")).alias("n_same"))


# ------------------------------------------------------------ preparation

#: The hold-out of ``cls_sides`` in SQL.
_CLS_SPLIT = _CLS_SQL + """, split AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY target_cls ORDER BY md5(concat_ws('|', raceId, driverId, '42')), raceId, driverId) - 1
  < round(count(*) OVER (PARTITION BY target_cls) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS side FROM cls)
, train AS (SELECT * FROM split WHERE side = 'train'), test AS (SELECT * FROM split WHERE side = 'test')
"""


#: The candidate numbers that the classification input has.
_CLS_HELD = ["grid", "year", "round", "driver_prev_rate", "driver_prev_count", "constructor_prev_rate", "constructor_prev_count",
             "circuit_prev_rate", "circuit_prev_count"]


def _sql_vocabulary(c: str) -> str:
    return f"SELECT '{c}' AS c, CAST({c} AS VARCHAR) AS v, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY ALL"


def _sql_known(c: str) -> str:
    return f"""(SELECT count(*) FROM vocabulary v WHERE v.c = '{c}' AND v.v = coalesce(CAST(test.{c} AS VARCHAR),
  (SELECT v FROM vocabulary WHERE c = '{c}' ORDER BY n DESC, v LIMIT 1)))"""


@query("prep_assemble", _CLS_SPLIT + f""", vocabulary AS ({" UNION ALL ".join(map(_sql_vocabulary, prep.CLS_CATEGORIES))})
, slots AS (SELECT c, count(*) FILTER (n >= 10) + CAST(bool_or(n < 10) AS INT) AS k FROM vocabulary GROUP BY 1)
SELECT raceId, driverId, CAST((SELECT sum(k) FROM slots) AS BIGINT) + {len(_CLS_HELD)} AS n_slots,
  CAST({" + ".join(map(_sql_known, prep.CLS_CATEGORIES))} AS BIGINT) AS n_ones FROM test""")
def prep_assemble(spark, sf):
    """Size of the assembled vectors, and how many categories of a row have a slot.

    The vectors are read in their sparse parts: a row costs what is set in it, not the slots of all categories.
    """
    train, test = cls_sides(spark, sf)
    pre = prep.fit_preprocessor(train, prep.CLS_CATEGORIES, prep.CLS_NUMBERS, min_frequency=10)
    x = sparse_parts("features")
    ones = F.filter(F.arrays_zip(x["indices"].alias("i"), x["values"].alias("v")), lambda e: (e["i"] < pre.stages[0].size - len(_CLS_HELD)) & (e["v"] == 1))
    return pre.transform(test).select(*IDS, x["size"].cast("long").alias("n_slots"), F.size(ones).cast("long").alias("n_ones"))


def _embedded(spark, sf) -> DataFrame:
    return R.table(spark, sf, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))


def _centred(spark, sf) -> DataFrame:
    rows = _embedded(spark, sf)
    return StandardScaler(inputCol="v", outputCol="scaled", withMean=True, withStd=True).fit(rows).transform(rows)


@query("prep_pca_variance")
def prep_pca_variance(spark, sf):
    model, info = prep.fit_pca(_centred(spark, sf), "scaled", 0.90)
    out = model.transform(_centred(spark, sf)).select("vec_id", F.size(vector_to_array("pca")).alias("n_components"))
    return out.withColumn("explained", F.lit(info["explained_variance_ratio_sum"]))


@query("prep_pca_2d")
def prep_pca_2d(spark, sf):
    rows = _centred(spark, sf)
    model = PCA(k=2, inputCol="scaled", outputCol="pca").fit(rows)
    first, second = model.explainedVariance.toArray()
    return points_2d(model.transform(rows), ["vec_id"], "pca", "label").withColumns(
        {"explained_1": F.lit(float(first)), "explained_2": F.lit(float(second))})


_SMOTE = "WITH f AS (SELECT CASE WHEN label < 3 THEN 1 ELSE 0 END AS label FROM embeddings), s AS (SELECT label, count(*) AS n FROM f GROUP BY 1)\n"


def _two_classes(spark, sf) -> DataFrame:
    return R.table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), F.when(F.col("label") < 3, 1).otherwise(0).alias("label"))


@query("prep_smote", _SMOTE + "SELECT label, false AS synthetic, n FROM s UNION ALL SELECT label, true, (SELECT max(n) FROM s) - n FROM s WHERE n < (SELECT max(n) FROM s)")
def prep_smote(spark, sf):
    made = smote(_two_classes(spark, sf), id_col="vec_id", features="x", label="label", k=5)
    return made.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("prep_smote_between", _SMOTE + "SELECT label, (SELECT max(n) FROM s) - n AS n, (SELECT max(n) FROM s) - n AS n_between FROM s WHERE n < (SELECT max(n) FROM s)")
def prep_smote_between(spark, sf):
    """How many new rows lie on the line between two different rows of their class, by a join with the originals."""
    rows = _two_classes(spark, sf)
    made = new_rows(rows, id_col="vec_id", features="x", label="label", k=5)
    a, b = (rows.select(F.col("vec_id").alias(side), F.col("x").alias(f"x_{side}"), F.col("label").alias(f"l_{side}")) for side in ("source", "neighbor"))
    line = F.zip_with("x_source", "x_neighbor", lambda p, q: p + F.col("gap") * (q - p))
    off = F.array_max(F.zip_with("x", line, lambda p, q: F.abs(p - q)))
    between = ((F.col("l_source") == F.col("label")) & (F.col("l_neighbor") == F.col("label")) & (F.col("source") != F.col("neighbor"))
               & F.col("gap").between(0, 1) & (off < 1e-12))
    return made.join(a, "source").join(b, "neighbor").groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(between).alias("n_between"))


# ------------------------------------------------------------ search and evaluation

@query("eval_grid_cv")
def eval_grid_cv(spark, sf):
    """The whole grids of the two linear candidates over five stratified folds, by macro-F1."""
    train, test = cls_sides(spark, sf)
    train = materialise(G.fold_stratified(train, IDS, "label", 5))
    pool = [_candidate(M.classifiers(full=True), n) for n in ("logreg", "linear_svc")]
    table, _ = T.tournament(train.drop("fold"), test, T.stratified_splits(train, "fold", 5), pool, **_CLS)
    return T.leaderboard(table, "cv_f1_macro_mean", "cv_f1_macro_mean", ("train_f1_macro_mean", "cv_f1_macro_mean"))


@query("eval_fold_counts", _CLS_SPLIT + """, folds AS (SELECT target_cls, (row_number() OVER (PARTITION BY target_cls ORDER BY md5(concat_ws('|', raceId, driverId, '42')), raceId, driverId) - 1) % 5 AS fold FROM train)
SELECT CAST(p AS INT) AS point, CAST(f AS INT) AS fold, (SELECT count(*) FROM folds WHERE fold <> f) AS n_train, (SELECT count(*) FROM folds WHERE fold = f) AS n_valid,
  (SELECT count(*) FROM folds WHERE fold = f AND target_cls = 1) AS n_positive FROM range(1) a(p), range(5) b(f)""")
def eval_fold_counts(spark, sf):
    """What the stacked evaluation of a linear SVC counts in each fold."""
    train, _ = cls_sides(spark, sf)
    train = materialise(G.fold_stratified(train, IDS, "label", 5))
    candidate = _candidate(M.classifiers(), "linear_svc")

    def fitted(split):
        ready = T.Prepared(*split, candidate, seed=42, **_CLS)
        return ready, [ready.model(candidate, params, 42) for params in candidate.grid]

    with ThreadPoolExecutor(4) as pool:  # folds are fitted side by side, as in a search
        done = list(pool.map(fitted, T.stratified_splits(train, "fold", 5)))
    frames = {}
    for f, (ready, models) in enumerate(done):
        for i, model in enumerate(models):
            frames[i, f, "train"], frames[i, f, "valid"] = model.transform(ready.train), model.transform(ready.valid)
    counts = materialise(T._with_place(frames).groupBy("place", "label", "prediction").count())
    for ready, _ in done:
        ready.release()
    places = spark.createDataFrame([(n, *key) for n, key in enumerate(frames)], "place int, point int, fold int, side string")
    n, valid = F.col("count"), F.col("side") == "valid"
    return counts.join(places, "place").groupBy("point", "fold").agg(
        F.sum(F.when(~valid, n)).alias("n_train"), F.sum(F.when(valid, n)).alias("n_valid"),
        F.sum(F.when(valid & (F.col("label") == 1), n)).alias("n_positive"))


@query("eval_grid_cv_time")
def eval_grid_cv_time(spark, sf):
    """The whole grids of ridge and elastic net over expanding time folds of whole races, by R2,
    on a random 85 % of the training races."""
    train, test, _ = reg_sides(spark, sf)
    train = materialise(G.segment_train(train, sample_frac=0.85, min_races=25))
    folds = G.fold_time_series(train, 5)
    pool = [_candidate(M.regressors(), n) for n in ("ridge", "elasticnet")]
    table, _ = T.tournament(train, test, T.race_splits(train, folds, 5), pool, **_REG)
    return table


@query("eval_predictions")
def eval_predictions(spark, sf):
    ready, model, train, test, residual = _fit_reg(spark, sf, "ridge", "residual")
    predicted = model.transform(ready.valid).select("id", "prediction").join(test, "id")
    return RG.prediction_table(RG.reconstruct(predicted, train, residual=residual), residual=residual)


@query("eval_test_metrics")
def eval_test_metrics(spark, sf):
    """Pace and reconstructed race time metrics of one fitted model."""
    table = materialise(eval_predictions(spark, sf))
    pace = RG.regression_metrics(table, "y_true_pace", "y_pred_pace", "_pace")
    total = RG.regression_metrics(table, "true_ms", "pred_ms", "_ms")
    return pace.select("*", scalar_of(total).alias("t")).select(*pace.columns, "t.*")


@query("eval_feature_importance")
def eval_feature_importance(spark, sf):
    ready, model, *_ = _fit_reg(spark, sf, "rf")
    found = materialise(T.feature_importance(model, ready.train, 30))
    ready.release()
    return found


@query("eval_permutation")
def eval_permutation(spark, sf):
    train, test = cls_sides(spark, sf)
    numbers = [c for c in prep.CLS_NUMBERS if c in train.columns]
    pre = prep.fit_preprocessor(train, prep.CLS_CATEGORIES, numbers, min_frequency=10)
    model = M.logistic({"C": 1.0}, M.Facts(train.count()), 42).fit(pre.stages[0].written(train, "label"))
    rows = pre.stages[0].written(test.withColumn("row", F.col("id")), "row", "label")
    return T.linear_permutation_importance(model, rows, [*numbers, *prep.CLS_CATEGORIES], ids=["row"], repeats=10)


@query("eval_roc_of_model")
def eval_roc_of_model(spark, sf):
    """AUC and average precision of a fitted classifier's probabilities."""
    ready, model = _fit_cls(spark, sf, "logreg")
    scored = materialise(model.transform(ready.valid).select("label", vector_to_array("probability")[1].alias("score")))
    ready.release()
    return E.roc_auc(scored, "score", "label").withColumn("ap", E.average_precision(scored, "score", "label").scalar())
