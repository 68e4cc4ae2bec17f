"""Cross-validated search over candidates, leaderboards, importances."""

from __future__ import annotations

import math
import statistics
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from pitwall.evaluation.classification import macro_from_counts
from pitwall.evaluation.regression import regression_metrics
from pitwall.models import gram, wide
from pitwall.models.dictionary import Encoder, slot_names, sparse_parts
from pitwall.models.estimators import Candidate, Facts
from pitwall.models.prep import class_weights, fit_preprocessor
from pitwall.models.smote import smote
from pitwall.operators.scan import hash_rank
from pitwall.session import materialise, remove_written

Split = tuple[DataFrame, DataFrame]
CLS_METRICS = ("accuracy", "precision_macro", "recall_macro", "f1_macro")
REG_METRICS = ("rmse", "mae", "r2")
#: Rows that a task of a linear fit takes at least.
STEP_ROWS = 50_000


def stratified_splits(df: DataFrame, fold: str = "fold", k: int = 5) -> list[Split]:
    return [(df.where(F.col(fold) != i).drop(fold), df.where(F.col(fold) == i).drop(fold)) for i in range(k)]


def race_splits(df: DataFrame, folds: DataFrame, k: int = 5) -> list[Split]:
    """Splits from a (raceId, fold, role) table."""

    def part(i: int, role: str) -> DataFrame:
        chosen = folds.where((F.col("fold") == i) & (F.col("role") == role)).select("raceId")
        return df.join(chosen, "raceId", "left_semi")

    return [(part(i, "train"), part(i, "valid")) for i in range(k)]


# ------------------------------------------------------------ scores

def _with_place(frames: Mapping[tuple, DataFrame]) -> DataFrame:
    """All predictions as one table; ``place`` is the number of the frame they come from."""
    out = None
    for i, df in enumerate(frames.values()):
        part = df.select(F.lit(i).alias("place"), F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"))
        out = part if out is None else out.unionByName(part)
    return out


def score_classes(frames: Mapping[tuple, DataFrame]) -> dict[tuple, dict[str, float]]:
    """Class metrics of many predictions from one aggregate over all of them."""
    counts = _with_place(frames).groupBy("place", "label", "prediction").count().collect()  # frames x classes squared rows
    tables: dict[int, dict] = {}
    for r in counts:
        tables.setdefault(r["place"], {})[(r["label"], r["prediction"])] = r["count"]
    return {key: macro_from_counts(tables.get(i, {})) for i, key in enumerate(frames)}


def score_numbers(frames: Mapping[tuple, DataFrame]) -> dict[tuple, dict[str, float]]:
    """Regression metrics of many predictions from one aggregate over all of them."""
    rows = regression_metrics(_with_place(frames), "label", "prediction", by=["place"]).collect()
    found = {r["place"]: {m: r[m] for m in REG_METRICS} for r in rows}
    return {key: found.get(i, dict.fromkeys(REG_METRICS)) for i, key in enumerate(frames)}


# ------------------------------------------------------------ one prepared split

class Prepared:
    """Rows of a split as (id, features, label, weight): fitted on train, written for all grid points."""

    def __init__(self, train: DataFrame, valid: DataFrame, candidate: Candidate, *, categories, numbers,
                 min_frequency: int, use_smote: bool, smote_k: int, seed: int, classify: bool):
        self.pre = fit_preprocessor(train, categories, numbers, kind=candidate.kind, min_frequency=min_frequency)

        def ready(df: DataFrame) -> DataFrame:
            return self.pre.stages[0].written(df.withColumn("label", F.col("label").cast("double")), "id", "label")

        self.train, self.valid = ready(train), ready(valid)
        fit = self.train
        if use_smote and candidate.smote:
            dense = fit.select("id", vector_to_array("features").alias("x"), "label")
            made = smote(dense, id_col="id", features="x", label="label", k=smote_k, seed=seed)
            fit = made.select("id", array_to_vector("x").alias("features"), "label").persist(StorageLevel.MEMORY_AND_DISK)
        self.made = fit
        if candidate.weighted and classify:
            fit = class_weights(fit, "label")
        self.fit = fit
        facts = self.fit.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("label").alias("s")).first()
        self.facts = Facts(facts["n"], facts["s"] or 1.0)

    def model(self, candidate: Candidate, params: Mapping, seed: int):
        if candidate.gram and not self.by_gram:
            linear = self._wide(params)
            if linear is not None:
                return linear
        estimator = candidate.build(params, self.facts, seed)
        if candidate.weighted and "weight" in self.fit.columns and hasattr(estimator, "setWeightCol"):
            estimator = estimator.setWeightCol("weight")
        # each step of a linear fit is a job: few rows take few tasks
        linear = isinstance(estimator, (LinearSVC, LogisticRegression))
        return estimator.fit(self.fit.coalesce(math.ceil(self.facts.n / STEP_ROWS) or 1) if linear else self.fit)

    @property
    def by_gram(self) -> bool:
        """Few enough slots for the normal equations of Spark's own estimator."""
        return self.pre.stages[0].size <= gram.MAX_SLOTS

    def _wide(self, params: Mapping) -> gram.LinearFit | None:
        """The exact fit where most slots are those of one category or two nested ones, else None."""
        encoder, f = self.pre.stages[0], sparse_parts("features")
        rows = self.fit.select(F.lit(0).alias("fold"), F.lit(0).alias("side"), "label", f["indices"].alias("indices"), f["values"].alias("values"))
        if not wide.solvable(rows, [encoder]):
            return None
        found = wide.fit_grid(rows, [encoder], [params]).first()
        return gram.LinearFit(found["coefficients"], found["intercept"])

    def release(self) -> None:
        self.made.unpersist()


# ------------------------------------------------------------ search

def grid_search(splits: Sequence[Split], candidate: Candidate, *, score: Callable[[Mapping], dict],
                refit: str, parallel: int = 4, seed: int = 42, **prep) -> list[dict]:
    """Mean and deviation of every metric on train and validation for each grid point.

    Preparation is fitted once per split, and the predictions of all its points on
    both sides are scored together; up to ``parallel`` splits are worked on at a time.
    """

    def run(split: Split) -> list[tuple[dict, dict]]:
        ready = Prepared(*split, candidate, seed=seed, **prep)
        try:
            frames = {}
            for i, params in enumerate(candidate.grid):
                model = ready.model(candidate, params, seed)
                frames[i, "train"], frames[i, "valid"] = model.transform(ready.train), model.transform(ready.valid)
            found = score(frames)
            return [(found[i, "train"], found[i, "valid"]) for i in range(len(candidate.grid))]
        finally:
            ready.release()

    with ThreadPoolExecutor(parallel) as pool:
        per_split = list(pool.map(run, splits))
    return _summary(candidate, [[results[i] for results in per_split] for i in range(len(candidate.grid))], refit)


def gram_search(splits: Sequence[Split], candidates: Sequence[Candidate], *, refit: str = "r2", categories, numbers,
                min_frequency: int = 1, parallel: int = 4) -> dict[str, list[dict]] | None:
    """``grid_search`` of linear candidates, all their points from the Gram matrices of the
    folds, or from those of their cores where a fold has many slots; None if neither is possible."""
    def fitted(split: Split) -> Encoder:
        return fit_preprocessor(split[0], categories, numbers, min_frequency=min_frequency).stages[0]

    with ThreadPoolExecutor(parallel) as pool:
        encoders = list(pool.map(fitted, splits))
    points = [p for c in candidates for p in c.grid]
    large = {i: e for i, e in enumerate(encoders) if e.size > gram.MAX_SLOTS}
    if any(wide.layout(e)[1] > wide.MAX_CORE or len(wide.layout(e)[0]) > 2 for e in large.values()):
        return None

    def scored_fold(i: int) -> list[tuple[dict, dict]] | None:
        own, encoder = [splits[i]], [encoders[i]]
        rows = gram.encode(own, encoder)
        try:
            if i in large and not wide.solvable(rows, encoder):
                return None
            fits = (wide if i in large else gram).fit_grid(rows, encoder, points)
            return [sides[0] for sides in gram.score_grid(rows, fits, encoder, points)]
        finally:
            remove_written(rows)

    # the encoded rows of two folds are held at a time: those of all would be several times the table
    with ThreadPoolExecutor(min(2, parallel)) as pool:
        per_fold = list(pool.map(scored_fold, range(len(splits))))
    if any(f is None for f in per_fold):
        return None
    scored = [[f[p] for f in per_fold] for p in range(len(points))]
    out, at = {}, 0
    for c in candidates:
        out[c.name] = _summary(c, scored[at:at + len(c.grid)], refit)
        at += len(c.grid)
    return out


def _summary(candidate: Candidate, scored: Sequence[Sequence[tuple[dict, dict]]], refit: str) -> list[dict]:
    """Mean and deviation over the splits of each point's (train, validation) metrics, best first."""
    out = []
    for i, pairs in enumerate(scored):
        row = {"model": candidate.name, "params": dict(candidate.grid[i])}
        for m in pairs[0][0]:
            valid = [v[m] for _, v in pairs]
            row[f"cv_{m}_mean"], row[f"cv_{m}_std"] = statistics.fmean(valid), statistics.pstdev(valid)
            row[f"train_{m}_mean"] = statistics.fmean(t[m] for t, _ in pairs)
        out.append(row)
    return sorted(out, key=lambda r: -r[f"cv_{refit}_mean"])


def tournament(train: DataFrame, test: DataFrame, splits: Sequence[Split], candidates: Sequence[Candidate], *,
               categories: Sequence[str], numbers: Sequence[str], classify: bool, min_frequency: int = 1,
               use_smote: bool = False, smote_k: int = 5, seed: int = 42, parallel: int = 4) -> tuple[DataFrame, dict]:
    """Search every candidate, refit its best point on all training rows, score the test rows.

    Returns the table (one row per model) and the winner: name, fitted model (a
    ``PipelineModel``, or the preparation and neighbour search), predictions.
    """
    metrics, refit = (CLS_METRICS, "f1_macro") if classify else (REG_METRICS, "r2")
    score = score_classes if classify else score_numbers
    prep = dict(categories=categories, numbers=numbers, min_frequency=min_frequency, use_smote=use_smote and classify,
                smote_k=smote_k, classify=classify)
    linear = [c for c in candidates if c.gram]
    searched = gram_search(splits, linear, refit=refit, categories=categories, numbers=numbers,
                           min_frequency=min_frequency, parallel=parallel) if linear else None
    rows, best = [], None
    for candidate in candidates:
        if searched and candidate.gram:
            top = searched[candidate.name][0]
        else:
            top = grid_search(splits, candidate, score=score, refit=refit, parallel=parallel, seed=seed, **prep)[0]
        final = Prepared(train, test, candidate, seed=seed, **prep)
        model = final.model(candidate, top["params"], seed)
        on_test = score({"test": model.transform(final.valid)})["test"]
        row = {"model": candidate.name, "use_smote": bool(prep["use_smote"] and candidate.smote),
               "best_params": str(top["params"]),
               **{k: top[k] for m in metrics for k in (f"cv_{m}_mean", f"cv_{m}_std")},
               f"train_{refit}_mean": top[f"train_{refit}_mean"], **{f"test_{m}": on_test[m] for m in metrics}}
        rows.append(row)
        if best is None or row[f"cv_{refit}_mean"] > best["cv"]:
            whole = PipelineModel(stages=[final.pre, model]) if hasattr(model, "uid") else None
            best = {"name": candidate.name, "cv": row[f"cv_{refit}_mean"], "pre": final.pre, "model": model, "pipeline": whole}
        final.release()
    spark = train.sparkSession
    schema = ", ".join(
        f"{k} {'boolean' if isinstance(v, bool) else 'string' if isinstance(v, str) else 'double'}" for k, v in rows[0].items())
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema), best


def leaderboard(table: DataFrame, order_by: str, fallback: str, gap: tuple[str, str] | None = None) -> DataFrame:
    """Models by a metric (the fallback when the table lacks it), best first, with
    the gap between training and validation as a sign of overfitting."""
    metric = order_by if order_by in table.columns else fallback
    if gap:
        table = table.withColumn("generalization_gap_f1", F.col(gap[0]) - F.col(gap[1]))
    # one row per model
    place = Window.orderBy(F.col(metric).desc(), "model")
    return table.withColumn("place", F.row_number().over(place).cast("bigint"))


# ------------------------------------------------------------ importances

def feature_importance(model, prepared: DataFrame, top_k: int = 30, residual: bool = False) -> DataFrame:
    """(feature, importance, method): absolute coefficients or tree importances of a fitted model.

    Slots get their names from the dictionary; only those of the top are looked up.
    """
    if hasattr(model, "coefficients"):
        values, method = [abs(float(v)) for v in model.coefficients.toArray()], "abs(coef_)"
    elif hasattr(model, "featureImportances"):
        values, method = [float(v) for v in model.featureImportances.toArray()], "feature_importances_"
    else:
        values, method = [], "none"
    facts = prepared.schema["features"].metadata.get("slots", {"size": -1})
    if values and facts["size"] != len(values):
        raise ValueError(f"{len(values)} importances for {facts['size']} feature slots: not the model's own rows")
    spark = prepared.sparkSession
    slots = sorted(range(len(values)), key=lambda i: (-values[i], i))[:top_k]
    names = slot_names(spark, facts, slots) if slots else {}
    top = sorted(((names[i], values[i]) for i in slots), key=lambda p: (-p[1], p[0]))
    return spark.createDataFrame(
        [(n, v, method, residual) for n, v in top],
        "feature string, importance double, method string, use_residual_target boolean")


def permutation_importance(predict: Callable[[DataFrame], DataFrame], df: DataFrame, features: Sequence[str], *,
                           ids: Sequence[str], repeats: int = 10, seed: int = 42) -> DataFrame:
    """(feature, importance_mean, importance_std): drop of macro-F1 when a column is shuffled.

    A repeat pairs each row with the row of the same place in another hash order
    and takes the shuffled column from there.  All copies are scored in one pass.
    ``df`` has ``label``; ``predict`` adds ``prediction``.
    """
    base = score_classes({"base": predict(df)})["base"]["f1_macro"]
    copies = None
    for r in range(repeats):
        here = hash_rank(df, ids, name="__place", seed=seed)
        there = hash_rank(df.select(*ids, *features), ids, name="__place", seed=seed + 1 + r)
        donors = there.select("__place", *[F.col(f).alias(f"__d_{f}") for f in features])
        part = here.join(donors, "__place").withColumn("__repeat", F.lit(r))
        copies = part if copies is None else copies.unionByName(part)
    tagged = copies.withColumn("__feature", F.explode(F.array(*[F.lit(f) for f in features])))
    shuffled = tagged.withColumns({
        f: F.when(F.col("__feature") == f, F.col(f"__d_{f}")).otherwise(F.col(f)) for f in features})
    counts = predict(shuffled).groupBy("__feature", "__repeat", F.col("label").cast("double").alias("a"),
                                       F.col("prediction").cast("double").alias("b")).count().collect()
    tables: dict[tuple, dict] = {}
    for c in counts:  # features x repeats x classes squared rows
        tables.setdefault((c["__feature"], c["__repeat"]), {})[(c["a"], c["b"])] = c["count"]
    return _drops(df.sparkSession, base, tables, features, repeats)


def _drops(spark, base: float, tables: Mapping[tuple, dict], features: Sequence[str], repeats: int) -> DataFrame:
    drops = {f: [base - macro_from_counts(tables[(f, r)])["f1_macro"] for r in range(repeats)] for f in features}
    rows = sorted(((f, statistics.fmean(d), statistics.pstdev(d)) for f, d in drops.items()), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame(rows, "feature string, importance_mean double, importance_std double")


def _shares(model, facts: Mapping, features: Sequence[str]):
    """What each feature adds to a row's margin, from the parts of its vector."""
    weights = model.coefficients.toArray()
    first = facts["size"] - len(facts["numbers"])
    place = np.full(facts["size"], -1)
    for c in facts["categories"]:
        if c["name"] in features:
            place[c["offset"]:c["offset"] + c["slots"]] = features.index(c["name"])
    for i, n in enumerate(facts["numbers"]):
        if n in features:
            place[first + i] = features.index(n)
    place[place < 0] = len(features)  # columns that are not shuffled

    @F.arrow_udf("array<double>")
    def shares(indices: pa.Array, values: pa.Array) -> pa.Array:
        index = indices.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(indices)), np.diff(indices.offsets.to_numpy()))
        out = np.zeros((len(indices), len(features) + 1))
        np.add.at(out, (row, place[index]), weights[index] * values.flatten().to_numpy(zero_copy_only=False))
        ends = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel(), pa.float64()))

    return shares


def linear_permutation_importance(model, df: DataFrame, features: Sequence[str], *, ids: Sequence[str],
                                  repeats: int = 10, seed: int = 42) -> DataFrame:
    """``permutation_importance`` of a binary linear classifier on encoded rows (``Encoder.written``).

    Each feature adds its own share to the margin, so a shuffled column exchanges one share: rows
    are encoded once and paired once a repeat, not copied and scored for every feature.
    """
    features = list(features)
    f = sparse_parts("features")
    shares = _shares(model, df.schema["features"].metadata["slots"], features)
    mine = df.select(*ids, F.col("label").cast("double").alias("label"), shares(f["indices"], f["values"]).alias("share"))
    mine = materialise(mine.withColumn("margin", F.lit(float(model.intercept)) + F.aggregate("share", F.lit(0.0), lambda s, x: s + x)))
    here = materialise(hash_rank(mine, ids, name="__place", seed=seed))
    copies = None
    for r in range(repeats):
        there = hash_rank(mine.select(*ids, F.col("share").alias("other")), ids, name="__place", seed=seed + 1 + r)
        part = here.join(there.select("__place", "other"), "__place").withColumn("__repeat", F.lit(r))
        copies = part if copies is None else copies.unionByName(part)
    ones = [F.count_if(F.col("margin") - F.col("share")[i] + F.col("other")[i] > 0).alias(f"n{i}") for i in range(len(features))]
    counts = copies.groupBy("__repeat", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("margin") > 0).alias("base"), *ones).collect()
    tables: dict[tuple, dict] = {}
    for c in counts:  # repeats x classes rows
        for i, name in enumerate(features):
            tables.setdefault((name, c["__repeat"]), {}).update(_binary(c["label"], c["n"], c[f"n{i}"]))
    base: dict = {}
    for c in counts:
        base.update(_binary(c["label"], c["n"], c["base"]))
    return _drops(df.sparkSession, macro_from_counts(base)["f1_macro"], tables, features, repeats)


def _binary(label: float, n: int, ones: int) -> dict[tuple, int]:
    """Counts by (label, prediction) without the empty ones."""
    return {(label, p): k for p, k in ((0.0, n - ones), (1.0, ones)) if k}
