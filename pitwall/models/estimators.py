"""Model candidates: an estimator for each grid point, on Spark's own learners and on those of this package for
many slots (``trees``) and neighbours."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.models.neighbors import knn_classify, knn_regress
from pitwall.models.trees import SparseTrees, Spec

Params = Mapping[str, object]


@dataclass(frozen=True)
class Facts:
    """What penalty scaling needs to know about the training rows."""

    n: int
    target_std: float = 1.0


@dataclass(frozen=True)
class Candidate:
    """A named model: its grid, its preparation and how to build it."""

    name: str
    grid: Sequence[Params]
    build: Callable[[Params, Facts, int], object]
    kind: str = "linear"
    weighted: bool = False
    smote: bool = True
    gram: bool = False  # searched on Gram matrices


def points(**lists) -> list[dict]:
    """All combinations of the listed values."""
    return [dict(zip(lists, values)) for values in product(*lists.values())]


# ------------------------------------------------------------ builders

def logistic(p: Params, f: Facts, seed: int) -> Estimator:
    """C-form penalty: regParam = 1 / (C n), intercept free, columns as they are."""
    return LogisticRegression(maxIter=int(p.get("max_iter", 5000)), regParam=1.0 / (float(p["C"]) * f.n),
                              elasticNetParam=0.0, standardization=False)


def linear_svc(p: Params, f: Facts, seed: int) -> Estimator:
    """C-form penalty; the steps end where the loss does, as in ``logistic``."""
    return LinearSVC(maxIter=int(p.get("max_iter", 5000)), regParam=1.0 / (float(p["C"]) * f.n), standardization=False)


def _tree(p: Params) -> dict:
    depth = p.get("max_depth")
    return {"maxDepth": 30 if depth is None else int(depth), "minInstancesPerNode": int(p.get("min_samples_leaf", 1))}


def _sparse(plain: Estimator, p: Params, seed: int, subset: str, boosted: bool, classify: bool) -> SparseTrees:
    tree = _tree(p)
    return SparseTrees(Spec(int(p["n_estimators"]), tree["maxDepth"], tree["minInstancesPerNode"], subset, boosted, classify, seed,
                            float(p.get("learning_rate", 1.0)), float(p.get("subsample", 1.0))), plain)


def forest_classifier(p: Params, f: Facts, seed: int) -> SparseTrees:
    subset = str(p.get("max_features", "sqrt"))
    return _sparse(RandomForestClassifier(numTrees=int(p["n_estimators"]), seed=seed, featureSubsetStrategy=subset, **_tree(p)),
                   p, seed, subset, False, True)


def boosted_classifier(p: Params, f: Facts, seed: int) -> SparseTrees:
    return _sparse(GBTClassifier(maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]), seed=seed,
                                 subsamplingRate=float(p.get("subsample", 1.0)), **_tree(p)), p, seed, "all", True, True)


def ridge(p: Params, f: Facts, seed: int) -> Estimator:
    """sum of squares + alpha |w|^2; Spark divides the penalty by std(y).

    Up to 4 096 columns this is one pass over the rows (normal equations).
    """
    return LinearRegression(maxIter=500, tol=1e-9, solver="auto", standardization=False, elasticNetParam=0.0,
                            regParam=float(p["alpha"]) * f.target_std / f.n)


def elastic_net(p: Params, f: Facts, seed: int) -> Estimator:
    """Mean squares / 2 + alpha (l1 |w| + (1 - l1) |w|^2 / 2); only the L2 part scales with std(y)."""
    alpha, l1 = float(p["alpha"]), float(p["l1_ratio"])
    total = alpha * (l1 + (1.0 - l1) * f.target_std)
    return LinearRegression(maxIter=500, tol=1e-9, solver="l-bfgs", standardization=False, regParam=total,
                            elasticNetParam=alpha * l1 / total if total else 0.0)


def forest_regressor(p: Params, f: Facts, seed: int) -> SparseTrees:
    subset = str(p.get("max_features", "all"))
    return _sparse(RandomForestRegressor(numTrees=int(p["n_estimators"]), seed=seed, featureSubsetStrategy=subset, **_tree(p)),
                   p, seed, subset, False, False)


def boosted_regressor(p: Params, f: Facts, seed: int) -> SparseTrees:
    return _sparse(GBTRegressor(maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]), seed=seed,
                                subsamplingRate=float(p.get("subsample", 1.0)), **_tree(p)), p, seed, "all", True, False)


# ------------------------------------------------------------ neighbours as an estimator

class Knn:
    """fit / transform around the exact neighbour search; rows need a bigint ``id``."""

    def __init__(self, k: int, weights: str, classify: bool):
        self.k, self.weights, self.classify = k, weights, classify

    def fit(self, train: DataFrame) -> KnnFitted:
        return KnnFitted(self, train.select("id", _as_array(train), "label"))


class KnnFitted:
    def __init__(self, spec: Knn, train: DataFrame):
        self.spec, self.train = spec, train

    def transform(self, rows: DataFrame) -> DataFrame:
        run = knn_classify if self.spec.classify else knn_regress
        found = run(self.train, rows.select("id", _as_array(rows)), self.spec.k, id_col="id", features="x",
                    target="label", weights=self.spec.weights)
        return rows.join(found.withColumnRenamed("query_id", "id"), "id")


def _as_array(df: DataFrame):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col("features")).alias("x")


def knn_classifier(p: Params, f: Facts, seed: int) -> Knn:
    return Knn(int(p["n_neighbors"]), str(p["weights"]), True)


def knn_regressor(p: Params, f: Facts, seed: int) -> Knn:
    return Knn(int(p["n_neighbors"]), str(p["weights"]), False)


# ------------------------------------------------------------ grids
# The full search grids.  The short ones are the default.
ALPHAS = [0.01, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0, 500.0]
NET_ALPHAS = [0.001, 0.005, 0.01, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0]
NET_RATIOS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]

def classifiers(full: bool = False) -> list[Candidate]:
    grids = {
        "gbt": points(n_estimators=[150, 250, 400], learning_rate=[0.03, 0.05, 0.1], max_depth=[2, 3], subsample=[0.8, 1.0]),
        "hist_gbt": points(n_estimators=[200, 400, 800], learning_rate=[0.03, 0.05, 0.1], max_depth=[3, 5, 10],
                           min_samples_leaf=[20, 50, 100]),
        "rf": points(n_estimators=[300, 600], max_depth=[10, 20, None], min_samples_leaf=[1, 2, 5], max_features=["sqrt", "log2"]),
        "logreg": points(C=[0.1, 1.0, 10.0]), "linear_svc": points(C=[0.5, 1.0, 2.0]),
        "knn": points(n_neighbors=[7, 15, 31], weights=["uniform", "distance"]),
    } if full else {
        "gbt": points(n_estimators=[20], learning_rate=[0.1], max_depth=[3]), "hist_gbt": [],
        "rf": points(n_estimators=[30], max_depth=[8], min_samples_leaf=[2]),
        "logreg": points(C=[0.1, 1.0]), "linear_svc": points(C=[1.0]),
        "knn": points(n_neighbors=[15], weights=["uniform"]),
    }
    made = [
        Candidate("hist_gbt", grids["hist_gbt"], boosted_classifier, "tree", smote=False),
        Candidate("gbt", grids["gbt"], boosted_classifier, "tree", smote=False),
        Candidate("rf", grids["rf"], forest_classifier, "tree", weighted=True),
        Candidate("logreg", grids["logreg"], logistic, "linear", weighted=True),
        Candidate("linear_svc", grids["linear_svc"], linear_svc, "linear", weighted=True),
        Candidate("knn", grids["knn"], knn_classifier, "linear"),
    ]
    return [c for c in made if c.grid]


def regressors(full: bool = False) -> list[Candidate]:
    net = points(alpha=NET_ALPHAS, l1_ratio=NET_RATIOS)
    grids = {
        "ridge": points(alpha=ALPHAS), "elasticnet": net,
        "rf": points(n_estimators=[600, 1200], max_depth=[12, 20, None], min_samples_leaf=[1, 2, 5], max_features=["sqrt", "log2"]),
        "gbt": points(n_estimators=[400, 800], learning_rate=[0.03, 0.05, 0.1], max_depth=[2, 3]),
        "hist_gbt": points(n_estimators=[400, 800], learning_rate=[0.03, 0.05, 0.1], max_depth=[6, 10], min_samples_leaf=[20, 50, 100]),
        "knn": points(n_neighbors=[7, 15, 31], weights=["uniform", "distance"]),
    } if full else {
        # whole grids cost no more passes than one point
        "ridge": points(alpha=ALPHAS), "elasticnet": net,
        "rf": points(n_estimators=[30], max_depth=[8], min_samples_leaf=[2], max_features=["sqrt"]),
        "gbt": points(n_estimators=[20], learning_rate=[0.1], max_depth=[3]), "hist_gbt": [],
        "knn": points(n_neighbors=[15], weights=["distance"]),
    }
    made = [
        Candidate("ridge", grids["ridge"], ridge, "linear", gram=True),
        Candidate("elasticnet", grids["elasticnet"], elastic_net, "linear", gram=True),
        Candidate("rf", grids["rf"], forest_regressor, "tree"),
        Candidate("gbt", grids["gbt"], boosted_regressor, "tree"),
        Candidate("hist_gbt", grids["hist_gbt"], boosted_regressor, "tree"),
        Candidate("knn", grids["knn"], knn_regressor, "linear"),
    ]
    return [c for c in made if c.grid]
