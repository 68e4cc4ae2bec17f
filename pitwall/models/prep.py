"""Preparation learned on training rows and applied to any rows.

What is learned is a handful of numbers per column and a dictionary table of the
categories, kept in one encoder stage, so a whole model is one ``PipelineModel``
that can be saved and loaded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.models.dictionary import INFREQUENT, Encoder, category_counts, fit_categories
from pitwall.operators.aggregates import entity_modes
from pitwall.operators.quantiles import grouped_agg

# The candidate input columns of the two model families.
CLS_CATEGORIES = ["driverId", "constructorId", "circuitId"]
CLS_NUMBERS = [
    "grid", "year", "round",
    "driver_prev_rate", "driver_prev_count", "constructor_prev_rate", "constructor_prev_count",
    "circuit_prev_rate", "circuit_prev_count",
    "driver_roll_rate_10", "driver_roll_rate_30", "constructor_roll_rate_10", "constructor_roll_rate_30",
    "driver_log_exp", "constructor_log_exp",
]
REG_CATEGORIES = ["driverId", "constructorId", "circuitId", "country", "driver_constructor"]
REG_NUMBERS = [
    "grid", "year", "round", "laps", "circuit_baseline_pace", "n_drivers_race", "grid_pct_in_race",
    "season_progress", "era_bin", "driver_circuit_prev_count", "driver_circuit_log",
    "season_prev_mean_pace", "season_prev_mean_resid",
    "quali_position", "quali_best_ms", "quali_gap_to_pole_ms", "quali_has_q2", "quali_has_q3", "quali_gap_pct",
    "grid_minus_quali", "quali_zscore_in_race", "quali_rank_pct_in_race",
    "drv_points_prev", "drv_pos_prev", "drv_wins_prev", "cons_points_prev", "cons_pos_prev", "cons_wins_prev",
    "drv_points_per_round_prev", "drv_wins_per_round_prev", "cons_points_per_round_prev", "cons_wins_per_round_prev",
    "drv_quali_roll_mean_5", "drv_quali_roll_mean_10", "cons_quali_roll_mean_5", "cons_quali_roll_mean_10",
    "cir_quali_roll_mean_5", "cir_quali_roll_mean_10",
    "driver_prev_pace_mean", "driver_prev_pace_count", "driver_pace_roll_mean_5", "driver_pace_roll_mean_10",
    "driver_pace_roll_mean_30", "driver_log_exp", "driver_prev_resid_mean", "driver_prev_resid_std",
    "driver_resid_roll_mean_10", "driver_resid_roll_std_10",
    "constructor_prev_pace_mean", "constructor_prev_pace_count", "constructor_pace_roll_mean_5", "constructor_pace_roll_mean_10",
    "constructor_pace_roll_mean_30", "constructor_log_exp", "constructor_prev_resid_mean", "constructor_prev_resid_std",
    "constructor_resid_roll_mean_10", "constructor_resid_roll_std_10",
    "circuit_prev_pace_mean", "circuit_prev_pace_count", "circuit_pace_roll_mean_5", "circuit_pace_roll_mean_10",
    "circuit_pace_roll_mean_30", "circuit_log_exp", "circuit_prev_resid_mean", "circuit_prev_resid_std",
    "circuit_resid_roll_mean_10", "circuit_resid_roll_std_10",
    "lat", "lng", "alt",
]


# Rows up to which the values of a column go to one task for its median.
COLUMN_ROWS = 100_000


@dataclass(frozen=True)
class Learned:
    """Numbers learned per column: fill value, and centre and scale after filling."""

    fill: Mapping[str, float]
    mean: Mapping[str, float]
    std: Mapping[str, float]


def learn_numbers(train: DataFrame, columns: Sequence[str]) -> Learned:
    """Exact medians, then mean and population deviation of the filled columns.

    The columns are groups of the medians, so their sketches and value tables are dealt over the
    tasks; in one row they would all be merged by one.
    """
    typed = train.select(*[F.col(c).cast("double").alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).alias("value")) for i, c in enumerate(columns)])
    values = typed.select(F.explode(entries).alias("e")).select("e.*").where(F.col("value").isNotNull())
    n = train.count()
    found = grouped_agg(values, ["column"], [], {"m": ("value", 0.5)}, max_rows=COLUMN_ROWS, sizes={"": n * len(columns), "column": n})
    medians = {columns[r["column"]]: r["m"] for r in found.collect()}  # one row a column
    fill = {c: medians.get(c, 0.0) for c in columns}
    filled = {c: F.coalesce(F.col(c), F.lit(fill[c])) for c in columns}
    facts = typed.agg(*[F.avg(x).alias(f"m_{c}") for c, x in filled.items()],
                      *[F.stddev_pop(x).alias(f"s_{c}") for c, x in filled.items()]).first()
    return Learned(fill, {c: facts[f"m_{c}"] or 0.0 for c in columns},
                   {c: facts[f"s_{c}"] or 1.0 for c in columns})  # a constant column is left at 0


def learn_modes(train: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest on ties."""
    parts = None
    for c in columns:
        mode = entity_modes(train.select(F.col(c).cast("string").alias(c)), [], c, "m").select(F.lit(c).alias("c"), "m")
        parts = mode if parts is None else parts.unionByName(mode)
    found = {r["c"]: r["m"] for r in parts.collect()}  # one row per column
    return {c: found.get(c) or "" for c in columns}


def impute(df: DataFrame, numbers: Learned, modes: Mapping[str, str]) -> DataFrame:
    return df.withColumns({
        **{c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in numbers.fill.items()},
        **{c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in modes.items()}})


def scale(df: DataFrame, numbers: Learned) -> DataFrame:
    """Standardise with the training mean and population deviation."""
    return df.withColumns({c: (F.coalesce(F.col(c).cast("double"), F.lit(numbers.fill[c])) - F.lit(numbers.mean[c]))
                           / F.lit(numbers.std[c]) for c in numbers.fill})


def onehot_long(train: DataFrame, df: DataFrame, ids: Sequence[str], columns: Sequence[str],
                min_frequency: int = 10) -> DataFrame:
    """The ones of a one-hot matrix as (ids, column, category) rows.

    Rare training categories share the category 'infrequent'; a category that
    training did not have yields no row (all zeros).
    """
    known = category_counts(train, columns).select("column", "value", F.when(
        F.col("n") >= min_frequency, F.col("value")).otherwise(F.lit(INFREQUENT)).alias("category"))
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    long = df.select(*ids, F.explode(F.array(*entries)).alias("e")).select(*ids, "e.*")
    return long.join(known, ["column", "value"]).select(*ids, "column", "category")


def fit_preprocessor(train: DataFrame, categories: Sequence[str], numbers: Sequence[str], *,
                     kind: str = "linear", min_frequency: int = 1, output: str = "features") -> PipelineModel:
    """Categorical branch one-hot, numeric branch filled and (kind 'linear') scaled; the rest dropped.

    Categories and numbers that ``train`` does not have are ignored.
    """
    categories = [c for c in categories if c in train.columns]
    categories += [c for c in train.columns if c.startswith("cluster_kmeans_k") and c not in categories]
    numbers = [c for c in numbers if c in train.columns]
    if not categories and not numbers:
        raise ValueError("no input columns found")
    if kind not in ("linear", "tree"):
        raise ValueError(f"unknown kind {kind!r}")
    found, path = fit_categories(train, categories, min_frequency) if categories else ([], None)
    learned = learn_numbers(train, numbers) if numbers else None
    facts = [{"name": c, "fill": learned.fill[c], "mean": learned.mean[c], "std": learned.std[c] if kind == "linear" else None}
             for c in numbers]
    return PipelineModel(stages=[Encoder(found, facts, path, output)])


def fit_pca(df: DataFrame, features: str, variance: float = 0.90, output: str = "pca") -> tuple[PipelineModel, dict]:
    """Fewest components that reach the share of variance.  ``features`` must be centred."""
    size = len(df.select(features).first()[0])
    full = PCA(k=size, inputCol=features, outputCol=f"{output}__all").fit(df)
    shares = full.explainedVariance.toArray()
    total, keep = 0.0, size
    for i, s in enumerate(shares):
        total += float(s)
        if total >= variance:
            keep = i + 1
            break
    cut = VectorSlicer(inputCol=f"{output}__all", outputCol=output, indices=list(range(keep)))
    info = {"variance_target": float(variance), "n_components": keep,
            "explained_variance_ratio_sum": float(sum(shares[:keep]))}
    return PipelineModel(stages=[full, cut]), info


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weights n / (classes * n_class); rows without a label are a class.

    The weights are one row a class and are broadcast: a shuffle by the label would put a
    whole class into one task.
    """
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    facts = sizes.agg(F.struct(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    weights = sizes.withColumn("__f", facts).select(
        F.col(label).alias("__label"), (F.col("__f.n") / (F.col("__f.k") * F.col("__n"))).alias(name))
    return df.join(F.broadcast(weights), F.col(label).eqNullSafe(F.col("__label"))).drop("__label")


def log_target(df: DataFrame, target: str, name: str, residual: bool = False) -> tuple[DataFrame, bool]:
    """log1p of the target; the target itself when it is a residual or reaches -1."""
    lowest = df.agg(F.min(target)).first()[0]
    use = not residual and lowest is not None and lowest > -1.0
    return df.withColumn(name, F.log1p(target) if use else F.col(target)), use


# Targets and quantities only known after the race.
TARGET_COLUMNS = ["target_reg", "target_ms", "target_resid", "laps_actual", "true_ms", "pred_ms", "milliseconds"]


def choose_target(df: DataFrame, mode: str = "pace") -> tuple[DataFrame, bool]:
    """Rows with a finite target ``y`` (pace or residual) and without the target
    columns; what evaluation needs travels along as ``__ms``, ``__baseline``, ``__laps``."""
    if mode not in ("pace", "residual"):
        raise ValueError(f"unknown target mode {mode!r}")
    residual = mode == "residual" and {"target_resid", "circuit_baseline_pace"} <= set(df.columns)
    laps = next((c for c in ("laps_expected", "laps", "laps_actual") if c in df.columns), None)
    y = F.col("target_resid" if residual else "target_reg").cast("double")
    kept = df.where(F.col("target_reg").isNotNull()).withColumns({
        "y": y,
        "__ms": F.col("target_ms").cast("double") if "target_ms" in df.columns else F.lit(None).cast("double"),
        "__baseline": F.col("circuit_baseline_pace").cast("double") if residual else F.lit(None).cast("double"),
        "__laps": F.col(laps).cast("double") if laps else F.lit(None).cast("double")})
    finite = F.col("y").isNotNull() & ~F.isnan("y") & (F.abs("y") != F.lit(float("inf")))
    return kept.where(finite).drop(*TARGET_COLUMNS), residual
