"""Classification metrics, curves and threshold tables, each from grouped counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.operators.quantiles import scalar_of
from pitwall.operators.scan import prefix_scan, value_slices
from pitwall.session import ROWS_PER_TASK

THRESHOLDS = [round(0.05 * i, 2) for i in range(1, 20)]


def minmax_score(df: DataFrame, raw: str, name: str = "score") -> DataFrame:
    """Raw scores on 0..1; the small constant guards a constant score."""
    edge = scalar_of(df.agg(F.min(raw).alias("lo"), F.max(raw).alias("hi")))
    scaled = (F.col(raw) - F.col("__e.lo")) / (F.col("__e.hi") - F.col("__e.lo") + F.lit(1e-12))
    return df.withColumn("__e", edge).withColumn(name, scaled).drop("__e")


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """(label, prediction, n, share of the label): the counts everything else is made of."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("label").agg(F.sum("n").alias("t"))
    return counts.join(totals, "label").select("label", "prediction", "n", (F.col("n") / F.col("t")).alias("share"))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class: precision, recall, f1 and support; a zero denominator gives 0."""
    counts = df.groupBy(F.col(label).cast("double").alias("a"), F.col(pred).cast("double").alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    sides = counts.select(F.explode(F.array(
        F.struct(F.col("a").alias("class"), F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("b").alias("class"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")))).alias("s")).select("s.*")
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    zero = F.lit(0.0)
    per = per.withColumns({
        "precision": F.coalesce(F.col("tp") / F.nullif(F.col("predicted"), F.lit(0)), zero),
        "recall": F.coalesce(F.col("tp") / F.nullif(F.col("support"), F.lit(0)), zero),
        "f1": F.coalesce(2 * F.col("tp") / F.nullif(F.col("support") + F.col("predicted"), F.lit(0)), zero)})
    return per.select("class", "precision", "recall", "f1", "support", "tp")


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Class rows, then accuracy, macro and weighted averages."""
    per = class_report(df, label, pred)
    n = F.sum("support")
    names = ("precision", "recall", "f1")
    macro = per.agg(F.lit("macro avg").alias("row"), *[F.avg(c).alias(c) for c in names], n.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("row"),
                       *[(F.sum(F.col(c) * F.col("support")) / n).alias(c) for c in names], n.alias("support"))
    accuracy = per.agg(F.lit("accuracy").alias("row"),
                       *[(F.sum("tp") / n).alias(c) for c in names], n.alias("support"))
    classes = per.select(F.col("class").cast("int").cast("string").alias("row"), *names, "support")
    return classes.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def macro_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row: accuracy and macro precision, recall and f1."""
    return class_report(df, label, pred).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"), F.avg("f1").alias("f1_macro"))


def macro_from_counts(counts: Mapping[tuple[float, float], int]) -> dict[str, float]:
    """The same four numbers from collected confusion counts (classes squared entries)."""
    classes = sorted({c for pair in counts for c in pair})
    total = sum(counts.values())
    rows = []
    for c in classes:
        tp = counts.get((c, c), 0)
        support = sum(n for (a, _), n in counts.items() if a == c)
        predicted = sum(n for (_, b), n in counts.items() if b == c)
        rows.append((tp / predicted if predicted else 0.0, tp / support if support else 0.0,
                     2 * tp / (support + predicted) if support + predicted else 0.0))
    k = max(1, len(classes))
    return {"accuracy": sum(counts.get((c, c), 0) for c in classes) / total if total else 0.0,
            "precision_macro": sum(r[0] for r in rows) / k, "recall_macro": sum(r[1] for r in rows) / k,
            "f1_macro": sum(r[2] for r in rows) / k}


# ------------------------------------------------------------ curves

def score_counts(df: DataFrame, score: str, label: str, rows_per_slice: int = ROWS_PER_TASK) -> DataFrame:
    """One row per distinct score, best first in meaning, with the positives and
    negatives scored strictly higher (``tp``, ``fp``) and at it (``pos``, ``neg``).

    Equal scores are combined first, then a two-level scan runs over the distinct ones.
    """
    by_score = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    sliced = value_slices(by_score, "score", name="__cut", rows_per_slice=rows_per_slice)
    return prefix_scan(sliced, order=["score"], slices=["__cut"], sums={"tp": "pos", "fp": "neg"},
                       descending=True).drop("__cut")


def _with_totals(counted: DataFrame) -> DataFrame:
    totals = scalar_of(counted.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")))
    return counted.withColumn("__t", totals)


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; the origin has no threshold."""
    c = _with_totals(score_counts(df, score, label))
    points = c.select(F.col("score").alias("threshold"),
                      ((F.col("fp") + F.col("neg")) / F.col("__t.n")).alias("fpr"),
                      ((F.col("tp") + F.col("pos")) / F.col("__t.p")).alias("tpr"))
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the curve; ties count half."""
    c = score_counts(df, score, label)
    area = F.sum(F.col("neg") * (2 * F.col("tp") + F.col("pos")))  # twice the area, in whole numbers
    return c.agg((area.cast("double") / (2 * F.sum("pos") * F.sum("neg"))).alias("auc"))


def pr_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, precision, recall) at every distinct score; the end point (1, 0) has no threshold."""
    c = _with_totals(score_counts(df, score, label))
    tp, fp = F.col("tp") + F.col("pos"), F.col("fp") + F.col("neg")
    points = c.select(F.col("score").alias("threshold"), (tp / (tp + fp)).alias("precision"),
                      (tp / F.col("__t.p")).alias("recall"))
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    c = score_counts(df, score, label)
    tp, fp = F.col("tp") + F.col("pos"), F.col("fp") + F.col("neg")
    return c.agg((F.sum(F.col("pos") * tp / (tp + fp)) / F.sum("pos")).alias("ap"))


def threshold_sweep(df: DataFrame, score: str, label: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Accuracy and macro metrics per threshold, from one pass over the scores."""
    s, y = F.col(score), F.col(label)
    wide = df.agg(
        F.count_if(y == 1).alias("p"), F.count_if(y == 0).alias("n"),
        *[F.count_if((s >= F.lit(t)) & (y == 1)).alias(f"tp{i}") for i, t in enumerate(thresholds)],
        *[F.count_if((s >= F.lit(t)) & (y == 0)).alias(f"fp{i}") for i, t in enumerate(thresholds)])
    rows = wide.select("p", "n", F.inline(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
        for i, t in enumerate(thresholds)])))
    tp, fp, p, n = F.col("tp"), F.col("fp"), F.col("p"), F.col("n")
    tn, fn = n - fp, p - tp

    def share(a, b):
        return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))

    return rows.select(
        "threshold", ((tp + tn) / (p + n)).alias("accuracy"),
        ((share(tp, tp + fp) + share(tn, tn + fn)) / 2).alias("precision_macro"),
        ((share(tp, p) + share(tn, n)) / 2).alias("recall_macro"),
        ((share(2 * tp, tp + fp + p) + share(2 * tn, tn + fn + n)) / 2).alias("f1_macro"))


def best_thresholds(sweep: DataFrame, k: int = 5) -> DataFrame:
    return sweep.orderBy(F.col("f1_macro").desc(), "threshold").limit(k)


def split_summary(df: DataFrame, split: str = "split", year: str = "year", label: str | None = None) -> DataFrame:
    """Per split: rows, first and last year, share of the positive class."""
    facts = [F.count(F.lit(1)).alias("n_rows"), F.min(year).alias("year_min"), F.max(year).alias("year_max")]
    if label:
        facts.append(F.avg(label).alias("positive_share"))
    return df.groupBy(split).agg(*facts)
