"""Evaluation of given scores, predictions and clusterings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.evaluation import classification as E
from pitwall.evaluation import clusters as CL
from pitwall.evaluation import regression as RG
from pitwall.evaluation.tournament import leaderboard
from pitwall.models import neighbors as NN
from pitwall.operators import sampling as G
from pitwall.queries import query
from pitwall.queries import roles as R

# Scores: quality labels against the length of the text on 0..1 (with ties).
_SC = """WITH s AS (SELECT doc_id, quality AS label, n_chars / 4000.0::DOUBLE AS score,
  CASE WHEN n_chars / 4000.0::DOUBLE >= 0.3 THEN 1 ELSE 0 END AS prediction FROM labels JOIN documents USING (doc_id))
"""


def _scored(spark, sf):
    docs = R.table(spark, sf, "documents").select("doc_id", "n_chars")
    score = F.col("n_chars") / F.lit(4000.0)
    return R.table(spark, sf, "labels").join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), score.alias("score"),
        F.when(score >= 0.3, 1).otherwise(0).alias("prediction"))


_PER = _SC + """, cls AS (SELECT unnest([0, 1]) AS c)
, per AS (SELECT c, (SELECT count(*) FROM s WHERE label = c AND prediction = c) AS tp, (SELECT count(*) FROM s WHERE label = c) AS support,
   (SELECT count(*) FROM s WHERE prediction = c) AS predicted FROM cls)
, m AS (SELECT c, coalesce(tp / CAST(nullif(predicted, 0) AS DOUBLE), 0) AS p, coalesce(tp / CAST(nullif(support, 0) AS DOUBLE), 0) AS r,
   coalesce(2 * tp / CAST(nullif(support + predicted, 0) AS DOUBLE), 0) AS f, support, tp FROM per)
"""


@query("eval_cls_metrics", _PER + """SELECT round(sum(tp) / CAST(sum(support) AS DOUBLE), 9) AS accuracy, round(avg(p), 9) AS precision_macro,
  round(avg(r), 9) AS recall_macro, round(avg(f), 9) AS f1_macro FROM m""")
def eval_cls_metrics(spark, sf):
    return R.rounded(E.macro_metrics(_scored(spark, sf)), {c: 9 for c in ("accuracy", "precision_macro", "recall_macro", "f1_macro")})


@query("eval_confusion", _SC + """SELECT label, prediction, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY label) AS DOUBLE), 9) AS share
  FROM s GROUP BY label, prediction""")
def eval_confusion(spark, sf):
    return R.rounded(E.confusion(_scored(spark, sf)), {"share": 9})


@query("eval_cls_report", _PER + """SELECT CAST(c AS VARCHAR) AS "row", round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, support FROM m
UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9),
  round(sum(f * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', round(sum(tp) / CAST(sum(support) AS DOUBLE), 9), round(sum(tp) / CAST(sum(support) AS DOUBLE), 9),
  round(sum(tp) / CAST(sum(support) AS DOUBLE), 9), CAST(sum(support) AS BIGINT) FROM m""")
def eval_cls_report(spark, sf):
    return R.rounded(E.classification_report(_scored(spark, sf)), {"precision": 9, "recall": 9, "f1": 9})


_CUM = _SC + """, g AS (SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM s GROUP BY score)
, cum AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
   FROM g WINDOW w AS (ORDER BY score DESC))
"""


@query("eval_roc_points", _CUM + """SELECT score AS threshold, round(fp / CAST(n AS DOUBLE), 9) AS fpr, round(tp / CAST(p AS DOUBLE), 9) AS tpr FROM cum
  UNION ALL SELECT NULL, 0, 0""")
def eval_roc_points(spark, sf):
    return R.rounded(E.roc_points(_scored(spark, sf), "score", "label"), {"fpr": 9, "tpr": 9})


@query("eval_roc_auc", _SC + """, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM s)
SELECT round((sum(CASE WHEN label = 1 THEN rk END) - count_if(label = 1) * (count_if(label = 1) + 1) / 2.0::DOUBLE)
  / (count_if(label = 1) * count_if(label = 0)), 9) AS auc FROM r""")
def eval_roc_auc(spark, sf):
    return R.rounded(E.roc_auc(_scored(spark, sf), "score", "label"), {"auc": 9})


@query("eval_pr_points", _CUM + """SELECT score AS threshold, round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision, round(tp / CAST(p AS DOUBLE), 9) AS recall FROM cum
  UNION ALL SELECT NULL, 1, 0""")
def eval_pr_points(spark, sf):
    return R.rounded(E.pr_points(_scored(spark, sf), "score", "label"), {"precision": 9, "recall": 9})


@query("eval_pr_ap", _CUM + "SELECT round(sum(pos / CAST(p AS DOUBLE) * tp / CAST(tp + fp AS DOUBLE)), 9) AS ap FROM cum")
def eval_pr_ap(spark, sf):
    return R.rounded(E.average_precision(_scored(spark, sf), "score", "label"), {"ap": 9})


_SWEEP = _SC + ", th AS (SELECT unnest([" + ", ".join(f"{t}::DOUBLE" for t in E.THRESHOLDS) + """]) AS threshold)
, c AS (SELECT threshold, count_if(score >= threshold AND label = 1) AS tp, count_if(score >= threshold AND label = 0) AS fp,
    count_if(score < threshold AND label = 0) AS tn, count_if(score < threshold AND label = 1) AS fn FROM th, s GROUP BY 1)
, sw AS (SELECT threshold, round((tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), 9) AS accuracy,
   round((coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) + coalesce(tn / CAST(nullif(tn + fn, 0) AS DOUBLE), 0)) / 2, 9) AS precision_macro,
   round((coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) + coalesce(tn / CAST(nullif(tn + fp, 0) AS DOUBLE), 0)) / 2, 9) AS recall_macro,
   round((coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0) + coalesce(2 * tn / CAST(nullif(2 * tn + fp + fn, 0) AS DOUBLE), 0)) / 2, 9) AS f1_macro FROM c)
"""
_SWEEP_DIGITS = {c: 9 for c in ("accuracy", "precision_macro", "recall_macro", "f1_macro")}


@query("eval_threshold_sweep", _SWEEP + "SELECT * FROM sw")
def eval_threshold_sweep(spark, sf):
    return R.rounded(E.threshold_sweep(_scored(spark, sf), "score", "label"), _SWEEP_DIGITS)


@query("eval_best_thresholds", _SWEEP + "SELECT * FROM sw ORDER BY f1_macro DESC, threshold LIMIT 5")
def eval_best_thresholds(spark, sf):
    return E.best_thresholds(R.rounded(E.threshold_sweep(_scored(spark, sf), "score", "label"), _SWEEP_DIGITS), 5)


# ------------------------------------------------------------ regression

_P = R.with_ctes(R.DATED) + """, p AS (SELECT *, milliseconds / laps AS y, CASE WHEN driverId % 9 <> 0 THEN milliseconds / laps + (driverId % 21 - 10) * 500.0 END AS prediction FROM dated)
"""


def _predicted(spark, sf):
    y = F.col("milliseconds") / F.col("laps")
    return R.dated(spark, sf).withColumns({
        "y": y, "prediction": F.when(F.col("driverId") % 9 != 0, y + (F.col("driverId") % 21 - 10) * 500.0)})


@query("eval_reg_metrics", _P + """, v AS (SELECT y, prediction - y AS e FROM p WHERE isfinite(y) AND isfinite(prediction))
SELECT count(*) AS n, round(sqrt(avg(e * e)), 5) AS rmse, round(avg(abs(e)), 5) AS mae, round(1 - sum(e * e) / (var_pop(y) * count(*)), 8) AS r2 FROM v""")
def eval_reg_metrics(spark, sf):
    return R.rounded(RG.regression_metrics(_predicted(spark, sf), "y", "prediction"), {"rmse": 5, "mae": 5, "r2": 8})


@query("eval_reconstruct", _P + """, t AS (SELECT *, CASE WHEN raceId % 4 <> 0 THEN laps END AS l, CASE WHEN raceId % 3 <> 0 THEN 1000.0 * circuitId END AS b FROM p)
SELECT raceId, driverId, round(y + bb, 3) AS y_true_pace, round(prediction + bb, 3) AS y_pred_pace, ll AS laps_used, milliseconds AS true_ms,
  round((prediction + bb) * ll, 2) AS pred_ms FROM (SELECT *, coalesce(l, (SELECT median(l) FROM t WHERE year <= 1998)) AS ll,
  coalesce(b, (SELECT median(b) FROM t WHERE year <= 1998)) AS bb FROM t) WHERE year > 1998""")
def eval_reconstruct(spark, sf):
    rows = _predicted(spark, sf).withColumns({
        "__laps": F.when(F.col("raceId") % 4 != 0, F.col("laps")).cast("double"),
        "__baseline": F.when(F.col("raceId") % 3 != 0, 1000.0 * F.col("circuitId")), "__ms": F.col("milliseconds")})
    out = RG.reconstruct(rows.where(F.col("year") > 1998), rows.where(F.col("year") <= 1998), residual=True)
    return R.rounded(out.select("raceId", "driverId", "y_true_pace", "y_pred_pace", "laps_used", "true_ms", "pred_ms"),
                     {"y_true_pace": 3, "y_pred_pace": 3, "pred_ms": 2})


_ERR = "e AS (SELECT circuitId, year, abs((driverId % 21 - 10) * 500 + grid) AS err FROM dated)"


def _errors(spark, sf):
    return R.dated(spark, sf).select("circuitId", "year", F.abs((F.col("driverId") % 21 - 10) * 500 + F.col("grid")).alias("err"))


@query("eval_error_by_group", R.with_ctes(R.DATED, _ERR) + """SELECT circuitId, avg(err) AS mean, count(err) AS count, median(err) AS median
  FROM e GROUP BY 1 HAVING count(err) >= 25""")
def eval_error_by_group(spark, sf):
    return RG.error_by_group(_errors(spark, sf), "circuitId", "err", 25)


@query("eval_split_summary", R.with_ctes(R.DATED) + """SELECT CASE WHEN year <= 1998 THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows,
  min(year) AS year_min, max(year) AS year_max, avg(CASE WHEN points > 0 THEN 1 ELSE 0 END) AS positive_share FROM dated GROUP BY 1""")
def eval_split_summary(spark, sf):
    rows = R.dated(spark, sf).select("raceId", "driverId", "year", F.when(F.col("points") > 0, 1).otherwise(0).alias("label"))
    return E.split_summary(G.split_time(rows, ["raceId", "driverId"], 1998), label="label")


_METRICS = R.with_ctes(R.DATED) + """, t AS (SELECT 'm' || circuitId AS model, avg(points) AS train_f1_macro_mean, avg(laps) AS cv_f1_macro_mean, avg(grid) AS test_f1_macro FROM dated GROUP BY 1)
"""


@query("eval_leaderboard", _METRICS + """SELECT *, train_f1_macro_mean - cv_f1_macro_mean AS generalization_gap_f1,
  row_number() OVER (ORDER BY cv_f1_macro_mean DESC, model) AS place FROM t""")
def eval_leaderboard(spark, sf):
    table = R.dated(spark, sf).groupBy(F.concat(F.lit("m"), F.col("circuitId").cast("string")).alias("model")).agg(
        F.avg("points").alias("train_f1_macro_mean"), F.avg("laps").alias("cv_f1_macro_mean"), F.avg("grid").alias("test_f1_macro"))
    return leaderboard(table, order_by="no_such_metric", fallback="cv_f1_macro_mean",
                       gap=("train_f1_macro_mean", "cv_f1_macro_mean"))


# ------------------------------------------------------------ vectors

# Embeddings on whole numbers, so squared distances are exact.
_VEC = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) * 1000)) AS x FROM embeddings)"""


def _vectors(spark, sf):
    return R.table(spark, sf, "embeddings").select(
        "vec_id", "label", F.transform("embedding", lambda x: F.round(x.cast("double") * 1000)).alias("x"))


_KNN = f"""WITH {_VEC}, o AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', vec_id, '42')), vec_id) - 1 < ceil((SELECT count(*) FROM v) * 0.2::DOUBLE) AS test FROM v)
, d AS (SELECT q.vec_id AS query_id, t.vec_id AS neighbor_id, CAST(t.label AS DOUBLE) AS target,
   list_inner_product(q.x, q.x) + list_inner_product(t.x, t.x) - 2 * list_inner_product(q.x, t.x) AS dist2 FROM o q, o t WHERE q.test AND NOT t.test)
, near AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY dist2, neighbor_id) <= 7)
"""


def _knn_sides(spark, sf):
    split = G.split_random(_vectors(spark, sf), ["vec_id"])
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test")


@query("model_knn_cls", _KNN + """SELECT query_id, first(target ORDER BY n DESC, target) AS prediction FROM
  (SELECT query_id, target, count(*) AS n FROM near GROUP BY 1, 2) GROUP BY 1""")
def model_knn_cls(spark, sf):
    train, test = _knn_sides(spark, sf)
    return NN.knn_classify(train, test, 7, id_col="vec_id", features="x", target="label")


@query("model_knn_reg", _KNN + """SELECT query_id, round(sum(target / sqrt(dist2)) / sum(1 / sqrt(dist2)), 7) AS prediction FROM near GROUP BY 1""")
def model_knn_reg(spark, sf):
    train, test = _knn_sides(spark, sf)
    return R.rounded(NN.knn_regress(train, test, 7, id_col="vec_id", features="x", target="label", weights="distance"),
                     {"prediction": 7})


@query("eval_silhouette", f"""WITH {_VEC}, pr AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(sqrt(greatest(0,
    list_inner_product(a.x, a.x) + list_inner_product(b.x, b.x) - 2 * list_inner_product(a.x, b.x)))) AS t, count(*) AS n FROM v a, v b GROUP BY ALL)
, ab AS (SELECT vec_id, max(CASE WHEN own = other THEN t / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN t / n END) AS b FROM pr GROUP BY 1)
SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 9) AS silhouette FROM ab""")
def eval_silhouette(spark, sf):
    return R.rounded(CL.silhouette_exact(_vectors(spark, sf), "vec_id", "x", "label"), {"silhouette": 9})


_LONG = f"""WITH {_VEC}, l AS (SELECT label, vec_id, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v)
, c AS (SELECT label, i, avg(x) AS m, var_pop(x) * count(*) AS w, count(*) AS n FROM l GROUP BY 1, 2)
"""


@query("eval_calinski", _LONG + """, g AS (SELECT i, avg(x) AS gm FROM l GROUP BY 1)
SELECT round(sum(n * (m - gm) * (m - gm)) * ((SELECT count(*) FROM v) - count(DISTINCT label)) / (sum(w) * (count(DISTINCT label) - 1)), 7) AS calinski_harabasz
FROM c JOIN g USING (i)""")
def eval_calinski(spark, sf):
    return R.rounded(CL.calinski_harabasz(_vectors(spark, sf), "x", "label", 64), {"calinski_harabasz": 7})


@query("eval_davies_bouldin", _LONG + """, s AS (SELECT label, avg(d) AS s FROM (SELECT label, vec_id, sqrt(sum((x - m) * (x - m))) AS d FROM l JOIN c USING (label, i) GROUP BY 1, 2) GROUP BY 1)
, dd AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS d FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2)
SELECT round(avg(r), 8) AS davies_bouldin FROM (SELECT la, max((x.s + y.s) / d) AS r FROM dd JOIN s x ON la = x.label JOIN s y ON lb = y.label GROUP BY 1)""")
def eval_davies_bouldin(spark, sf):
    return R.rounded(CL.davies_bouldin(_vectors(spark, sf), "x", "label", 64), {"davies_bouldin": 8})
