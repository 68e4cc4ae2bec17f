"""Splits, samples, folds and preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.models import prep
from pitwall.models.dictionary import category_counts, dense_slots
from pitwall.operators import sampling as G
from pitwall.queries import query
from pitwall.queries import roles as R
from pitwall.session import materialise

IDS = ["raceId", "driverId"]
_D = R.with_ctes(R.DATED)
_H = "md5(concat_ws('|', raceId, driverId, '42'))"
_HR = "md5(concat_ws('|', raceId, '42'))"


def _flagged(spark, sf):
    return R.dated(spark, sf).withColumn("label", F.when(F.col("points") > 0, 1).otherwise(0))


_F = _D + ", f AS (SELECT *, CASE WHEN points > 0 THEN 1 ELSE 0 END AS label FROM dated)\n"


@query("split_random", _D + f"""SELECT raceId, driverId, CASE WHEN row_number() OVER (ORDER BY {_H}, raceId, driverId) - 1
  < (SELECT ceil(count(*) * 0.2::DOUBLE) FROM dated) THEN 'test' ELSE 'train' END AS split FROM dated""")
def split_random(spark, sf):
    return G.split_random(R.dated(spark, sf).select(*IDS), IDS)


@query("split_stratified", _F + f"""SELECT raceId, driverId, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {_H}, raceId, driverId) - 1
  < round(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM f""")
def split_stratified(spark, sf):
    return G.split_stratified(_flagged(spark, sf).select(*IDS, "label"), IDS, "label")


@query("split_time", _D + "SELECT raceId, driverId, year, CASE WHEN year <= 1999 THEN 'train' ELSE 'test' END AS split FROM dated")
def split_time(spark, sf):
    return G.split_time(R.dated(spark, sf).select(*IDS, "year"), IDS, 1999)


@query("sample_rows", _D + f"SELECT raceId, driverId FROM dated ORDER BY {_H}, raceId, driverId LIMIT 5000")
def sample_rows(spark, sf):
    return G.sample_rows(R.dated(spark, sf).select(*IDS), IDS, 5000)


_RC = ", rc AS (SELECT DISTINCT raceId, year, round FROM dated)\n"


def _pool_sql(min_races: int, share: float) -> str:
    return f""", aged AS (SELECT raceId, row_number() OVER (ORDER BY year DESC, round DESC, raceId DESC) - 1 AS age, count(*) OVER () AS total FROM rc)
, pool AS (SELECT raceId, p FROM (SELECT *, least(total, greatest({min_races}, round_even(total * {share}::DOUBLE, 0))) AS p FROM aged) WHERE age < p)
, picked AS (SELECT raceId FROM (SELECT raceId, p, row_number() OVER (ORDER BY {_HR}, raceId) - 1 AS r FROM pool)
   WHERE r < greatest({min_races}, least(round_even(p * 0.85::DOUBLE, 0), p)))
"""


@query("sample_groups", _D + _RC + _pool_sql(25, 0.6) + "SELECT raceId, driverId, points FROM dated SEMI JOIN picked USING (raceId)")
def sample_groups(spark, sf):
    return G.sample_races(R.dated(spark, sf).select(*IDS, "points", "year", "round"), frac=0.85,
                          recent_pool_frac=0.6).select(*IDS, "points")


@query("pick_segmentation", _D + _RC + _pool_sql(25, 1.0) + "SELECT raceId, driverId, points FROM dated SEMI JOIN picked USING (raceId)")
def pick_segmentation(spark, sf):
    # all three are asked for: random races win
    return G.segment_train(R.dated(spark, sf).select(*IDS, "points", "year", "round"), sample_frac=0.85,
                           last_n=100, max_rows=1000).select(*IDS, "points")


@query("last_n_groups", _D + _RC + """SELECT raceId, driverId, points FROM dated SEMI JOIN
  (SELECT raceId FROM rc ORDER BY year DESC, round DESC, raceId DESC LIMIT 400) USING (raceId)""")
def last_n_groups(spark, sf):
    return G.last_n_races(R.dated(spark, sf).select(*IDS, "points", "year", "round"), 400).select(*IDS, "points")


@query("win_row_budget", _D + """, rc AS (SELECT raceId, year, round, count(*) AS n FROM dated GROUP BY ALL)
, run AS (SELECT raceId, sum(n) OVER w AS c, row_number() OVER w AS i FROM rc WINDOW w AS (ORDER BY year DESC, round DESC, raceId DESC))
SELECT raceId, driverId, points FROM dated SEMI JOIN (SELECT raceId FROM run WHERE i <= 30 OR c <= 3000) USING (raceId)""")
def win_row_budget(spark, sf):
    return G.row_budget(R.dated(spark, sf).select(*IDS, "points", "year", "round"), 3000).select(*IDS, "points")


@query("fold_stratified", _F + f"""SELECT raceId, driverId, label, (row_number() OVER (PARTITION BY label ORDER BY {_H}, raceId, driverId) - 1) % 5 AS fold FROM f""")
def fold_stratified(spark, sf):
    return G.fold_stratified(_flagged(spark, sf).select(*IDS, "label"), IDS, "label")


@query("fold_random", _D + f"SELECT raceId, driverId, (row_number() OVER (ORDER BY {_H}, raceId, driverId) - 1) % 5 AS fold FROM dated")
def fold_random(spark, sf):
    return G.fold_random(R.dated(spark, sf).select(*IDS), IDS)


_PLACE = "list_position(w.loads, list_min(w.loads))"


@query("fold_group", _D.replace("WITH ", "WITH RECURSIVE ", 1) + f""", g AS (SELECT raceId, count(*) AS n FROM dated GROUP BY 1)
, o AS MATERIALIZED (SELECT raceId, n, row_number() OVER (ORDER BY n DESC, {_HR}, raceId) AS i FROM g)
, walk AS (SELECT 0::BIGINT AS i, [0, 0, 0, 0, 0]::BIGINT[] AS loads, -1::BIGINT AS fold
  UNION ALL SELECT o.i, list_transform(w.loads, lambda x, j: CASE WHEN j = {_PLACE} THEN x + o.n ELSE x END), {_PLACE} - 1 FROM walk w JOIN o ON o.i = w.i + 1)
SELECT d.raceId, d.driverId, fold FROM dated d JOIN o USING (raceId) JOIN walk ON walk.i = o.i""")
def fold_group(spark, sf):
    return G.fold_group(R.dated(spark, sf).select(*IDS), "raceId").select(*IDS, "fold")


@query("fold_time_series", _D + _RC + """, p AS (SELECT raceId, row_number() OVER (ORDER BY year, round, raceId) - 1 AS pos, count(*) OVER () AS n FROM rc)
, x AS (SELECT raceId, CAST(fold AS INT) AS fold, pos, n // 6 AS size, n - (5 - fold) * (n // 6) AS start FROM p, range(5) t(fold))
SELECT raceId, fold, CASE WHEN pos < start THEN 'train' ELSE 'valid' END AS role FROM x WHERE pos < start + size""")
def fold_time_series(spark, sf):
    return G.fold_time_series(R.dated(spark, sf).select("raceId", "year", "round"))


# ------------------------------------------------------------ preparation

def _train_test(spark, sf):
    rows = materialise(R.dated(spark, sf))  # learning reads the training rows several times
    return rows.where(F.col("year") <= 1998), rows.where(F.col("year") > 1998)


_TT = _D + ", tr AS (SELECT * FROM dated WHERE year <= 1998), te AS (SELECT * FROM dated WHERE year > 1998)\n"


@query("prep_impute", _TT + """, typed AS (SELECT *, CASE WHEN points > 7 THEN 'c' || constructorId % 3 END AS cat FROM tr)
SELECT raceId, driverId, coalesce(milliseconds, (SELECT median(milliseconds) FROM tr)) AS milliseconds,
  coalesce(fastestLapSpeed, (SELECT median(fastestLapSpeed) FROM tr)) AS fastestLapSpeed,
  coalesce(CASE WHEN points > 7 THEN 'c' || constructorId % 3 END,
    (SELECT cat FROM typed WHERE cat IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS cat FROM te""")
def prep_impute(spark, sf):
    cat = F.when(F.col("points") > 7, F.concat(F.lit("c"), (F.col("constructorId") % 3).cast("string")))
    train, test = (d.withColumn("cat", cat) for d in _train_test(spark, sf))
    numbers = prep.learn_numbers(train, ["milliseconds", "fastestLapSpeed"])
    return prep.impute(test, numbers, prep.learn_modes(train, ["cat"])).select(
        *IDS, "milliseconds", "fastestLapSpeed", "cat")


def _sql_onehot(c: str, n: int) -> str:
    return (f"SELECT raceId, driverId, '{c}' AS \"column\", CASE WHEN n >= {n} THEN v ELSE 'infrequent' END AS category "
            f"FROM (SELECT raceId, driverId, CAST({c} AS VARCHAR) AS v FROM te) JOIN (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM tr GROUP BY 1) USING (v)")


@query("prep_onehot", _TT + _sql_onehot("driverId", 290) + " UNION ALL " + _sql_onehot("circuitId", 10))
def prep_onehot(spark, sf):
    train, test = _train_test(spark, sf)
    a = prep.onehot_long(train, test, IDS, ["driverId"], 290)
    return a.unionByName(prep.onehot_long(train, test, IDS, ["circuitId"], 10))


@query("prep_dense_slots", _D + """, c AS (SELECT 'raceId' AS "column", CAST(raceId AS VARCHAR) AS value, count(*) AS n FROM dated GROUP BY ALL
  UNION ALL SELECT 'driverId', CAST(driverId AS VARCHAR), count(*) FROM dated GROUP BY ALL)
SELECT "column", value, n, CASE WHEN n >= 3 THEN count(*) FILTER (n >= 3) OVER (PARTITION BY "column" ORDER BY md5(value), value ROWS UNBOUNDED PRECEDING) - 1
  ELSE count(*) FILTER (n >= 3) OVER (PARTITION BY "column") END AS slot FROM c""")
def prep_dense_slots(spark, sf):
    """The dictionary of two columns, one of them with nearly as many categories as a third of the rows."""
    return dense_slots(materialise(category_counts(R.dated(spark, sf), ["raceId", "driverId"])), 3)


@query("prep_scale", _TT + ", ".join(["SELECT raceId, driverId"] + [
    f"round((coalesce({c}, (SELECT median({c}) FROM tr)) - (SELECT avg(coalesce({c}, (SELECT median({c}) FROM tr))) FROM tr)) / "
    f"(SELECT stddev_pop(coalesce({c}, (SELECT median({c}) FROM tr))) FROM tr), 8) AS {c}" for c in ("grid", "laps", "fastestLapSpeed")])
    + " FROM te")
def prep_scale(spark, sf):
    train, test = _train_test(spark, sf)
    columns = ["grid", "laps", "fastestLapSpeed"]
    out = prep.scale(test, prep.learn_numbers(train, columns))
    return R.rounded(out.select(*IDS, *columns), {c: 8 for c in columns})


@query("prep_class_weight", _F + """SELECT raceId, driverId, label, (SELECT count(*) FROM f) / (2.0::DOUBLE * count(*) OVER (PARTITION BY label)) AS weight FROM f""")
def prep_class_weight(spark, sf):
    return prep.class_weights(_flagged(spark, sf).select(*IDS, "label"), "label")


@query("prep_log_target", _D + "SELECT raceId, driverId, round(ln(1 + points), 9) AS y, round(points, 6) AS back FROM dated")
def prep_log_target(spark, sf):
    out, used = prep.log_target(R.dated(spark, sf), "points", "y")
    return out.select(*IDS, F.round("y", 9).alias("y"), F.round(F.expm1("y") if used else F.col("y"), 6).alias("back"))


@query("prep_target_mode", _D + """SELECT raceId, driverId, grid, milliseconds / laps - 1000.0 * circuitId AS y FROM dated WHERE milliseconds IS NOT NULL""")
def prep_target_mode(spark, sf):
    rows = R.dated(spark, sf).withColumns({
        "target_ms": F.col("milliseconds"), "target_reg": F.col("milliseconds") / F.col("laps"),
        "circuit_baseline_pace": 1000.0 * F.col("circuitId")})
    rows = rows.withColumn("target_resid", F.col("target_reg") - F.col("circuit_baseline_pace"))
    out, _ = prep.choose_target(rows, "residual")
    return out.select(*IDS, "grid", "y")
