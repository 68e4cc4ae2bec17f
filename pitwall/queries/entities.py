"""Aggregates, profiles and the entity-level composites."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.operators import aggregates as A
from pitwall.operators.quantiles import global_stats
from pitwall.plans import features as P
from pitwall.queries import query
from pitwall.queries import roles as R
from pitwall.queries.basic import integrated
from pitwall.queries.histories import _FIN, fin

_RES = R.with_ctes(R.RESULTS)
_DATED = R.with_ctes(R.DATED)


@query("agg_group_count", R.with_ctes(R.RACES) + "SELECT year, count(*) AS n FROM races GROUP BY year")
def agg_group_count(spark, sf):
    return A.group_count(R.races(spark, sf), ["year"])


@query("agg_group_sum", _RES + "SELECT constructorId, coalesce(sum(nullif(points, 5)), 0.0) AS points FROM results GROUP BY 1")
def agg_group_sum(spark, sf):
    points = F.when(F.col("points") != 5, F.col("points"))
    return R.results(spark, sf).groupBy("constructorId").agg(F.coalesce(F.sum(points), F.lit(0.0)).alias("points"))


@query("agg_having", "SELECT user_id, count(*) AS n, max(value) AS top FROM events GROUP BY 1 HAVING count(*) >= 60")
def agg_having(spark, sf):
    return R.table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top")).where(F.col("n") >= 60)


@query("agg_count_distinct", _DATED + "SELECT year, count(DISTINCT driverId) AS drivers, count(DISTINCT raceId) AS races FROM dated GROUP BY 1")
def agg_count_distinct(spark, sf):
    return R.dated(spark, sf).groupBy("year").agg(
        F.count_distinct("driverId").alias("drivers"), F.count_distinct("raceId").alias("races"))


_MS_COLS = ["grid", "laps", "milliseconds"]


def _sql_multi(cols, stats, src, by, digits=4) -> str:
    fn = {"mean": "avg({c})", "std": "stddev_samp({c})", "median": "median({c})", "min": "min({c})", "max": "max({c})", "count": "count({c})"}
    return ", ".join(
        (f"round({fn[s].format(c=c)}, {digits}) AS {c}__{s}" if s == "std" else f"{fn[s].format(c=c)} AS {c}__{s}")
        for c in cols for s in stats)


_FIVE = ["mean", "std", "median", "min", "max"]


def _round_std(df):
    return R.rounded(df, {c: 4 for c in df.columns if c.endswith("__std")})


@query("agg_multi_stat", _RES + f"SELECT raceId, {_sql_multi(_MS_COLS, _FIVE, 'results', 'raceId')}, count(*) AS _rows__sum FROM results GROUP BY raceId")
def agg_multi_stat(spark, sf):
    return _round_std(A.multi_stat(R.results(spark, sf), ["raceId"], _MS_COLS, row_count="_rows__sum"))


@query("agg_cv_ratio", _RES + """SELECT raceId, round(stddev_samp(grid) / (abs(avg(grid)) + 1e-6), 9) AS grid_cv FROM results GROUP BY 1""")
def agg_cv_ratio(spark, sf):
    per_race = R.results(spark, sf).groupBy("raceId").agg(F.avg("grid").alias("m"), F.stddev_samp("grid").alias("s"))
    return per_race.select("raceId", F.round(A.variation("m", "s"), 9).alias("grid_cv"))


@query("agg_cluster_profile", R.with_ctes(R.RESULTS) + ", c AS (SELECT constructorId % 4 AS cluster, grid, laps, milliseconds FROM results) "
       + f"SELECT cluster, {_sql_multi(_MS_COLS, ['count', 'mean', 'median', 'std', 'min', 'max'], 'c', 'cluster')}, count(*) AS n_samples FROM c GROUP BY 1")
def agg_cluster_profile(spark, sf):
    from pitwall.models.clustering import cluster_profile

    rows = R.results(spark, sf).withColumn("cluster", F.col("constructorId") % 4)
    return _round_std(cluster_profile(rows, "cluster", _MS_COLS, row_count="n_samples"))


@query("agg_value_counts", "SELECT event_type, count(*) AS n, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM events) AS share FROM events GROUP BY 1")
def agg_value_counts(spark, sf):
    return A.value_shares(R.table(spark, sf, "events"), "event_type")


@query("agg_distinct_rows", _DATED + "SELECT DISTINCT raceId, year, round FROM dated")
def agg_distinct_rows(spark, sf):
    return R.dated(spark, sf).select("raceId", "year", "round").distinct()


@query("agg_global_stats", _RES + "SELECT avg(milliseconds) AS mean_ms, median(milliseconds) AS median_ms, median(laps) AS median_laps FROM results")
def agg_global_stats(spark, sf):
    return global_stats(R.results(spark, sf), means={"mean_ms": "milliseconds"},
                        medians={"median_ms": "milliseconds", "median_laps": "laps"})


_DESC_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "cents"]
_DESC_TXT = ["l_returnflag", "l_linestatus"]
_DESC_SQL = "WITH d AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_returnflag, l_linestatus FROM lineitem)\n" + " UNION ALL ".join(
    [f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
     quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max,
     CAST(NULL AS BIGINT) AS "unique", NULL AS top, CAST(NULL AS BIGINT) AS freq FROM d""" for c in _DESC_NUM]
    + [f"""SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}),
     (SELECT {c} FROM d GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), (SELECT count(*) FROM d GROUP BY {c} ORDER BY 1 DESC LIMIT 1) FROM d""" for c in _DESC_TXT])


@query("agg_describe", _DESC_SQL)
def agg_describe(spark, sf):
    rows = R.table(spark, sf, "lineitem").withColumn("cents", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    return R.rounded(A.describe(rows.select(*_DESC_NUM, *_DESC_TXT)), {"std": 4})


@query("agg_missing", _RES + """SELECT 'milliseconds' AS "column", CAST(count_if(milliseconds IS NULL) AS BIGINT) AS n_missing,
  count_if(milliseconds IS NULL) * 100.0::DOUBLE / count(*) AS pct FROM results
  UNION ALL SELECT 'fastestLapSpeed', CAST(count_if(fastestLapSpeed IS NULL) AS BIGINT), count_if(fastestLapSpeed IS NULL) * 100.0::DOUBLE / count(*) FROM results""")
def agg_missing(spark, sf):
    return A.missing_report(R.results(spark, sf))


_CORR = ["grid", "laps", "points", "positionOrder"]


@query("agg_correlation", _RES + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r FROM results" for a in _CORR for b in _CORR))
def agg_correlation(spark, sf):
    return R.rounded(A.correlation_matrix(R.results(spark, sf), _CORR), {"r": 9})


_HIST = """WITH v AS (SELECT CAST(round(value * 100) AS BIGINT) AS x FROM events),
e AS (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi FROM v),
b AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * {n}) AS INT), {n} - 1) AS bin FROM v, e)
SELECT CAST(range AS INT) AS bin, coalesce(n, 0) AS n FROM range({n}) LEFT JOIN (SELECT bin, count(*) AS n FROM b GROUP BY 1) ON bin = range"""


@query("agg_histogram", _HIST.format(n=25))
def agg_histogram(spark, sf):
    rows = R.table(spark, sf, "events").select(F.round(F.col("value") * 100).cast("bigint").alias("x"))
    return A.histogram(rows, "x", 25)


@query("agg_box_stats", """WITH v AS (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS x FROM events),
q AS (SELECT event_type, count(*) AS n, quantile_cont(x, 0.25) AS q1, median(x) AS med, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1)
SELECT event_type, any_value(n) AS n, any_value(q1) AS q1, any_value(med) AS med, any_value(q3) AS q3, min(x) AS low, max(x) AS high
FROM v JOIN q USING (event_type) WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1""")
def agg_box_stats(spark, sf):
    rows = R.table(spark, sf, "events").select("event_type", F.round(F.col("value") * 100).cast("bigint").alias("x"))
    return A.box_stats(rows, "event_type", "x")


# ------------------------------------------------------------ driver and season

_SEASON = R.with_ctes(R.DATED, R.QUALIFYING) + """
, s AS (SELECT *, CASE WHEN statusId = 1 THEN 1 ELSE 0 END AS fin, CASE WHEN positionOrder <= 3 THEN 1 ELSE 0 END AS pod,
   CASE WHEN positionOrder = 1 THEN 1 ELSE 0 END AS win, CASE WHEN statusId = 1 AND milliseconds BETWEEN 600000 AND 20000000
   AND laps BETWEEN 10 AND 100 THEN milliseconds / laps END AS pace FROM dated)
, m AS (SELECT driverId, year, first(constructorId ORDER BY n DESC, constructorId) AS constructor_mode FROM
   (SELECT driverId, year, constructorId, count(*) AS n FROM s GROUP BY ALL) GROUP BY 1, 2)
, a AS (SELECT driverId, year, count(DISTINCT raceId) AS n_races, CAST(sum(fin) AS BIGINT) AS n_finish, avg(fin) AS finish_rate,
   avg(pod) AS podium_rate, avg(win) AS win_rate, sum(points) AS points_sum, avg(points) AS points_avg, avg(grid) AS grid_avg,
   median(grid) AS grid_median, round(avg(pace), 3) AS pace_avg, round(median(pace), 3) AS pace_median FROM s GROUP BY 1, 2)
"""
_SEASON_COLS = ["driverId", "year", "n_races", "n_finish", "finish_rate", "podium_rate", "win_rate", "points_sum", "points_avg",
                "grid_avg", "grid_median", "pace_avg", "pace_median", "constructor_mode"]


def driver_season(spark, sf, min_races=5, quali=True):
    c = R.written_cars(spark, sf) if quali else None  # cut twice then
    return P.driver_season(R.results(spark, sf, c), R.races(spark, sf), R.qualifying(spark, sf, c) if quali else None, min_races)


@query("agg_entity_season", _SEASON + f"SELECT {', '.join(_SEASON_COLS)} FROM a JOIN m USING (driverId, year)")
def agg_entity_season(spark, sf):
    return R.rounded(driver_season(spark, sf, 0, False).select(*_SEASON_COLS), {"pace_avg": 3, "pace_median": 3})


@query("feat_driver_season", _SEASON + f""", q AS (SELECT driverId, year, avg(position) AS quali_pos_avg, median(position) AS quali_pos_median
   FROM qualifying JOIN races USING (raceId) GROUP BY 1, 2)
SELECT {', '.join(_SEASON_COLS)}, quali_pos_avg, quali_pos_median FROM a JOIN m USING (driverId, year) LEFT JOIN q USING (driverId, year)
WHERE n_races >= 5""")
def feat_driver_season(spark, sf):
    out = driver_season(spark, sf)
    return R.rounded(out.select(*_SEASON_COLS, "quali_pos_avg", "quali_pos_median"), {"pace_avg": 3, "pace_median": 3})


# ------------------------------------------------------------ integrated, primary, season points

_INT = R.with_ctes(R.DATED, R.DRIVERS, R.CONSTRUCTORS, R.CIRCUITS) + """
, full_rows AS (SELECT raceId, driverId, constructorId, circuitId, year, driverRef, nationality, constructors.name AS constructorName, country,
   CAST(grid AS DOUBLE) AS grid, CAST(laps AS DOUBLE) AS laps, fastestLapSpeed, CAST(positionOrder AS DOUBLE) AS positionOrder,
   CASE WHEN positionOrder <= 3 THEN 1 ELSE 0 END AS is_podium,
   count(raceId) OVER (PARTITION BY driverId) AS driver_experience, count(raceId) OVER (PARTITION BY constructorId) AS constructor_experience,
   CASE WHEN laps > 0 AND milliseconds IS NOT NULL THEN milliseconds / laps END AS pace_ms_per_lap
 FROM dated LEFT JOIN drivers USING (driverId) LEFT JOIN constructors USING (constructorId) LEFT JOIN circuits USING (circuitId))"""
_INT_COLS = ["raceId", "driverId", "constructorId", "circuitId", "year", "driverRef", "nationality", "constructorName", "country",
             "grid", "laps", "is_podium", "driver_experience", "constructor_experience", "pace_ms_per_lap"]


@query("feat_integrated", _INT + f"SELECT {', '.join(_INT_COLS)} FROM full_rows")
def feat_integrated(spark, sf):
    return P.add_base_features(integrated(spark, sf)).select(*_INT_COLS)


_PRIM = [*P.PRIMARY_FEATURES, "is_podium", "positionOrder"]


@query("feat_primary", _INT + f"SELECT {', '.join(_PRIM)} FROM full_rows WHERE fastestLapSpeed IS NOT NULL AND pace_ms_per_lap IS NOT NULL")
def feat_primary(spark, sf):
    return P.primary_table(P.add_base_features(integrated(spark, sf)))


@query("win_group_count", _RES + """SELECT raceId, driverId, count(raceId) OVER (PARTITION BY driverId) AS driver_experience,
  count(raceId) OVER (PARTITION BY constructorId) AS constructor_experience FROM results""")
def win_group_count(spark, sf):
    return P.add_base_features(R.results(spark, sf)).select("raceId", "driverId", "driver_experience", "constructor_experience")


@query("feat_season_points", R.with_ctes(R.DATED, R.DRIVERS) + """SELECT raceId, driverId, year(CAST(date AS DATE)) - year(CAST(dob AS DATE)) AS driver_age,
  CASE WHEN points <> 7 THEN sum(nullif(points, 7)) OVER (PARTITION BY year, driverId ORDER BY raceId) END AS season_points
FROM dated JOIN drivers USING (driverId)""")
def feat_season_points(spark, sf):
    rows = R.results(spark, sf).withColumns({"points": F.when(F.col("points") != 7, F.col("points")), "rowId": F.col("raceId")})
    out = P.season_points(rows, R.races(spark, sf), R.drivers(spark, sf))
    return out.select("raceId", "driverId", F.col("driver_age").cast("bigint").alias("driver_age"), "season_points")




@query("feat_race_level", _FIN + f""", r AS (SELECT raceId, grid, round, year FROM fin)
SELECT raceId, {_sql_multi(['grid', 'year', 'round'], _FIVE, 'r', 'raceId')}, count(*) AS _rows__sum,
  round(stddev_samp(grid) / (abs(avg(grid)) + 1e-6), 9) AS grid_cv FROM r GROUP BY raceId""")
def feat_race_level(spark, sf):
    rows = fin(spark, sf).select("raceId", "grid", "year", "round", "target_ms", "laps_actual")
    return R.rounded(_round_std(P.race_level(rows)), {"grid_cv": 9})
