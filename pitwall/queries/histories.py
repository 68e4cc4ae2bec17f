"""History features and the composite builders, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.operators import history as H
from pitwall.operators.sampling import RACE_ORDER
from pitwall.operators.scan import prefix_scan
from pitwall.plans import features as P
from pitwall.queries import query
from pitwall.queries import roles as R
from pitwall.session import materialise

ORDER = [*RACE_ORDER, "driverId"]
SLICES = ["year", "round"]
T = "year, round, raceId, driverId"

_CLS = R.with_ctes(R.DATED, f"""cls AS (
  SELECT grid, year, round, circuitId, driverId, constructorId, raceId,
         CASE WHEN points > 0 THEN 1 ELSE 0 END AS target_cls FROM dated WHERE year >= 1996)""")


def _sql_cls_history() -> str:
    cols = []
    for key, name in P.ENTITIES:
        w = f"PARTITION BY {key} ORDER BY {T} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        cols.append(f"round(coalesce(avg(target_cls) OVER ({w}), (SELECT avg(target_cls) FROM cls)), 8) AS {name}_prev_rate")
        cols.append(f"row_number() OVER (PARTITION BY {key} ORDER BY {T}) - 1 AS {name}_prev_count")
    return _CLS + "SELECT *, " + ", ".join(cols) + " FROM cls"


def cls_input(spark, sf):
    return P.classification_input(R.results(spark, sf, R.written_cars(spark, sf)), R.races(spark, sf), min_year=1996, row_key="driverId")


@query("feat_history_cls", _sql_cls_history())
def feat_history_cls(spark, sf):
    return R.rounded(cls_input(spark, sf), {f"{n}_prev_rate": 8 for _, n in P.ENTITIES})


@query("feat_model_input_cls", _sql_cls_history().replace("FROM cls", "FROM cls", 1))
def feat_model_input_cls(spark, sf):
    out = cls_input(spark, sf)
    return R.rounded(out.select(
        *P.BASE_FEATURES, "target_cls", *[f"{n}_prev_{c}" for _, n in P.ENTITIES for c in ("rate", "count")]),
        {f"{n}_prev_rate": 8 for _, n in P.ENTITIES})


# ------------------------------------------------------------ single windows

def _window_query(name: str, stats, expr: dict[str, str], digits: dict[str, int] | None = None,
                  key: str = "driverId"):
    sql = R.with_ctes(R.DATED) + f"SELECT raceId, driverId, " + ", ".join(
        f"{e} AS {a}" for a, e in expr.items()) + " FROM dated"

    @query(name, sql)
    def run(spark, sf):
        out = H.add_history(R.dated(spark, sf), [(key, stats)], ORDER, SLICES)
        return R.rounded(out.select("raceId", "driverId", *expr), digits or {})

    return run


def _over(key: str, frame: str = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING") -> str:
    return f"OVER (PARTITION BY {key} ORDER BY {T} {frame})"


def _sql_roll(fn: str, x: str, w: int, key: str) -> str:
    o = _over(key, f"ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING")
    return f"CASE WHEN count({x}) {o} >= {max(3, w // 3)} THEN {fn}({x}) {o} END"


_window_query("win_lag", [H.lag_of("points", "prev_points"), H.lag_of("milliseconds", "prev_ms")], {
    "prev_points": f"lag(points) {_over('driverId', '')}", "prev_ms": f"lag(milliseconds) {_over('driverId', '')}"})
_window_query("win_prev_std", [H.prev_std("laps", "laps_std")],
              {"laps_std": f"round(stddev_samp(laps) {_over('constructorId')}, 7)"}, {"laps_std": 7}, "constructorId")
_window_query("win_prev_median", [H.prev_median("laps", "laps_median")],
              {"laps_median": f"median(laps) {_over('circuitId')}"}, key="circuitId")
_window_query("win_roll_mean", [H.roll_mean("milliseconds", w, f"roll_{w}") for w in (5, 10, 30)],
              {f"roll_{w}": _sql_roll("avg", "milliseconds", w, "driverId") for w in (5, 10, 30)})
_window_query("win_roll_std", [H.roll_std("milliseconds", 10, "roll_std_10")],
              {"roll_std_10": f"round({_sql_roll('stddev_samp', 'milliseconds', 10, 'circuitId')}, 0)"},
              {"roll_std_10": 0}, "circuitId")
_window_query("win_prev_count", [H.prev_count("n_before")],
              {"n_before": f"row_number() {_over('constructorId', '')} - 1"}, key="constructorId")


@query("win_prev_mean", R.with_ctes(R.DATED) + f"""
SELECT raceId, driverId, coalesce(avg(milliseconds) {_over('driverId')},
       (SELECT avg(milliseconds) FROM dated)) AS ms_mean FROM dated""")
def win_prev_mean(spark, sf):
    d = R.dated(spark, sf)
    mean = d.agg(F.avg("milliseconds").alias("m")).scalar()
    out = H.add_history(d, [("driverId", [H.prev_mean("milliseconds", "ms_mean")])], ORDER, SLICES)
    return out.select("raceId", "driverId", F.coalesce(F.col("ms_mean"), mean).alias("ms_mean"))


@query("win_prev_count_pair", R.with_ctes(R.DATED) + f"""
SELECT raceId, driverId, row_number() {_over('driverId, circuitId', '')} - 1 AS driver_circuit_prev_count,
       round(ln(1.0 + row_number() {_over('driverId, circuitId', '')} - 1), 9) AS driver_circuit_log FROM dated""")
def win_prev_count_pair(spark, sf):
    return P.pair_experience(R.dated(spark, sf), "driverId").select(
        "raceId", "driverId", "driver_circuit_prev_count", F.round("driver_circuit_log", 9).alias("driver_circuit_log"))


@query("win_running_sum", R.with_ctes(R.DATED) + """
SELECT raceId, driverId, CASE WHEN milliseconds IS NOT NULL THEN
       sum(milliseconds) OVER (PARTITION BY year, driverId ORDER BY round, raceId) END AS season_ms FROM dated""")
def win_running_sum(spark, sf):
    d = R.dated(spark, sf)
    x = F.col("milliseconds")
    out = prefix_scan(d, keys=["year", "driverId"], order=["raceId"], slices=["round"],
                      sums={"before": F.coalesce(x, F.lit(0.0))})
    return out.select("raceId", "driverId", F.when(x.isNotNull(), F.col("before") + x).alias("season_ms"))


# ------------------------------------------------------------ composites

_QUALI = R.with_ctes(R.CARS, R.QUALIFYING) + f"""
, q AS (SELECT raceId, driverId, CAST(position AS DOUBLE) AS quali_position, {R.sql_lap_ms('q1')} AS q1_ms,
        {R.sql_lap_ms('q2')} AS q2_ms, {R.sql_lap_ms('q3')} AS q3_ms FROM qualifying)
, quali AS (SELECT raceId, driverId, quali_position, least(q1_ms, q2_ms, q3_ms) AS quali_best_ms,
        CAST(q2_ms IS NOT NULL AS INT) AS quali_has_q2, CAST(q3_ms IS NOT NULL AS INT) AS quali_has_q3,
        least(q1_ms, q2_ms, q3_ms) - min(least(q1_ms, q2_ms, q3_ms)) OVER (PARTITION BY raceId) AS quali_gap_to_pole_ms
        FROM q)"""


def quali_table(spark, sf, of=None):
    """The session times as a table of text, as they would be read from a file."""
    return materialise(R.qualifying(spark, sf, of))


@query("feat_qualifying", _QUALI + """
SELECT raceId, driverId, quali_position, round(quali_best_ms, 6) AS quali_best_ms, quali_has_q2, quali_has_q3,
       round(quali_gap_to_pole_ms, 6) AS quali_gap_to_pole_ms FROM quali""")
def feat_qualifying(spark, sf):
    return R.rounded(P.qualifying_features(quali_table(spark, sf)), {"quali_best_ms": 6, "quali_gap_to_pole_ms": 6})


@query("win_gap_to_best", _QUALI + """
SELECT raceId, driverId, round(quali_gap_to_pole_ms, 6) AS gap,
       round(greatest(least(quali_gap_to_pole_ms / (abs(quali_best_ms) + 1.0), 5), -1), 9) AS gap_pct
FROM quali WHERE quali_best_ms IS NOT NULL""")
def win_gap_to_best(spark, sf):
    q = P.qualifying_features(quali_table(spark, sf)).withColumn("grid", F.lit(1))
    out = P.quali_derived(q).where(F.col("quali_best_ms").isNotNull())
    return out.select("raceId", "driverId", F.round("quali_gap_to_pole_ms", 6).alias("gap"),
                      F.round("quali_gap_pct", 9).alias("gap_pct"))


_IN_RACE = """
, g AS (SELECT *, avg(quali_best_ms) OVER w AS m, stddev_samp(quali_best_ms) OVER w AS s,
        min(quali_best_ms) OVER w AS lo, max(quali_best_ms) OVER w AS hi FROM quali WINDOW w AS (PARTITION BY raceId))
, in_race AS (SELECT raceId, driverId,
        greatest(least(coalesce((quali_best_ms - m) / nullif(s, 0), 0.0), 5.0), -5.0) AS quali_zscore_in_race,
        greatest(least(coalesce((quali_best_ms - lo) / nullif(hi - lo, 0), 0.0), 1.0), 0.0) AS quali_rank_pct_in_race
        FROM g)"""


def _in_race(spark, sf):
    return P.quali_in_race(P.qualifying_features(quali_table(spark, sf)))


@query("win_zscore", _QUALI + _IN_RACE + "SELECT raceId, driverId, round(quali_zscore_in_race, 6) AS z FROM in_race")
def win_zscore(spark, sf):
    return _in_race(spark, sf).select("raceId", "driverId", F.round("quali_zscore_in_race", 6).alias("z"))


@query("win_minmax_pct", _QUALI + _IN_RACE + "SELECT raceId, driverId, round(quali_rank_pct_in_race, 9) AS pct FROM in_race")
def win_minmax_pct(spark, sf):
    return _in_race(spark, sf).select("raceId", "driverId", F.round("quali_rank_pct_in_race", 9).alias("pct"))


@query("feat_quali_in_race", _QUALI + _IN_RACE + """
SELECT raceId, driverId, round(quali_zscore_in_race, 6) AS quali_zscore_in_race,
       round(quali_rank_pct_in_race, 9) AS quali_rank_pct_in_race FROM in_race""")
def feat_quali_in_race(spark, sf):
    return R.rounded(_in_race(spark, sf).select("raceId", "driverId", "quali_zscore_in_race", "quali_rank_pct_in_race"),
                     {"quali_zscore_in_race": 6, "quali_rank_pct_in_race": 9})


def _sql_standings(table: str, key: str, p: str) -> str:
    lags = ", ".join(f"lag({c}) OVER (PARTITION BY {key} ORDER BY year, round, raceId) AS {n}"
                     for c, n in (("points", "p"), ("CAST(position AS DOUBLE)", "o"), ("CAST(wins AS DOUBLE)", "w")))
    return (f"{p}_lag AS (SELECT raceId, {key}, {lags} FROM {table} JOIN races USING (raceId)), "
            f"{p}_prev AS (SELECT raceId, {key}, coalesce(p, 0) AS {p}_points_prev, "
            f"coalesce(o, (SELECT median(o) FROM {p}_lag)) AS {p}_pos_prev, coalesce(w, 0) AS {p}_wins_prev FROM {p}_lag)")


_DRV_PREV = _sql_standings("driver_standings", "driverId", "drv")
_CONS_PREV = _sql_standings("team_standings", "constructorId", "cons")


@query("feat_standings_driver", R.with_ctes(R.RACES, R.CARS, R.DRIVER_STANDINGS, _DRV_PREV) + "SELECT * FROM drv_prev")
def feat_standings_driver(spark, sf):
    return P.driver_standings_before(R.driver_standings(spark, sf), R.races(spark, sf))


@query("feat_standings_team", R.with_ctes(R.RACES, R.CARS, R.TEAM_STANDINGS, _CONS_PREV) + "SELECT * FROM cons_prev")
def feat_standings_team(spark, sf):
    return P.team_standings_before(R.team_standings(spark, sf, R.written_cars(spark, sf)), R.races(spark, sf))


@query("feat_standings_rate", R.with_ctes(R.RACES, R.CARS, R.DRIVER_STANDINGS, _DRV_PREV) + """
SELECT raceId, driverId, round(drv_points_prev / greatest(round - 1, 1), 9) AS drv_points_per_round_prev,
       round(drv_wins_prev / greatest(round - 1, 1), 9) AS drv_wins_per_round_prev
FROM drv_prev JOIN races USING (raceId)""")
def feat_standings_rate(spark, sf):
    r = R.races(spark, sf)
    rows = P.driver_standings_before(R.driver_standings(spark, sf), r).join(r.select("raceId", "round"), "raceId")
    out = P.standings_rates(rows).select("raceId", "driverId", "drv_points_per_round_prev", "drv_wins_per_round_prev")
    return R.rounded(out, {"drv_points_per_round_prev": 9, "drv_wins_per_round_prev": 9})


# The regression input, built stage by stage in SQL.  Targets are used as they are;
# the outputs keep about ten significant digits.
_FIN = R.with_ctes(R.DATED, """fin AS (
  SELECT grid, year, round, circuitId, driverId, constructorId, raceId, milliseconds AS target_ms,
         CAST(laps AS DOUBLE) AS laps_actual
  FROM dated WHERE year >= 1996 AND statusId = 1 AND milliseconds IS NOT NULL AND laps BETWEEN 10 AND 100
    AND milliseconds BETWEEN 600000 AND 20000000 AND milliseconds / laps BETWEEN 40000 AND 250000)""")

_CTX = """
, fld AS (SELECT f.*, n AS n_drivers_race,
     greatest(least(coalesce((CAST(grid AS DOUBLE) - 1) / nullif(n - 1, 0), 0.5), 1.0), 0.0) AS grid_pct_in_race
   FROM fin f JOIN (SELECT raceId, count(DISTINCT driverId) AS n FROM fin GROUP BY raceId) USING (raceId))"""

_TGT = _CTX + f"""
, exp_laps AS (SELECT *, coalesce(median(laps_actual) {_over('circuitId')},
       (SELECT median(laps_actual) FROM fld)) AS laps_expected FROM fld)
, tgt AS (SELECT *, target_ms / laps_expected AS target_reg, greatest(least(laps_expected, 100), 10) AS laps
     FROM exp_laps WHERE target_ms / laps_expected BETWEEN 40000 AND 250000)"""

_CAL = """
, cal AS (SELECT t.*, round / CAST(last AS DOUBLE) AS season_progress,
     CASE WHEN year BETWEEN 1999 AND 2005 THEN 0 WHEN year > 2005 AND year <= 2010 THEN 1
          WHEN year > 2010 AND year <= 2014 THEN 2 WHEN year > 2014 AND year <= 2017 THEN 3
          WHEN year > 2017 AND year <= 2021 THEN 4 WHEN year > 2021 AND year <= 2025 THEN 5 ELSE 0 END AS era_bin
   FROM tgt t JOIN (SELECT year, max(round) AS last FROM tgt GROUP BY year) USING (year))"""

_BASE = _TGT + _CAL + f"""
, bas AS (SELECT *, coalesce(avg(target_reg) {_over('circuitId')}, (SELECT avg(target_reg) FROM cal)) AS circuit_baseline_pace
     FROM cal)
, res AS (SELECT *, target_reg - circuit_baseline_pace AS target_resid FROM bas)"""

_DRIFT = _BASE + """
, rl AS (SELECT year, round, raceId, avg(target_reg) AS p, avg(target_resid) AS r FROM res GROUP BY ALL)
, trend AS (SELECT year, round, raceId, coalesce(avg(p) OVER w, (SELECT avg(target_reg) FROM res)) AS season_prev_mean_pace,
       coalesce(avg(r) OVER w, 0.0) AS season_prev_mean_resid FROM rl
     WINDOW w AS (PARTITION BY year ORDER BY round, raceId ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def fin(spark, sf):
    """Finished results as a written table: every feature below reads it more than once."""
    return materialise(P.finishers(R.results(spark, sf), R.races(spark, sf), 1996, row_key="driverId"))


def _target(spark, sf):
    return P.target_pace(P.field_context(fin(spark, sf)), row_key="driverId")


@query("feat_race_context", _FIN + _CTX.replace(", fld", ", fld", 1) + """
, tgt AS (SELECT * FROM fld)""" + _CAL + f"""
SELECT raceId, driverId, n_drivers_race, round(grid_pct_in_race, 9) AS grid_pct_in_race,
       round(season_progress, 9) AS season_progress, era_bin,
       row_number() {_over('driverId, circuitId', '')} - 1 AS driver_circuit_prev_count FROM cal""")
def feat_race_context(spark, sf):
    out = P.race_context(fin(spark, sf), "driverId").select(
        "raceId", "driverId", "n_drivers_race", "grid_pct_in_race", "season_progress", "era_bin", "driver_circuit_prev_count")
    return R.rounded(out, {"grid_pct_in_race": 9, "season_progress": 9})


@query("win_group_nunique", _FIN + _CTX + "SELECT raceId, driverId, n_drivers_race FROM fld")
def win_group_nunique(spark, sf):
    return P.field_context(fin(spark, sf)).select("raceId", "driverId", "n_drivers_race")


@query("win_rank_pct", _FIN + _CTX + "SELECT raceId, driverId, round(grid_pct_in_race, 9) AS grid_pct_in_race FROM fld")
def win_rank_pct(spark, sf):
    return P.field_context(fin(spark, sf)).select("raceId", "driverId", F.round("grid_pct_in_race", 9).alias("grid_pct_in_race"))


@query("win_group_max_ratio", R.with_ctes(R.RACES) + """
SELECT raceId, round(round / CAST(max(round) OVER (PARTITION BY year) AS DOUBLE), 9) AS season_progress FROM races""")
def win_group_max_ratio(spark, sf):
    return P.calendar_context(R.races(spark, sf)).select("raceId", F.round("season_progress", 9).alias("season_progress"))


@query("feat_target_pace", _FIN + _TGT + """
SELECT raceId, driverId, laps_expected, laps, round(target_reg, 4) AS target_reg FROM tgt""")
def feat_target_pace(spark, sf):
    return R.rounded(_target(spark, sf).select("raceId", "driverId", "laps_expected", "laps", "target_reg"), {"target_reg": 4})


def _baseline(spark, sf):
    return P.baseline_residual(P.calendar_context(materialise(_target(spark, sf))), "driverId")


@query("feat_baseline_residual", _FIN + _BASE + """
SELECT raceId, driverId, round(circuit_baseline_pace, 1) AS circuit_baseline_pace, round(target_resid, 1) AS target_resid FROM res""")
def feat_baseline_residual(spark, sf):
    return R.rounded(_baseline(spark, sf).select("raceId", "driverId", "circuit_baseline_pace", "target_resid"),
                     {"circuit_baseline_pace": 1, "target_resid": 1})


@query("agg_trend_level", _FIN + _DRIFT + "SELECT year, round, raceId, round(p, 1) AS race_mean_pace, round(r, 1) AS race_mean_resid FROM rl")
def agg_trend_level(spark, sf):
    return _baseline(spark, sf).groupBy(*RACE_ORDER).agg(
        F.round(F.avg("target_reg"), 1).alias("race_mean_pace"), F.round(F.avg("target_resid"), 1).alias("race_mean_resid"))


@query("win_season_trend", _FIN + _DRIFT + """
SELECT year, round, raceId, round(season_prev_mean_pace, 1) AS season_prev_mean_pace,
       round(season_prev_mean_resid, 1) AS season_prev_mean_resid FROM trend""")
def win_season_trend(spark, sf):
    return R.rounded(P.season_trend(materialise(_baseline(spark, sf))), {"season_prev_mean_pace": 1, "season_prev_mean_resid": 1})


@query("feat_season_drift", _FIN + _DRIFT + """
SELECT raceId, driverId, round(season_prev_mean_pace, 1) AS season_prev_mean_pace,
       round(season_prev_mean_resid, 1) AS season_prev_mean_resid FROM res JOIN trend USING (raceId)""")
def feat_season_drift(spark, sf):
    out = P.season_drift(materialise(_baseline(spark, sf))).select("raceId", "driverId", "season_prev_mean_pace", "season_prev_mean_resid")
    return R.rounded(out, {"season_prev_mean_pace": 1, "season_prev_mean_resid": 1})


def _sql_pace_history(src: str, resid: bool) -> tuple[list[str], dict[str, int]]:
    cols, digits = [], {}
    for key, name in P.ENTITIES:
        def add(alias, expr, default, d, n=name):
            digits[f"{n}_{alias}"] = d
            cols.append(f"round(coalesce({expr}, {default}), {d}) AS {n}_{alias}")
        mean = f"(SELECT avg(target_reg) FROM {src})"
        add("prev_pace_mean", f"avg(target_reg) {_over(key)}", mean, 3)
        cols.append(f"row_number() {_over(key, '')} - 1 AS {name}_prev_pace_count")
        add("log_exp", f"ln(CAST(row_number() {_over(key, '')} AS DOUBLE))", "0.0", 9)
        for w in (5, 10, 30):
            add(f"pace_roll_mean_{w}", _sql_roll("avg", "target_reg", w, key), mean, 3)
        if resid:
            add("prev_resid_mean", f"avg(target_resid) {_over(key)}", f"(SELECT avg(target_resid) FROM {src})", 3)
            add("prev_resid_std", f"stddev_samp(target_resid) {_over(key)}", "0.0", 0)
            add("resid_roll_mean_10", _sql_roll("avg", "target_resid", 10, key), "0.0", 3)
            add("resid_roll_std_10", _sql_roll("stddev_samp", "target_resid", 10, key), "0.0", 0)
    return cols, digits


_REG_COLS, _REG_DIGITS = _sql_pace_history("res", True)


@query("feat_history_reg", _FIN + _BASE + "SELECT raceId, driverId, " + ", ".join(_REG_COLS) + " FROM res")
def feat_history_reg(spark, sf):
    out = P.regression_history(materialise(_baseline(spark, sf)), "driverId")
    return R.rounded(out.select("raceId", "driverId", *_REG_DIGITS, *[f"{n}_prev_pace_count" for _, n in P.ENTITIES]), _REG_DIGITS)


_ROLLS = [(key, p, w) for (key, _), p in zip(P.ENTITIES, ("drv", "cons", "cir")) for w in (5, 10)]


def _sql_quali_rolls(src: str) -> str:
    return ", ".join(
        f"round(coalesce({_sql_roll('avg', 'quali_best_ms', w, key)}, (SELECT median(quali_best_ms) FROM {src})), 3) AS {p}_quali_roll_mean_{w}"
        for key, p, w in _ROLLS)


@query("feat_quali_rolls", _QUALI.replace("WITH ", "WITH " + R.RACES + ",\n", 1) + f"""
, qd AS (SELECT q.*, c.team AS constructorId, year, round, circuitId FROM quali q JOIN races USING (raceId)
         JOIN cars c ON c.l_orderkey = q.raceId AND c.l_suppkey = q.driverId)
SELECT raceId, driverId, {_sql_quali_rolls('qd')} FROM qd""")
def feat_quali_rolls(spark, sf):
    c = R.written_cars(spark, sf)
    q = P.qualifying_features(quali_table(spark, sf, c)).join(R.races(spark, sf), "raceId").join(
        R.results(spark, sf, c).select("raceId", "driverId", "constructorId"), ["raceId", "driverId"])
    names = [f"{p}_quali_roll_mean_{w}" for _, p, w in _ROLLS]
    return R.rounded(P.quali_rolls(materialise(q), "driverId").select("raceId", "driverId", *names), {n: 3 for n in names})


def reg_input(spark, sf):
    c = R.written_cars(spark, sf)
    return P.regression_input(
        R.results(spark, sf, c), R.races(spark, sf), quali_table(spark, sf, c), R.driver_standings(spark, sf, c),
        R.team_standings(spark, sf, c), min_year=1996, row_key="driverId")


_REG_SQL = (_FIN + ", " + R.QUALIFYING + ",\n" + R.DRIVER_STANDINGS + ",\n" + R.TEAM_STANDINGS
            + _QUALI.split(R.QUALIFYING)[1] + ",\n" + _DRV_PREV + ",\n" + _CONS_PREV
            + _DRIFT + """
, j AS (SELECT res.*, season_prev_mean_pace, season_prev_mean_resid, quali_position, quali_best_ms,
          coalesce(quali_has_q2, 0) AS quali_has_q2, coalesce(quali_has_q3, 0) AS quali_has_q3, quali_gap_to_pole_ms,
          drv_points_prev, drv_pos_prev, drv_wins_prev, cons_points_prev, cons_pos_prev, cons_wins_prev
        FROM res JOIN trend USING (raceId) LEFT JOIN quali USING (raceId, driverId)
        LEFT JOIN drv_prev USING (raceId, driverId) LEFT JOIN cons_prev USING (raceId, constructorId))
, jw AS (SELECT *, avg(quali_best_ms) OVER w AS m, stddev_samp(quali_best_ms) OVER w AS s,
          min(quali_best_ms) OVER w AS lo, max(quali_best_ms) OVER w AS hi FROM j WINDOW w AS (PARTITION BY raceId))
SELECT raceId, year, round, circuitId, driverId, constructorId, grid, target_ms, laps_actual, laps_expected, laps,
  n_drivers_race, era_bin, round(grid_pct_in_race, 9) AS grid_pct_in_race, round(season_progress, 9) AS season_progress,
  round(target_reg, 4) AS target_reg, round(circuit_baseline_pace, 1) AS circuit_baseline_pace,
  round(target_resid, 1) AS target_resid, round(season_prev_mean_pace, 1) AS season_prev_mean_pace,
  round(season_prev_mean_resid, 1) AS season_prev_mean_resid, quali_position, round(quali_best_ms, 6) AS quali_best_ms,
  quali_has_q2, quali_has_q3, round(quali_gap_to_pole_ms, 6) AS quali_gap_to_pole_ms,
  drv_points_prev, drv_pos_prev, drv_wins_prev, cons_points_prev, cons_pos_prev, cons_wins_prev,
  round(CASE WHEN quali_gap_to_pole_ms IS NOT NULL THEN
        greatest(least(quali_gap_to_pole_ms / (abs(quali_best_ms) + 1.0), 5.0), -1.0) END, 9) AS quali_gap_pct,
  CASE WHEN quali_position IS NOT NULL THEN greatest(least(grid - quali_position, 40.0), -40.0) END AS grid_minus_quali,
  round(drv_points_prev / greatest(round - 1, 1), 9) AS drv_points_per_round_prev,
  round(drv_wins_prev / greatest(round - 1, 1), 9) AS drv_wins_per_round_prev,
  round(cons_points_prev / greatest(round - 1, 1), 9) AS cons_points_per_round_prev,
  round(cons_wins_prev / greatest(round - 1, 1), 9) AS cons_wins_per_round_prev,
  driverId || '_' || constructorId AS driver_constructor,
  round(greatest(least(coalesce((quali_best_ms - m) / nullif(s, 0), 0.0), 5.0), -5.0), 6) AS quali_zscore_in_race,
  round(greatest(least(coalesce((quali_best_ms - lo) / nullif(hi - lo, 0), 0.0), 1.0), 0.0), 9) AS quali_rank_pct_in_race,
  """ + f"row_number() {_over('driverId, circuitId', '')} - 1 AS driver_circuit_prev_count, "
            + f"round(ln(CAST(row_number() {_over('driverId, circuitId', '')} AS DOUBLE)), 9) AS driver_circuit_log, "
            + _sql_quali_rolls("j") + ", " + ", ".join(c.replace("FROM res", "FROM j") for c in _REG_COLS) + " FROM jw")


@query("feat_model_input_reg", _REG_SQL)
def feat_model_input_reg(spark, sf):
    return R.rounded(reg_input(spark, sf), {
        **_REG_DIGITS, **{f"{p}_quali_roll_mean_{w}": 3 for _, p, w in _ROLLS},
        "grid_pct_in_race": 9, "season_progress": 9, "target_reg": 4, "circuit_baseline_pace": 1, "target_resid": 1,
        "season_prev_mean_pace": 1, "season_prev_mean_resid": 1, "quali_best_ms": 6, "quali_gap_to_pole_ms": 6,
        "quali_gap_pct": 9, "drv_points_per_round_prev": 9, "drv_wins_per_round_prev": 9,
        "cons_points_per_round_prev": 9, "cons_wins_per_round_prev": 9, "quali_zscore_in_race": 6,
        "quali_rank_pct_in_race": 9, "driver_circuit_log": 9})
