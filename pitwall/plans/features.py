"""Composite feature builders: raw event tables in, model inputs out.

Each builder is a lazy DataFrame function.  ``row_key`` is the unique tie-break
inside a race; it stands for the order of the rows in the file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions import scalars as S
from pitwall.operators import aggregates as A
from pitwall.operators import history as H
from pitwall.operators.columns import numeric_columns
from pitwall.operators.contracts import require_columns
from pitwall.operators.quantiles import global_stats, grouped_agg, scalar_of
from pitwall.operators.sampling import RACE_ORDER
from pitwall.operators.scan import cut_slices, group_sizes, prefix_scan
from pitwall.session import ROWS_PER_TASK, materialise

# The output lists of the builders.
BASE_FEATURES = ["grid", "year", "round", "circuitId", "driverId", "constructorId", "raceId"]
PRIMARY_FEATURES = ["grid", "laps", "fastestLapSpeed", "driver_experience",
                    "constructor_experience", "pace_ms_per_lap"]
# Plausible ranges of a finished race.
LAPS_RANGE = (10, 100)
TOTAL_MS_RANGE = (600_000, 20_000_000)
PACE_RANGE = (40_000, 250_000)

ENTITIES = [("driverId", "driver"), ("constructorId", "constructor"), ("circuitId", "circuit")]
SLICES = ["year", "round"]
Sizes = dict[str, int] | None


# ---------------------------------------------------------------- integrated

def integrate(results: DataFrame, races: DataFrame, drivers: DataFrame,
              constructors: DataFrame, circuits: DataFrame) -> DataFrame:
    """Star join around the results; the planner broadcasts dimensions that are small."""
    return (results
            .join(races.select("raceId", S.whole(races, "year").alias("year"), "circuitId"), "raceId")
            .join(drivers.select("driverId", "driverRef", "nationality"), "driverId", "left")
            .join(constructors.select("constructorId", F.col("name").alias("constructorName")),
                  "constructorId", "left")
            .join(circuits.select("circuitId", "country"), "circuitId", "left"))


def add_base_features(df: DataFrame) -> DataFrame:
    """Podium flag, career sizes (whole table) and pace per lap."""
    numeric = {c: S.number(df, c) for c in ("positionOrder", "grid", "laps", "milliseconds", "fastestLapSpeed")
               if c in df.columns}
    typed = df.withColumns(numeric)
    for key, name in (("driverId", "driver_experience"), ("constructorId", "constructor_experience")):
        typed = A.group_back(typed, [key], [F.count("raceId").alias(name)])
    return typed.withColumns({
        "is_podium": S.flag(F.col("positionOrder") <= 3),
        "pace_ms_per_lap": F.when((F.col("laps") > 0) & F.col("milliseconds").isNotNull(),
                                  F.col("milliseconds") / F.nullif(F.col("laps"), F.lit(0.0)))})


def primary_table(df: DataFrame) -> DataFrame:
    return df.select(*PRIMARY_FEATURES, "is_podium", "positionOrder").dropna()


def season_points(results: DataFrame, races: DataFrame, drivers: DataFrame,
                  row_key: str = "rowId") -> DataFrame:
    """Results with race, driver age and running points of the season (in row order)."""
    joined = (results.join(races, "raceId", "left").join(drivers, "driverId", "left")
              .withColumns({"date": S.to_day("date"), "dob": S.to_day("dob")})
              .withColumn("driver_age", S.age_years("date", "dob")))
    running = prefix_scan(joined, keys=["year", "driverId"], order=[row_key],
                          slices=[F.floor(F.col(row_key) / 1_000_000)],
                          sums={"__before": F.coalesce(F.col("points"), F.lit(0.0))})
    # a missing value stays missing and does not break the sum
    return running.withColumn("season_points", F.when(
        F.col("points").isNotNull(), F.col("__before") + F.col("points"))).drop("__before")


# ---------------------------------------------------------------- side tables

def qualifying_features(qualifying: DataFrame) -> DataFrame:
    """Session times in ms, best of three, session flags, gap to the race's best."""
    require_columns(qualifying, ["raceId", "driverId", "position", "q1", "q2", "q3"], "qualifying")
    times = qualifying.select(
        S.whole(qualifying, "raceId").alias("raceId"), S.whole(qualifying, "driverId").alias("driverId"),
        S.number(qualifying, "position").alias("quali_position"),
        *[S.lap_time_ms(q).alias(f"{q}_ms") for q in ("q1", "q2", "q3")])
    best = times.select(
        "raceId", "driverId", "quali_position",
        S.row_min("q1_ms", "q2_ms", "q3_ms").alias("quali_best_ms"),
        S.present_flag("q2_ms").alias("quali_has_q2"),
        S.present_flag("q3_ms").alias("quali_has_q3"),
    ).dropna(subset=["raceId", "driverId"])
    with_pole = A.group_back(best, ["raceId"], [F.min("quali_best_ms").alias("pole_ms")])
    return with_pole.select(
        "raceId", "driverId", "quali_position", "quali_best_ms", "quali_has_q2", "quali_has_q3",
        (F.col("quali_best_ms") - F.col("pole_ms")).alias("quali_gap_to_pole_ms"))


def standings_before(standings: DataFrame, races: DataFrame, key: str, prefix: str) -> DataFrame:
    """Standings after the previous race of the entity, over season borders.

    A first race has 0 points and wins; its position is the median of all others.
    """
    require_columns(standings, ["raceId", key, "points", "position", "wins"], "standings")
    typed = standings.select(
        S.whole(standings, "raceId").alias("raceId"), S.whole(standings, key).alias(key),
        *[S.number(standings, c).alias(c) for c in ("points", "position", "wins")])
    typed = typed.where(F.col(key).isNotNull())
    sizes = group_sizes(typed, [key])
    dated = typed.join(races.select("raceId", "year", "round"), "raceId", "left")
    lagged = H.add_history(dated, [(key, [
        H.lag_of("points", f"{prefix}_points_prev"), H.lag_of("position", f"{prefix}_pos_prev"),
        H.lag_of("wins", f"{prefix}_wins_prev")])], RACE_ORDER, SLICES, sizes=sizes)
    # written, as the median below would run the histories a second time
    out = materialise(lagged.select("raceId", key, *[f"{prefix}_{c}_prev" for c in ("points", "pos", "wins")]))
    median = global_stats(out, medians={"m": f"{prefix}_pos_prev"}, sizes=sizes).scalar()
    return out.withColumns({
        f"{prefix}_points_prev": F.coalesce(f"{prefix}_points_prev", F.lit(0.0)),
        f"{prefix}_pos_prev": F.coalesce(F.col(f"{prefix}_pos_prev"), median),
        f"{prefix}_wins_prev": F.coalesce(f"{prefix}_wins_prev", F.lit(0.0))})


def driver_standings_before(standings: DataFrame, races: DataFrame) -> DataFrame:
    return standings_before(standings, races, "driverId", "drv")


def team_standings_before(standings: DataFrame, races: DataFrame) -> DataFrame:
    return standings_before(standings, races, "constructorId", "cons")


# ---------------------------------------------------------------- histories

def classification_history(df: DataFrame, row_key: str = "rowId") -> DataFrame:
    """Earlier success rate and number of earlier rows for driver, team and circuit."""
    require_columns(df, [*RACE_ORDER, *[k for k, _ in ENTITIES], "target_cls", row_key])
    rate = df.agg(F.avg("target_cls").alias("m")).scalar()
    out = H.add_history(df, [
        (key, [H.prev_mean("target_cls", f"{name}_prev_rate"), H.prev_count(f"{name}_prev_count")])
        for key, name in ENTITIES], [*RACE_ORDER, row_key], SLICES)
    return out.withColumn("__rate", rate).withColumns({
        f"{n}_prev_rate": F.coalesce(F.col(f"{n}_prev_rate"), F.col("__rate")) for _, n in ENTITIES}).drop("__rate")


def _pace_stats(name: str, resid: bool) -> list[H.Stat]:
    stats = [H.prev_mean("target_reg", f"{name}_prev_pace_mean"), H.prev_count(f"{name}_prev_pace_count"),
             *[H.roll_mean("target_reg", w, f"{name}_pace_roll_mean_{w}") for w in (5, 10, 30)]]
    if resid:
        stats += [H.prev_mean("target_resid", f"{name}_prev_resid_mean"),
                  H.prev_std("target_resid", f"{name}_prev_resid_std"),
                  H.roll_mean("target_resid", 10, f"{name}_resid_roll_mean_10"),
                  H.roll_std("target_resid", 10, f"{name}_resid_roll_std_10")]
    return stats


def _pace_defaults(out: DataFrame, means, resid: bool) -> DataFrame:
    """Global means where an entity has no past; zero for residual spread and rolls."""
    out = out.withColumn("__g", means)
    filled = {}
    for _, name in ENTITIES:
        for c in (f"{name}_prev_pace_mean", *[f"{name}_pace_roll_mean_{w}" for w in (5, 10, 30)]):
            filled[c] = F.coalesce(F.col(c), F.col("__g.pace"))
        filled[f"{name}_log_exp"] = F.log1p(F.col(f"{name}_prev_pace_count"))
        if resid:
            filled[f"{name}_prev_resid_mean"] = F.coalesce(F.col(f"{name}_prev_resid_mean"), F.col("__g.resid"))
            for c in (f"{name}_prev_resid_std", f"{name}_resid_roll_mean_10", f"{name}_resid_roll_std_10"):
                filled[c] = F.coalesce(F.col(c), F.lit(0.0))
    return out.withColumns(filled).drop("__g")


def regression_history(df: DataFrame, row_key: str = "rowId") -> DataFrame:
    """Pace and residual histories: one window pass per entity."""
    require_columns(df, [*RACE_ORDER, *[k for k, _ in ENTITIES], "target_reg", row_key])
    resid = "target_resid" in df.columns
    if resid:
        df = df.withColumn("target_resid", F.coalesce(F.col("target_resid"), F.lit(0.0)))
    means = scalar_of(df.agg(F.avg("target_reg").alias("pace"),
                             *([F.avg("target_resid").alias("resid")] if resid else [])))
    out = H.add_history(df, [(key, _pace_stats(name, resid)) for key, name in ENTITIES],
                        [*RACE_ORDER, row_key], SLICES)
    return _pace_defaults(out, means, resid)


_QUALI_PREFIX = {"driver": "drv", "constructor": "cons", "circuit": "cir"}


def _quali_stats(name: str) -> list[H.Stat]:
    return [H.roll_mean("quali_best_ms", w, f"{_QUALI_PREFIX[name]}_quali_roll_mean_{w}") for w in (5, 10)]


def _quali_defaults(out: DataFrame, median) -> DataFrame:
    return out.withColumns({c: F.coalesce(F.col(c), median) for p in _QUALI_PREFIX.values()
                            for c in (f"{p}_quali_roll_mean_5", f"{p}_quali_roll_mean_10")})


def quali_rolls(df: DataFrame, row_key: str = "rowId") -> DataFrame:
    """Rolling mean of the best session time; global median where history is short."""
    sizes = group_sizes(df, [key for key, _ in ENTITIES])
    median = global_stats(df, medians={"m": "quali_best_ms"}, sizes=sizes).scalar()
    out = H.add_history(df, [(key, _quali_stats(name)) for key, name in ENTITIES],
                        [*RACE_ORDER, row_key], SLICES, sizes=sizes)
    return _quali_defaults(out, median)


def quali_in_race(df: DataFrame) -> DataFrame:
    """z-score and min-max place of the best session time inside the race."""
    x = F.col("quali_best_ms")
    with_group = A.group_back(df, ["raceId"], [
        F.avg(x).alias("__mean"), F.stddev_samp(x).alias("__std"), F.min(x).alias("__lo"), F.max(x).alias("__hi")])
    z = (x - F.col("__mean")) / S.null_if("__std", 0.0)
    pct = (x - F.col("__lo")) / S.null_if(F.col("__hi") - F.col("__lo"), 0.0)
    return with_group.withColumns({
        "quali_zscore_in_race": S.clip(F.coalesce(z, F.lit(0.0)), -5.0, 5.0),
        "quali_rank_pct_in_race": S.clip(F.coalesce(pct, F.lit(0.0)), 0.0, 1.0),
    }).drop("__mean", "__std", "__lo", "__hi")


# ---------------------------------------------------------------- regression parts

def field_context(df: DataFrame) -> DataFrame:
    """Field size and the share of the field ahead on the grid."""
    sized = A.group_distinct_back(df, ["raceId"], "driverId", "n_drivers_race")
    share = (F.col("grid").cast("double") - 1) / S.null_if(F.col("n_drivers_race") - 1, 0)
    return sized.withColumn("grid_pct_in_race", S.clip(F.coalesce(share, F.lit(0.5)), 0.0, 1.0))


def calendar_context(df: DataFrame) -> DataFrame:
    """Season progress (against the last round of the table) and regulation era."""
    last = df.groupBy("year").agg(F.max("round").alias("__last"))
    progress = S.ratio("round", "__last", 0.0)
    return (df.join(last, "year", "left")
            .withColumns({"season_progress": S.clip(progress, 0.0, 1.0), "era_bin": S.interval_bin("year")})
            .drop("__last"))


def pair_experience(df: DataFrame, row_key: str = "rowId", sizes: Sizes = None) -> DataFrame:
    out = H.add_history(df, [(["driverId", "circuitId"], [H.prev_count("driver_circuit_prev_count")])],
                        [*RACE_ORDER, row_key], SLICES, sizes=sizes)
    return out.withColumn("driver_circuit_log", F.log1p(F.col("driver_circuit_prev_count")))


def race_context(df: DataFrame, row_key: str = "rowId") -> DataFrame:
    return pair_experience(calendar_context(field_context(df)), row_key)


def finishers(results: DataFrame, races: DataFrame, min_year: int = 2000, finished_id: int = 1,
              target: str = "milliseconds", row_key: str = "rowId") -> DataFrame:
    """Finished results inside the plausible ranges, with target_ms and laps_actual."""
    dated = dated_results(results, races, min_year)
    kept = [*BASE_FEATURES, *([row_key] if row_key not in BASE_FEATURES else [])]
    rows = (dated.where(F.col("statusId") == finished_id)
            .select(*kept, F.col(target).alias("target_ms"), F.col("laps").alias("laps_actual"))
            .dropna(subset=[*BASE_FEATURES, "target_ms", "laps_actual"]))
    pace = F.col("target_ms") / F.nullif(F.col("laps_actual"), F.lit(0.0))
    return rows.where(F.col("laps_actual").between(*LAPS_RANGE)
                      & F.col("target_ms").between(*TOTAL_MS_RANGE) & pace.between(*PACE_RANGE))


def dated_results(results: DataFrame, races: DataFrame, min_year: int = 2000) -> DataFrame:
    """Results with year, round and circuit, typed.  The year filter drops results
    without a race, so the join may as well be inner."""
    require_columns(results, ["raceId", "driverId", "constructorId", "grid", "points",
                              "milliseconds", "statusId", "laps"], "results")
    require_columns(races, ["raceId", "year", "round", "circuitId"], "races")
    calendar = races.select(*[S.whole(races, c).alias(c) for c in ("raceId", "year", "round", "circuitId")])
    typed = results.withColumns({
        **{c: S.whole(results, c) for c in ("raceId", "driverId", "constructorId", "statusId", "grid")},
        **{c: S.number(results, c) for c in ("points", "milliseconds", "laps")}})
    return typed.join(calendar.where(F.col("year") >= min_year), "raceId")


def target_pace(df: DataFrame, pace_denominator: str = "laps_expected", row_key: str = "rowId",
                sizes: Sizes = None) -> DataFrame:
    """Expected laps (median of the circuit's past) and the pace target built on it."""
    if pace_denominator not in ("laps_expected", "laps_actual"):
        raise ValueError(f"unknown pace_denominator {pace_denominator!r}")
    sizes = sizes if sizes is not None else group_sizes(df, ["circuitId"])
    median = global_stats(df, medians={"m": "laps_actual"}, sizes=sizes).scalar()
    past = H.add_history(df, [("circuitId", [H.prev_median("laps_actual", "laps_expected")])],
                         [*RACE_ORDER, row_key], SLICES, sizes=sizes)
    filled = past.withColumn("__m", median).withColumn(
        "laps_expected", F.coalesce(F.col("laps_expected"), F.col("__m")))
    denominator = F.coalesce(S.null_if(pace_denominator, 0.0), F.col("__m"))
    return (filled.withColumn("target_reg", F.col("target_ms") / denominator)
            .where(F.col("target_reg").between(*PACE_RANGE))
            .withColumn("laps", S.clip("laps_expected", *map(float, LAPS_RANGE))).drop("__m"))


def baseline_residual(df: DataFrame, row_key: str = "rowId", sizes: Sizes = None) -> DataFrame:
    """Circuit baseline (mean of the circuit's earlier targets) and the residual to it."""
    mean = df.agg(F.avg("target_reg").alias("m")).scalar()
    past = H.add_history(df, [("circuitId", [H.prev_mean("target_reg", "circuit_baseline_pace")])],
                         [*RACE_ORDER, row_key], SLICES, sizes=sizes)
    filled = past.withColumn("circuit_baseline_pace", F.coalesce(F.col("circuit_baseline_pace"), mean))
    return filled.withColumn("target_resid", F.coalesce(
        F.col("target_reg") - F.col("circuit_baseline_pace"), F.lit(0.0)))


def season_trend(df: DataFrame, rows_per_slice: int = ROWS_PER_TASK) -> DataFrame:
    """One row per race: mean of the season's earlier race means, pace and residual.
    Rounds of more than ``rows_per_slice`` races are cut by measured splitters."""
    races = df.groupBy(*RACE_ORDER).agg(F.avg("target_reg").alias("race_mean_pace"),
                                        F.avg("target_resid").alias("race_mean_resid"))
    cut = cut_slices(races, ["year", "round"], "raceId", name="__cut", rows_per_slice=rows_per_slice)
    placed = prefix_scan(cut, keys=["year"], order=["raceId"], slices=["round", "__cut"], count="__n",
                         sums={"__pace": "race_mean_pace", "__resid": "race_mean_resid"})
    n = F.nullif(F.col("__n"), F.lit(0))
    mean = df.agg(F.avg("target_reg").alias("m")).scalar()
    return placed.select(
        *RACE_ORDER, F.coalesce(F.col("__pace") / n, mean).alias("season_prev_mean_pace"),
        F.coalesce(F.col("__resid") / n, F.lit(0.0)).alias("season_prev_mean_resid"))


def season_drift(df: DataFrame) -> DataFrame:
    return df.join(season_trend(df).drop("year", "round"), "raceId", "left")


def standings_rates(df: DataFrame) -> DataFrame:
    """Points and wins per completed round."""
    done = F.greatest(F.col("round") - 1, F.lit(1))
    pairs = [("drv_points_prev", "drv_points_per_round_prev"), ("drv_wins_prev", "drv_wins_per_round_prev"),
             ("cons_points_prev", "cons_points_per_round_prev"), ("cons_wins_prev", "cons_wins_per_round_prev")]
    return df.withColumns({out: F.coalesce(F.col(c) / done, F.lit(0.0)) for c, out in pairs if c in df.columns})


def quali_derived(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "quali_gap_pct": S.clip(F.col("quali_gap_to_pole_ms") / (F.abs("quali_best_ms") + 1.0), -1.0, 5.0),
        "grid_minus_quali": S.clip(F.col("grid") - F.col("quali_position"), -40.0, 40.0)})


# ---------------------------------------------------------------- model inputs

def classification_input(results: DataFrame, races: DataFrame, min_year: int = 2000,
                         row_key: str = "rowId") -> DataFrame:
    """All starters since min_year: safe columns, points > 0 target, histories."""
    kept = [*BASE_FEATURES, *([row_key] if row_key not in BASE_FEATURES else [])]
    rows = (dated_results(results, races, min_year).select(*kept, "points").dropna(subset=BASE_FEATURES)
            .select(*kept, S.flag(F.col("points") > 0).alias("target_cls")))
    return classification_history(rows, row_key)


def regression_input(results: DataFrame, races: DataFrame, qualifying: DataFrame,
                     driver_standings: DataFrame, team_standings: DataFrame, *,
                     min_year: int = 2000, finished_id: int = 1, target: str = "milliseconds",
                     pace_denominator: str = "laps_expected", row_key: str = "rowId") -> DataFrame:
    """Finishers with every pre-event feature.

    The circuit's median and mean need the rows left by the filter before them,
    so they are passes of their own; all other histories share one pass per entity.
    """
    rows = finishers(results, races, min_year, finished_id, target, row_key)
    rows = (rows.join(qualifying_features(qualifying), ["raceId", "driverId"], "left")
            .join(driver_standings_before(driver_standings, races), ["raceId", "driverId"], "left")
            .join(team_standings_before(team_standings, races), ["raceId", "constructorId"], "left"))
    # Every stage below reads its input several times (group sizes, means, windows),
    # so each one starts from a written table, not from the whole lineage again.
    rows = materialise(rows)
    sizes = group_sizes(rows, [key for key, _ in ENTITIES])
    rows = materialise(target_pace(field_context(rows), pace_denominator, row_key, sizes), done=[rows])
    rows = materialise(baseline_residual(calendar_context(rows), row_key, sizes), done=[rows])

    facts = scalar_of(grouped_agg(rows, [], [F.avg("target_reg").alias("pace"), F.avg("target_resid").alias("resid")], {
        "drv_pos": ("drv_pos_prev", 0.5), "cons_pos": ("cons_pos_prev", 0.5), "quali": ("quali_best_ms", 0.5)}, sizes=sizes))
    histories = [(key, _pace_stats(name, True) + _quali_stats(name)) for key, name in ENTITIES]
    # right after the drivers: rows dealt by driver are dealt for the pairs, too
    histories.insert(1, (["driverId", "circuitId"], [H.prev_count("driver_circuit_prev_count")]))
    trend = season_trend(rows).drop("year", "round")
    in_race = quali_in_race(rows.select("raceId", row_key, "quali_best_ms")).drop("quali_best_ms")
    # whole rows are joined once, with what is known of their race and place
    beside = in_race.join(trend, "raceId", "left")
    out = H.add_history(rows, histories, [*RACE_ORDER, row_key], SLICES, sizes=sizes, steps=True)
    out = out.join(beside, ["raceId", row_key]).withColumn("__f", facts)
    out = out.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in ("quali_has_q2", "quali_has_q3")},
        **{c: F.coalesce(F.col(c), F.lit(0.0)) for c in (
            "drv_points_prev", "drv_wins_prev", "cons_points_prev", "cons_wins_prev")},
        "drv_pos_prev": F.coalesce(F.col("drv_pos_prev"), F.col("__f.drv_pos")),
        "cons_pos_prev": F.coalesce(F.col("cons_pos_prev"), F.col("__f.cons_pos")),
        "driver_circuit_log": F.log1p(F.col("driver_circuit_prev_count")),
        "driver_constructor": S.concat_key("driverId", "constructorId")})
    out = _quali_defaults(_pace_defaults(out, F.col("__f"), True), F.col("__f.quali")).drop("__f")
    return standings_rates(quali_derived(out))


# ---------------------------------------------------------------- entity levels

def race_level(model_input: DataFrame, group_key: str = "raceId",
               skip: Sequence[str] = ("rowId",)) -> DataFrame:
    """One row per race: statistics of every numeric input, targets left out."""
    require_columns(model_input, [group_key], "model input")
    banned = {"laps_actual", "true_ms", "pred_ms", *skip}
    columns = [c for c in numeric_columns(model_input, [group_key])
               if not c.startswith("target_") and c not in banned]
    out = A.multi_stat(model_input, [group_key], columns, row_count="_rows__sum")
    if "grid" in columns:
        out = out.withColumn("grid_cv", S.finite_or_null(A.variation("grid__mean", "grid__std")))
    return out


def driver_season(results: DataFrame, races: DataFrame, qualifying: DataFrame | None = None,
                  min_races: int = 5, finished_id: int = 1) -> DataFrame:
    """One row per driver and season with at least ``min_races`` races."""
    when = races.select("raceId", "year")
    by = ["driverId", "year"]
    rows = results.join(when, "raceId", "left").where(F.col("year").isNotNull())
    finish = F.col("statusId") == finished_id
    sane = finish & F.col("milliseconds").between(*TOTAL_MS_RANGE) & F.col("laps").between(*LAPS_RANGE)
    rows = rows.withColumns({
        "is_finish": S.flag(finish), "is_podium": S.flag(F.col("positionOrder") <= 3),
        "is_win": S.flag(F.col("positionOrder") == 1),
        "pace_ms_lap": F.when(sane, F.col("milliseconds") / F.nullif(F.col("laps"), F.lit(0.0)))})
    rows = materialise(rows.select(*by, "raceId", "constructorId", "points", "grid", "is_finish", "is_podium", "is_win",
                                   "pace_ms_lap"))  # read four times below
    # Distinct races on their own: next to exact medians, a distinct count would
    # carry every other aggregate through a pass per (driver, season, race).
    races_run = rows.select(*by, "raceId").distinct().groupBy(*by).agg(F.count("raceId").alias("n_races"))
    out = grouped_agg(rows, by, [
        F.sum("is_finish").alias("n_finish"),
        F.avg("is_finish").alias("finish_rate"), F.avg("is_podium").alias("podium_rate"),
        F.avg("is_win").alias("win_rate"), F.coalesce(F.sum("points"), F.lit(0.0)).alias("points_sum"),
        F.avg("points").alias("points_avg"), F.avg("grid").alias("grid_avg"),
        F.avg("pace_ms_lap").alias("pace_avg"),
    ], {"grid_median": ("grid", 0.5), "pace_median": ("pace_ms_lap", 0.5)})
    out = out.join(races_run.where(F.col("n_races") >= min_races), by)
    out = out.join(A.entity_modes(rows, by, "constructorId", "constructor_mode"), by, "left")
    if qualifying is not None:
        q = qualifying.select("raceId", "driverId", S.number(qualifying, "position").alias("position")).join(when, "raceId", "left")
        q = materialise(q.select(*by, "position"))  # read for its group sizes, too
        out = out.join(grouped_agg(q, by, [F.avg("position").alias("quali_pos_avg")],
                                   {"quali_pos_median": ("position", 0.5)}), by, "left")
    return out


def attach_labels(df: DataFrame, labels: DataFrame, key: str = "raceId") -> DataFrame:
    """The one label column of ``labels``; rows without a label get the most frequent one."""
    columns = [c for c in labels.columns if c != key]
    if len(columns) != 1:
        raise ValueError(f"labels need {key} and exactly one more column, got {labels.columns}")
    label = columns[0]
    joined = df.join(labels, key, "left")
    mode = A.entity_modes(joined, [], label, "m").scalar()
    return joined.withColumn(label, F.coalesce(F.col(label), mode, F.lit(0)).cast("int"))
