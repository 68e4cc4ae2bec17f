"""Sources, projections, filters, scalar functions, joins and sorts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pitwall.functions import scalars as S
from pitwall.operators import aggregates as A
from pitwall.operators import columns as C
from pitwall.operators import contracts as K
from pitwall.operators.quantiles import global_stats, scalar_of
from pitwall.plans import features as P
from pitwall.queries import query
from pitwall.queries import roles as R
from pitwall.session import shared_folder
from pitwall.sources import tables as IO

_RES = R.with_ctes(R.RESULTS)
_DATED = R.with_ctes(R.DATED)
_RESULT_COLS = "raceId, driverId, constructorId, grid, laps, milliseconds, statusId, points, positionOrder, fastestLapSpeed"


def _new_path(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------ sources and sinks

@query("src_csv_raw", _RES + f"SELECT {_RESULT_COLS} FROM results")
def src_csv_raw(spark, sf):
    path = _new_path(spark, "results-csv")
    R.results(spark, sf).write.csv(path, header=True, encoding="ISO-8859-1", nullValue="\\N")
    return IO.read_raw(spark, path, IO.RAW_SCHEMAS["results"])


@query("src_csv_bom", R.with_ctes(R.DRIVERS) + "SELECT * FROM drivers")
def src_csv_bom(spark, sf):
    path = _new_path(spark, "drivers-csv")
    IO.write_csv(R.drivers(spark, sf), path, bom=True)
    return IO.read_own_csv(spark, path, IO.RAW_SCHEMAS["drivers"])


@query("src_nonempty", "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders")
def src_nonempty(spark, sf):
    return K.shape(IO.load_checked(R.table(spark, sf, "orders"), "orders"))


@query("sink_csv", """SELECT doc_id, text, lang, source, n_chars FROM documents""")
def sink_csv(spark, sf):
    path = _new_path(spark, "documents-csv")
    docs = R.table(spark, sf, "documents")
    IO.write_csv(docs, path)
    return IO.read_own_csv(spark, path, docs.schema)


@query("sink_json_summary", """SELECT year(o_orderdate) AS split_year, count(*) AS split_n,
  count(DISTINCT o_custkey) AS test_customers, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS test_cents
FROM orders GROUP BY 1""")
def sink_json_summary(spark, sf):
    facts = R.table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    doc = A.summary_document(facts, {"split": ["year", "n"], "test": ["customers", "cents"]})
    path = _new_path(spark, "summary-json")
    IO.write_json_summary(doc, path)
    return IO.read_json_summary(spark, path, doc.schema)


# ------------------------------------------------------------ projections

@query("proj_select", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def proj_select(spark, sf):
    return R.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("proj_rename", "SELECT n_nationkey AS constructorId, n_name AS constructorName FROM nation")
def proj_rename(spark, sf):
    return (R.table(spark, sf, "nation").select("n_nationkey", "n_name")
            .withColumnsRenamed({"n_nationkey": "constructorId", "n_name": "constructorName"}))


@query("proj_drop_ignore", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def proj_drop_ignore(spark, sf):
    return R.table(spark, sf, "orders").drop("o_orderdate", "o_orderstatus", "not_there")


@query("proj_columns", _RES + """SELECT raceId, driverId, grid, points, fastestLapSpeed FROM results""")
def proj_columns(spark, sf):
    rows = R.results(spark, sf).withColumns({
        "target_ms": F.col("milliseconds"), "cluster_kmeans_k4": F.lit(1), "note": F.lit("text")})
    wanted = C.existing(rows, ["raceId", "driverId", "country", "grid", "lat", "points", "target_ms",
                               "cluster_kmeans_k4", "note", "fastestLapSpeed"])
    kept = C.without_prefix(rows.select(*wanted), ["target_", "cluster_kmeans_k"])
    return kept.select(*C.numeric_columns(kept))


# ------------------------------------------------------------ filters and contracts

@query("filt_compare", _DATED + "SELECT raceId, driverId, year FROM dated WHERE year >= 1998 AND nullif(grid, 1) > 2")
def filt_compare(spark, sf):
    return R.dated(spark, sf).where((F.col("year") >= 1998) & (S.null_if("grid", 1) > 2)).select("raceId", "driverId", "year")


@query("filt_range", _RES + """SELECT raceId, driverId, laps, milliseconds FROM results
  WHERE laps BETWEEN 10 AND 100 AND milliseconds BETWEEN 600000 AND 20000000 AND milliseconds / laps BETWEEN 40000 AND 250000""")
def filt_range(spark, sf):
    return R.results(spark, sf).where(
        F.col("laps").between(*P.LAPS_RANGE) & F.col("milliseconds").between(*P.TOTAL_MS_RANGE)
        & S.ratio("milliseconds", "laps").between(*P.PACE_RANGE)).select("raceId", "driverId", "laps", "milliseconds")


@query("filt_equal", _RES + "SELECT raceId, driverId, statusId FROM results WHERE statusId = 1")
def filt_equal(spark, sf):
    return R.results(spark, sf).where(F.col("statusId") == 1).select("raceId", "driverId", "statusId")


@query("filt_dropna", _RES + """SELECT raceId, driverId, milliseconds, fastestLapSpeed FROM results
  WHERE milliseconds IS NOT NULL AND fastestLapSpeed IS NOT NULL""")
def filt_dropna(spark, sf):
    return R.results(spark, sf).dropna(subset=["milliseconds", "fastestLapSpeed"]).select(
        "raceId", "driverId", "milliseconds", "fastestLapSpeed")


_ODD = """odd AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN CAST('inf' AS DOUBLE) WHEN event_id % 13 = 0 THEN CAST('nan' AS DOUBLE)
  WHEN event_id % 17 = 0 THEN CAST('-inf' AS DOUBLE) WHEN event_id % 7 = 0 THEN NULL ELSE value END AS x FROM events)"""


def _odd(spark, sf):
    i = F.col("event_id")
    return R.table(spark, sf, "events").select("event_id", F.when(i % 11 == 0, float("inf")).when(i % 13 == 0, float("nan"))
                                               .when(i % 17 == 0, float("-inf")).when(i % 7 != 0, F.col("value")).alias("x"))


@query("filt_finite", f"WITH {_ODD} SELECT event_id, x FROM odd WHERE isfinite(x)")
def filt_finite(spark, sf):
    return _odd(spark, sf).where(S.finite("x"))


@query("fn_null_if", f"WITH {_ODD} SELECT event_id, CASE WHEN isfinite(x) THEN x END AS x, nullif(event_id % 3, 0) AS z FROM odd")
def fn_null_if(spark, sf):
    return _odd(spark, sf).select("event_id", S.finite_or_null("x").alias("x"), S.null_if(F.col("event_id") % 3, 0).alias("z"))


@query("cond_assign", _RES + """SELECT raceId, driverId, CASE WHEN statusId = 1 AND milliseconds BETWEEN 600000 AND 20000000
  AND laps BETWEEN 10 AND 100 THEN milliseconds / laps END AS pace FROM results""")
def cond_assign(spark, sf):
    sane = (F.col("statusId") == 1) & F.col("milliseconds").between(*P.TOTAL_MS_RANGE) & F.col("laps").between(*P.LAPS_RANGE)
    return R.results(spark, sf).select("raceId", "driverId", F.when(sane, F.col("milliseconds") / F.col("laps")).alias("pace"))


@query("check_required", _RES + "SELECT count(*) AS n_rows, CAST(count_if(points IS NULL) AS BIGINT) AS null_targets FROM results")
def check_required(spark, sf):
    rows = K.require_columns(R.results(spark, sf), ["raceId", "driverId", "points", "laps"], "results")
    K.require_no_null(rows, "points", "results")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("points").isNull()).alias("null_targets"))


@query("check_leakage", _RES + """SELECT unnest(['fastestLapSpeed', 'milliseconds', 'points', 'positionOrder', 'statusId']) AS name,
  (SELECT count(*) FROM results) AS n_rows""")
def check_leakage(spark, sf):
    rows = R.results(spark, sf)
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(F.array(*[F.lit(n) for n in K.leaking_columns(rows)])).alias("name"), "n_rows")


# ------------------------------------------------------------ scalar functions

_TOKENS = """tok AS (SELECT event_id, CASE event_id % 12 WHEN 0 THEN '\\N' WHEN 1 THEN '' WHEN 2 THEN ' 12 ' WHEN 3 THEN '1e3'
  WHEN 4 THEN 'abc' WHEN 5 THEN 'nan' WHEN 6 THEN NULL WHEN 7 THEN '1:02:03' WHEN 8 THEN '-' || CAST(event_id AS VARCHAR)
  WHEN 9 THEN (event_id // 60) || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') || '.5'
  WHEN 10 THEN ' 1:' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') || '.25 ' ELSE event_id || '.125' END AS t FROM events)"""


def _tokens(spark, sf):
    i = F.col("event_id")
    text = i.cast("string")
    two = F.lpad((i % 60).cast("string"), 2, "0")
    case = F.lit(None).cast("string")
    options = {0: F.lit("\\N"), 1: F.lit(""), 2: F.lit(" 12 "), 3: F.lit("1e3"), 4: F.lit("abc"), 5: F.lit("nan"),
               6: case, 7: F.lit("1:02:03"), 8: F.concat(F.lit("-"), text),
               9: F.concat(F.floor(i / 60).cast("string"), F.lit(":"), two, F.lit(".5")),
               10: F.concat(F.lit(" 1:"), two, F.lit(".25 "))}
    out = F.concat(text, F.lit(".125"))
    for k, v in options.items():
        out = F.when(i % 12 == k, v).otherwise(out)
    return R.table(spark, sf, "events").select("event_id", out.alias("t"))


@query("fn_to_num", f"WITH {_TOKENS} SELECT event_id, CASE WHEN isnan(try_cast(t AS DOUBLE)) THEN NULL ELSE try_cast(t AS DOUBLE) END AS x FROM tok")
def fn_to_num(spark, sf):
    return _tokens(spark, sf).select("event_id", S.to_num("t").alias("x"))


@query("fn_laptime_ms", f"WITH {_TOKENS} SELECT event_id, round(CASE WHEN t = 'nan' THEN NULL ELSE {R.sql_lap_ms('t')} END, 6) AS ms FROM tok")
def fn_laptime_ms(spark, sf):
    return _tokens(spark, sf).select("event_id", F.round(S.lap_time_ms("t"), 6).alias("ms"))


@query("fn_date_age", R.with_ctes(R.DRIVERS) + """SELECT raceId, driverId,
  year(try_cast(CASE WHEN raceId % 9 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE)) - year(try_cast(dob AS DATE)) AS age
FROM (SELECT DISTINCT l_orderkey AS raceId, l_suppkey AS driverId FROM lineitem) JOIN orders ON raceId = o_orderkey JOIN drivers USING (driverId)""")
def fn_date_age(spark, sf):
    rows = R.results(spark, sf).select("raceId", "driverId").join(R.races(spark, sf), "raceId").join(R.drivers(spark, sf), "driverId")
    text = F.when(F.col("raceId") % 9 == 0, "bad").otherwise(F.col("date"))
    return rows.select("raceId", "driverId", S.age_years(S.to_day(text), S.to_day("dob")).cast("bigint").alias("age"))


@query("fn_ratio_guarded", """SELECT event_id, value / nullif(event_id % 5, 0) AS r, coalesce(value / nullif(event_id % 4, 0), 0.0) AS r0 FROM events""")
def fn_ratio_guarded(spark, sf):
    return R.table(spark, sf, "events").select(
        "event_id", S.ratio("value", F.col("event_id") % 5).alias("r"), S.ratio("value", F.col("event_id") % 4, 0.0).alias("r0"))


@query("fn_clip", """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN greatest(least(value, 20.0), 2.5) END AS c FROM events""")
def fn_clip(spark, sf):
    return R.table(spark, sf, "events").select(
        "event_id", S.clip(F.when(F.col("event_id") % 7 != 0, F.col("value")), 2.5, 20.0).alias("c"))


@query("fn_log1p", "SELECT event_id, round(ln(1 + value), 9) AS x FROM events")
def fn_log1p(spark, sf):
    return R.table(spark, sf, "events").select("event_id", F.round(F.log1p("value"), 9).alias("x"))


@query("fn_bins", """SELECT o_orderkey, CASE WHEN y BETWEEN 1999 AND 2005 THEN 0 WHEN y > 2005 AND y <= 2010 THEN 1
  WHEN y > 2010 AND y <= 2014 THEN 2 WHEN y > 2014 AND y <= 2017 THEN 3 WHEN y > 2017 AND y <= 2021 THEN 4
  WHEN y > 2021 AND y <= 2025 THEN 5 ELSE 0 END AS era_bin FROM (SELECT o_orderkey, 1995 + o_orderkey % 35 AS y FROM orders)""")
def fn_bins(spark, sf):
    return R.table(spark, sf, "orders").select("o_orderkey", S.interval_bin(1995 + F.col("o_orderkey") % 35).alias("era_bin"))


@query("fn_row_min", "SELECT event_id, least(value, nullif(user_id, 3), CASE WHEN event_id % 2 = 0 THEN event_id END) AS m FROM events")
def fn_row_min(spark, sf):
    return R.table(spark, sf, "events").select("event_id", S.row_min(
        "value", S.null_if("user_id", 3).cast("double"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id")).cast("double")).alias("m"))


@query("fn_notnull_flag", _RES + "SELECT raceId, driverId, CAST(milliseconds IS NOT NULL AS INT) AS has_ms FROM results")
def fn_notnull_flag(spark, sf):
    return R.results(spark, sf).select("raceId", "driverId", S.present_flag("milliseconds").alias("has_ms"))


@query("fn_threshold_flag", _RES + """SELECT raceId, driverId, CASE WHEN points > 0 THEN 1 ELSE 0 END AS scored,
  CASE WHEN positionOrder <= 3 THEN 1 ELSE 0 END AS podium, CASE WHEN nullif(positionOrder, 2) = 1 THEN 1 ELSE 0 END AS won FROM results""")
def fn_threshold_flag(spark, sf):
    return R.results(spark, sf).select("raceId", "driverId", S.flag(F.col("points") > 0).alias("scored"),
                                       S.flag(F.col("positionOrder") <= 3).alias("podium"),
                                       S.flag(S.null_if("positionOrder", 2) == 1).alias("won"))


@query("fn_concat_key", _RES + "SELECT raceId, driverId, driverId || '_' || constructorId AS driver_constructor FROM results")
def fn_concat_key(spark, sf):
    return R.results(spark, sf).select("raceId", "driverId", S.concat_key("driverId", "constructorId").alias("driver_constructor"))


@query("fn_diff_clip", R.with_ctes(R.RESULTS, R.QUALIFYING) + """SELECT raceId, driverId,
  CAST(greatest(least(grid * 10 - position, 40), -40) AS DOUBLE) AS d FROM results JOIN qualifying USING (raceId, driverId)""")
def fn_diff_clip(spark, sf):
    rows = R.results(spark, sf).join(R.qualifying(spark, sf).select("raceId", "driverId", "position"), ["raceId", "driverId"])
    return rows.select("raceId", "driverId", S.clip(F.col("grid") * 10 - F.col("position"), -40.0, 40.0).alias("d"))


@query("fn_fill_const", _RES + "SELECT raceId, driverId, coalesce(milliseconds, 0.0) AS ms FROM results")
def fn_fill_const(spark, sf):
    return R.results(spark, sf).select("raceId", "driverId", F.col("milliseconds").alias("ms")).fillna(0.0, ["ms"])


@query("fn_fill_stat", _RES + """SELECT raceId, driverId, coalesce(milliseconds, (SELECT median(milliseconds) FROM results)) AS ms,
  coalesce(fastestLapSpeed, (SELECT avg(fastestLapSpeed) FROM results)) AS speed FROM results""")
def fn_fill_stat(spark, sf):
    rows = R.results(spark, sf)
    fill = scalar_of(global_stats(rows, means={"speed": "fastestLapSpeed"}, medians={"ms": "milliseconds"}))
    return rows.withColumn("f", fill).select(
        "raceId", "driverId", F.coalesce(F.col("milliseconds"), F.col("f.ms")).alias("ms"),
        F.coalesce(F.col("fastestLapSpeed"), F.col("f.speed")).alias("speed"))


_GAPS = """gaps AS (SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN value END AS value, CASE WHEN event_id % 5 <> 0 THEN user_id END AS user_id,
  CASE WHEN event_id % 4 <> 0 THEN event_type END AS event_type FROM events)"""


def _gaps(spark, sf):
    i = F.col("event_id")
    return R.table(spark, sf, "events").select(
        "event_id", F.when(i % 6 != 0, F.col("value")).alias("value"),
        F.when(i % 5 != 0, F.col("user_id")).alias("user_id"), F.when(i % 4 != 0, F.col("event_type")).alias("event_type"))


@query("fn_fill_all", f"""WITH {_GAPS} SELECT event_id, coalesce(value, (SELECT median(value) FROM gaps)) AS value,
  coalesce(CAST(user_id AS DOUBLE), (SELECT median(user_id) FROM gaps)) AS user_id,
  coalesce(event_type, (SELECT event_type FROM gaps WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS event_type FROM gaps""")
def fn_fill_all(spark, sf):
    return A.fill_all(_gaps(spark, sf), ["value", "user_id"], ["event_type"])


@query("fn_round_fmt", """SELECT event_id, round(value / 60000.0, 9) AS minutes, round(value * 100 / 7.0, 5) AS pct FROM events""")
def fn_round_fmt(spark, sf):
    return R.table(spark, sf, "events").select("event_id", F.round(S.ms_to_min("value"), 9).alias("minutes"),
                                               F.round(F.col("value") * 100 / F.lit(7.0), 5).alias("pct"))


@query("fn_error_cols", """SELECT event_id, user_id - event_id % 9 AS err_pace, abs(user_id - event_id % 9) AS abs_err_pace,
  (user_id - event_id % 9) * 50 AS err_ms, abs((user_id - event_id % 9) * 50) AS abs_err_ms FROM events""")
def fn_error_cols(spark, sf):
    rows = R.table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("p"), (F.col("event_id") % 9).alias("t")).withColumns(
        {"p_ms": F.col("p") * 50, "t_ms": F.col("t") * 50})
    return rows.select("event_id", *[c.alias(n) for n, c in {
        **S.error_columns("p", "t", "pace"), **S.error_columns("p_ms", "t_ms", "ms")}.items()])


@query("fn_minmax_score", """SELECT event_id, round((value - (SELECT min(value) FROM events)) /
  ((SELECT max(value) FROM events) - (SELECT min(value) FROM events) + 1e-12), 9) AS score FROM events""")
def fn_minmax_score(spark, sf):
    from pitwall.evaluation.classification import minmax_score

    return minmax_score(R.table(spark, sf, "events"), "value", "score").select("event_id", F.round("score", 9).alias("score"))


# ------------------------------------------------------------ joins

_STAR = R.with_ctes(R.DATED, R.DRIVERS, R.CONSTRUCTORS, R.CIRCUITS)


@query("join_star", _STAR + """SELECT raceId, driverId, constructorId, circuitId, year, driverRef, nationality,
  constructors.name AS constructorName, country, grid, points FROM dated LEFT JOIN drivers USING (driverId)
  LEFT JOIN constructors USING (constructorId) LEFT JOIN circuits USING (circuitId)""")
def join_star(spark, sf):
    return integrated(spark, sf).select("raceId", "driverId", "constructorId", "circuitId", "year", "driverRef",
                                        "nationality", "constructorName", "country", "grid", "points")


def integrated(spark, sf, of=None):
    return P.integrate(R.results(spark, sf, of), R.races(spark, sf), R.drivers(spark, sf),
                       R.constructors(spark, sf), R.circuits(spark, sf))


@query("join_left_key", """SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN
  (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON o_custkey = c_custkey""")
def join_left_key(spark, sf):
    side = R.table(spark, sf, "customer").where(F.col("c_custkey") % 3 != 0).select("c_custkey", "c_name", "c_mktsegment")
    return R.table(spark, sf, "orders").join(side, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", "c_name", "c_mktsegment")


@query("join_left_composite", R.with_ctes(R.RESULTS, R.QUALIFYING) + """SELECT raceId, driverId, grid, position FROM results
  LEFT JOIN (SELECT * FROM qualifying WHERE driverId % 4 <> 0) USING (raceId, driverId)""")
def join_left_composite(spark, sf):
    side = R.qualifying(spark, sf).where(F.col("driverId") % 4 != 0).select("raceId", "driverId", "position")
    return R.results(spark, sf).select("raceId", "driverId", "grid").join(side, ["raceId", "driverId"], "left")


@query("join_optional_dim", R.with_ctes(R.RACES, R.CIRCUITS) + "SELECT raceId, circuitId, country FROM races LEFT JOIN circuits USING (circuitId)")
def join_optional_dim(spark, sf):
    rows, side = R.races(spark, sf).select("raceId", "circuitId"), R.circuits(spark, sf)
    whole = {"circuitId", "country"} <= set(side.columns)
    return rows.join(side.select("circuitId", "country"), "circuitId", "left") if whole else rows


@query("join_overlap_names", """SELECT s_suppkey, s.s_name AS name_left, n.n_name AS name_right, s.s_nationkey AS key
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def join_overlap_names(spark, sf):
    left = R.table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("key"), F.col("s_name").alias("name")).alias("l")
    right = R.table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")).alias("r")
    return left.join(right, F.col("l.key") == F.col("r.key"), "left").select(
        "s_suppkey", F.col("l.name").alias("name_left"), F.col("r.name").alias("name_right"), F.col("l.key").alias("key"))


@query("join_agg_back", _RES + """SELECT raceId, driverId, best, n FROM results JOIN
  (SELECT raceId, min(milliseconds) AS best, count(*) AS n FROM results GROUP BY raceId) USING (raceId)""")
def join_agg_back(spark, sf):
    return A.group_back(R.results(spark, sf).select("raceId", "driverId", "milliseconds"), ["raceId"], [
        F.min("milliseconds").alias("best"), F.count(F.lit(1)).alias("n")]).drop("milliseconds")


@query("join_semi_selected", _DATED + """SELECT raceId, driverId, points FROM dated WHERE raceId IN
  (SELECT raceId FROM races WHERE circuitId IN (1, 3, 5) AND year > 1997)""")
def join_semi_selected(spark, sf):
    chosen = R.races(spark, sf).where(F.col("circuitId").isin(1, 3, 5) & (F.col("year") > 1997))
    return R.dated(spark, sf).select("raceId", "driverId", "points").join(chosen.select("raceId"), "raceId", "left_semi")


_LABELS = """labels2 AS (SELECT raceId, CAST(circuitId % 4 AS INT) AS cluster_kmeans_k4 FROM races WHERE raceId % 6 <> 0)"""


@query("join_attach_labels", R.with_ctes(R.DATED, _LABELS) + """SELECT raceId, driverId, coalesce(cluster_kmeans_k4,
  (SELECT cluster_kmeans_k4 FROM dated JOIN labels2 USING (raceId) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS cluster_kmeans_k4
FROM dated LEFT JOIN labels2 USING (raceId)""")
def join_attach_labels(spark, sf):
    races = R.races(spark, sf)
    labels = races.where(F.col("raceId") % 6 != 0).select("raceId", (F.col("circuitId") % 4).cast("int").alias("cluster_kmeans_k4"))
    return P.attach_labels(R.dated(spark, sf).select("raceId", "driverId"), labels)


@query("join_scalar", _RES + """SELECT raceId, driverId, coalesce(milliseconds, (SELECT avg(milliseconds) FROM results)) AS ms FROM results""")
def join_scalar(spark, sf):
    rows = R.results(spark, sf)
    mean = rows.agg(F.avg("milliseconds").alias("m")).scalar()
    return rows.select("raceId", "driverId", F.coalesce(F.col("milliseconds"), mean).alias("ms"))


@query("join_align_rows", _DATED + """SELECT raceId, driverId, milliseconds AS target, laps FROM dated
  WHERE raceId IN (SELECT raceId FROM races WHERE year <= 1998)""")
def join_align_rows(spark, sf):
    # target and laps travel in the sampled row, so they stay aligned by construction
    chosen = R.races(spark, sf).where(F.col("year") <= 1998).select("raceId")
    return R.dated(spark, sf).select("raceId", "driverId", F.col("milliseconds").alias("target"), "laps").join(
        chosen, "raceId", "left_semi")


# ------------------------------------------------------------ sorts and limits

@query("sort_multi", """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) END AS y, o_custkey FROM orders
  ORDER BY y NULLS LAST, o_custkey, o_orderkey""")
def sort_multi(spark, sf):
    rows = R.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.year("o_orderdate")).cast("bigint").alias("y"), "o_custkey")
    return rows.orderBy(F.col("y").asc_nulls_last(), "o_custkey", "o_orderkey")


@query("topk_group_metric", R.with_ctes(R.RESULTS, R.CONSTRUCTORS) + """SELECT name AS constructorName, sum(points) AS points FROM results
  JOIN constructors USING (constructorId) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def topk_group_metric(spark, sf):
    # points per team first: the name is joined to one row per team
    per_team = R.results(spark, sf).groupBy("constructorId").agg(F.sum("points").alias("p")).join(
        R.constructors(spark, sf), "constructorId")
    return A.top_groups(per_team.withColumnRenamed("name", "constructorName"), "constructorName", F.sum("p"), "points", 10)


@query("limit_head", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 12")
def limit_head(spark, sf):
    return R.table(spark, sf, "events").select("event_id", "value").orderBy(F.col("value").desc(), "event_id").limit(12)


@query("argmax_row", "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 1")
def argmax_row(spark, sf):
    return A.argmax_row(R.table(spark, sf, "events").select("event_id", "user_id", "value"), "value", "event_id")


_USERS = "SELECT user_id, median(CAST(round(value * 100) AS BIGINT)) AS m, count(*) AS n FROM events GROUP BY 1 HAVING count(*) >= 5"


@query("best_and_worst_k", f"""WITH u AS ({_USERS}) SELECT * FROM (SELECT *, 'worst' AS side FROM u ORDER BY m DESC, user_id LIMIT 15)
  UNION ALL SELECT * FROM (SELECT *, 'best' AS side FROM u ORDER BY m, user_id LIMIT 15)""")
def best_and_worst_k(spark, sf):
    from pitwall.operators.quantiles import grouped_agg

    rows = R.table(spark, sf, "events").select("user_id", F.round(F.col("value") * 100).cast("bigint").alias("c"))
    users = grouped_agg(rows, ["user_id"], [F.count(F.lit(1)).alias("n")], {"m": ("c", 0.5)}).where(F.col("n") >= 5)
    return A.best_and_worst(users, "m", "user_id", 15)


@query("union_metric_rows", """SELECT 'by_type' AS model, count(*) AS n, max(value) AS top, NULL AS users FROM events
  UNION ALL SELECT 'by_user', count(*), NULL, count(DISTINCT user_id) FROM events""")
def union_metric_rows(spark, sf):
    e = R.table(spark, sf, "events")
    return A.stack_rows([
        e.agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top")).withColumn("model", F.lit("by_type")),
        e.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users")).withColumn("model", F.lit("by_user"))])
