"""The star schema of the library, read from the test tables.

A race is an order, a driver a supplier, a team the supplier's nation, a circuit
the customer's nation, and a result one (order, supplier) pair.  Numbers that
would be prices are taken in whole cents, so sums are exact in every engine.
The same definitions stand next to each other as DataFrames and as SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.session import materialise

_tables: dict[tuple[str, str, str], DataFrame] = {}


def kept(spark: SparkSession, sf: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """A table written once per application and read by all queries on it."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _tables:
        _tables[key] = materialise(build(spark, sf))
    return _tables[key]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def races(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("raceId"), F.year("o_orderdate").cast("bigint").alias("year"),
        F.dayofyear("o_orderdate").cast("bigint").alias("round"),
        F.col("c_nationkey").cast("bigint").alias("circuitId"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))


RACES = """races AS (
  SELECT o_orderkey AS raceId, year(o_orderdate) AS year, dayofyear(o_orderdate) AS round,
         CAST(c_nationkey AS BIGINT) AS circuitId, strftime(o_orderdate, '%Y-%m-%d') AS date
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def cars(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (order, supplier): the measures every fact table is cut from."""
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("team"))
    flag = F.col("l_returnflag")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(
        F.min("l_linenumber").cast("bigint").alias("line"), F.max("l_linenumber").cast("bigint").alias("place"),
        F.sum("l_quantity").cast("bigint").alias("qty"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
        F.sum(F.round(F.col("l_tax") * 100).cast("bigint")).alias("tax"),
        # 1 where the largest flag is R; the largest text itself would need sorted groups
        F.max(F.when(flag > "R", 2).when(flag == "R", 1).otherwise(0)).alias("flag"))
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")


def written_cars(spark: SparkSession, sf: str) -> DataFrame:
    """``cars`` for queries that cut several tables from it, or read one several times."""
    return kept(spark, sf, "cars", cars)


CARS = """cars AS (
  SELECT l.*, CAST(s_nationkey AS BIGINT) AS team FROM (
    SELECT l_orderkey, l_suppkey, CAST(min(l_linenumber) AS BIGINT) AS line,
           CAST(max(l_linenumber) AS BIGINT) AS place, CAST(sum(l_quantity) AS BIGINT) AS qty,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
           CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS tax,
           max(l_returnflag) AS flag
    FROM lineitem GROUP BY l_orderkey, l_suppkey) l JOIN supplier ON l_suppkey = s_suppkey)"""


def results(spark: SparkSession, sf: str, of: DataFrame | None = None) -> DataFrame:
    c = of if of is not None else cars(spark, sf)
    qty = F.col("qty")
    return c.select(
        F.col("l_orderkey").alias("raceId"), F.col("l_suppkey").alias("driverId"),
        F.col("team").alias("constructorId"), F.col("line").alias("grid"), qty.alias("laps"),
        F.when((F.col("l_orderkey") + F.col("l_suppkey")) % 5 != 0, F.col("cents")).cast("double").alias("milliseconds"),
        F.when(F.col("flag") == 1, 2).otherwise(1).cast("bigint").alias("statusId"),
        F.when(qty > 30, qty - 30).otherwise(0).cast("double").alias("points"),
        F.col("place").alias("positionOrder"),
        F.when(F.col("l_suppkey") % 7 != 0, 180 + F.col("tax")).cast("double").alias("fastestLapSpeed"))


RESULTS = CARS + """, results AS (
  SELECT l_orderkey AS raceId, l_suppkey AS driverId, team AS constructorId, line AS grid, qty AS laps,
         CASE WHEN (l_orderkey + l_suppkey) % 5 <> 0 THEN CAST(cents AS DOUBLE) END AS milliseconds,
         CAST(CASE WHEN flag = 'R' THEN 2 ELSE 1 END AS BIGINT) AS statusId,
         CAST(CASE WHEN qty > 30 THEN qty - 30 ELSE 0 END AS DOUBLE) AS points,
         place AS positionOrder,
         CASE WHEN l_suppkey % 7 <> 0 THEN CAST(180 + tax AS DOUBLE) END AS fastestLapSpeed
  FROM cars)"""


def drivers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("driverId"), F.col("s_name").alias("driverRef"),
        F.concat(F.lit("nat_"), F.col("s_nationkey").cast("string")).alias("nationality"),
        F.concat((1950 + F.col("s_suppkey") % 45).cast("string"), F.lit("-06-15")).alias("dob"))


DRIVERS = """drivers AS (
  SELECT s_suppkey AS driverId, s_name AS driverRef, 'nat_' || s_nationkey AS nationality,
         (1950 + s_suppkey % 45) || '-06-15' AS dob FROM supplier)"""


def constructors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("constructorId"), F.col("n_name").alias("name"))


CONSTRUCTORS = """constructors AS (
  SELECT CAST(n_nationkey AS BIGINT) AS constructorId, n_name AS name FROM nation)"""


def circuits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("circuitId"), F.col("n_name").alias("country"))


CIRCUITS = """circuits AS (
  SELECT CAST(n_nationkey AS BIGINT) AS circuitId, n_name AS country FROM nation)"""


def _clock(ms):
    """Whole milliseconds as m:ss.mmm."""
    return F.concat((ms.cast("bigint") / 60000).cast("bigint").cast("string"), F.lit(":"),
                    F.lpad(F.floor(ms % 60000 / 1000).cast("string"), 2, "0"), F.lit("."),
                    F.lpad((ms % 1000).cast("string"), 3, "0"))


def qualifying(spark: SparkSession, sf: str, of: DataFrame | None = None) -> DataFrame:
    """Session times as text, some missing or malformed."""
    c = of if of is not None else cars(spark, sf)
    base = 60000 + F.col("cents") % 90000
    return c.select(
        F.col("l_orderkey").alias("raceId"), F.col("l_suppkey").alias("driverId"),
        (F.col("line") + F.col("l_suppkey") % 3).alias("position"),
        F.when(F.col("cents") % 11 == 0, "\\N").when(F.col("cents") % 13 == 0, "no time")
        .otherwise(_clock(base)).alias("q1"),
        F.when(F.col("cents") % 2 == 0, _clock(base - 500)).when(F.col("cents") % 3 == 0, "").alias("q2"),
        F.when(F.col("cents") % 4 == 0, _clock(base - 900)).when(F.col("cents") % 17 == 0, "1:02:03").alias("q3"))


def _sql_clock(ms: str) -> str:
    return (f"(({ms}) // 60000) || ':' || lpad(CAST(({ms}) % 60000 // 1000 AS VARCHAR), 2, '0')"
            f" || '.' || lpad(CAST(({ms}) % 1000 AS VARCHAR), 3, '0')")


_BASE = "60000 + cents % 90000"
QUALIFYING = f"""qualifying AS (
  SELECT l_orderkey AS raceId, l_suppkey AS driverId, line + l_suppkey % 3 AS position,
         CASE WHEN cents % 11 = 0 THEN '\\N' WHEN cents % 13 = 0 THEN 'no time' ELSE {_sql_clock(_BASE)} END AS q1,
         CASE WHEN cents % 2 = 0 THEN {_sql_clock(_BASE + ' - 500')} WHEN cents % 3 = 0 THEN '' END AS q2,
         CASE WHEN cents % 4 = 0 THEN {_sql_clock(_BASE + ' - 900')} WHEN cents % 17 = 0 THEN '1:02:03' END AS q3
  FROM cars)"""


def sql_lap_ms(c: str) -> str:
    """The lap-time rule in SQL."""
    t = f"trim({c})"
    n = f"len(string_split({t}, ':'))"
    return (f"CASE WHEN {n} = 1 THEN try_cast({t} AS DOUBLE) * 1000.0 "
            f"WHEN {n} = 2 THEN (try_cast(split_part({t}, ':', 1) AS DOUBLE) * 60.0 + "
            f"try_cast(split_part({t}, ':', 2) AS DOUBLE)) * 1000.0 END")


def driver_standings(spark: SparkSession, sf: str, of: DataFrame | None = None) -> DataFrame:
    c = of if of is not None else cars(spark, sf)
    return c.select(
        F.col("l_orderkey").alias("raceId"), F.col("l_suppkey").alias("driverId"),
        F.col("qty").cast("double").alias("points"), (F.col("line") + F.col("l_suppkey") % 9).alias("position"),
        (F.col("qty") % 4).alias("wins"))


DRIVER_STANDINGS = """driver_standings AS (
  SELECT l_orderkey AS raceId, l_suppkey AS driverId, CAST(qty AS DOUBLE) AS points,
         line + l_suppkey % 9 AS position, qty % 4 AS wins FROM cars)"""


def team_standings(spark: SparkSession, sf: str, of: DataFrame | None = None) -> DataFrame:
    c = of if of is not None else cars(spark, sf)
    return c.groupBy(F.col("l_orderkey").alias("raceId"), F.col("team").alias("constructorId")).agg(
        F.sum("qty").cast("double").alias("points"), F.min(F.col("line") + F.col("team") % 5).alias("position"),
        F.max(F.col("qty") % 3).alias("wins"))


TEAM_STANDINGS = """team_standings AS (
  SELECT l_orderkey AS raceId, team AS constructorId, CAST(sum(qty) AS DOUBLE) AS points,
         min(line + team % 5) AS position, max(qty % 3) AS wins FROM cars GROUP BY ALL)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def dated(spark: SparkSession, sf: str, of: DataFrame | None = None) -> DataFrame:
    """Results with the calendar of their race."""
    return results(spark, sf, of).join(races(spark, sf), "raceId")


DATED = RACES + ",\n" + RESULTS + """, dated AS (
  SELECT r.*, year, round, circuitId, date FROM results r JOIN races USING (raceId))"""


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})
