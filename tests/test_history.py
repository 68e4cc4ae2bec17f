"""Golden windows, the sliced form against the plain one, no look-ahead."""

import math

import pytest
from pyspark.sql import functions as F

from pitwall.operators import history as H
from pitwall.operators.scan import hash_rank, prefix_scan, value_slices

ORDER = ["year", "round", "raceId", "rowId"]
SLICES = ["year", "round"]

GOLD_IN = [
    (1, 2000, 1, 10, 100, 7, 20), (2, 2000, 1, 11, 100, 7, 24), (3, 2000, 2, 10, 100, 8, 22),
    (4, 2000, 2, 11, 100, 8, None), (5, 2000, 3, 10, 101, 7, 26), (6, 2000, 3, 11, 100, 7, 30),
    (7, 2001, 1, 10, 101, 7, 28), (8, 2001, 1, 11, 100, 7, 21), (9, 2001, 2, 10, 101, 8, 25),
]
# rowId -> per driver: mean, std, median, roll 5, count, lag
GOLD_DRIVER = {
    1: (None, None, None, None, 0, None), 2: (None, None, None, None, 0, None), 3: (20, None, 20, None, 1, 20),
    4: (24, None, 24, None, 1, 24), 5: (21, 1.4142, 21, None, 2, 22), 6: (24, None, 24, None, 2, None),
    7: (22.6667, 3.0551, 22, 22.6667, 3, 26), 8: (27, 4.2426, 27, None, 3, 30), 9: (24, 3.6515, 24, 24, 4, 28),
}
GOLD_CIRCUIT = {6: (23.3333, 3.0551, 24, 23.3333, 3), 8: (25.6, 3.8471, 26, 25.6, 5), 9: (22, None, 22, None, 2)}


def _stats(p, x="x"):
    return [H.prev_mean(x, f"{p}_mean"), H.prev_std(x, f"{p}_std"), H.prev_median(x, f"{p}_med"),
            H.roll_mean(x, 5, f"{p}_r5"), H.prev_count(f"{p}_n"), H.lag_of(x, f"{p}_lag")]


def _near(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=5e-5))


def test_golden_windows(spark):
    df = spark.createDataFrame(
        [(r, y, n, y * 10 + n, d, c, k, None if x is None else float(x)) for r, y, n, d, c, k, x in GOLD_IN],
        "rowId long, year long, round long, raceId long, driverId long, constructorId long, circuitId long, x double")
    out = H.add_history(df, [("driverId", _stats("d")), ("circuitId", _stats("k"))], ORDER, SLICES)
    rows = {r["rowId"]: r for r in out.collect()}
    for row_id, want in GOLD_DRIVER.items():
        got = [rows[row_id][f"d_{c}"] for c in ("mean", "std", "med", "r5", "n", "lag")]
        assert all(_near(a, b) for a, b in zip(got, want)), (row_id, got, want)
    for row_id, want in GOLD_CIRCUIT.items():
        got = [rows[row_id][f"k_{c}"] for c in ("mean", "std", "med", "r5", "n")]
        assert all(_near(a, b) for a, b in zip(got, want)), (row_id, got, want)


def _collect(df):
    return {r["rowId"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("hot_rows", [0, 30, 150])
def test_sliced_history_equals_plain(spark, cars, hot_rows):
    """All keys hot, some hot, few hot: always the plain window's values."""
    plan = []
    for key in ("driverId", "constructorId", "circuitId"):
        stats = _stats(key) + [H.prev_sum("laps", f"{key}_sum"), H.roll_std("x", 10, f"{key}_rs"),
                               H.roll_mean("laps", 30, f"{key}_r30"), H.prev_median("laps", f"{key}_lm")]
        plan.append((key, [s for s in stats if s.alias != f"{key}_med"]))
    plain = _collect(H.add_history(cars, plan, ORDER, SLICES))
    sliced = _collect(H.add_history(cars, plan, ORDER, SLICES, hot_rows=hot_rows, sizes={"": 10**9}))
    assert len(plain) == len(sliced) == cars.count()
    for row_id, want in plain.items():
        for c, v in want.items():
            assert _near(sliced[row_id][c], v), (hot_rows, row_id, c, sliced[row_id][c], v)


def test_sliced_composite_key(spark, cars):
    plan = [(["driverId", "circuitId"], [H.prev_count("n"), H.prev_mean("x", "m")])]
    plain = _collect(H.add_history(cars, plan, ORDER, SLICES))
    sliced = _collect(H.add_history(cars, plan, ORDER, SLICES, hot_rows=5, sizes={"": 10**9}))
    assert all(_near(sliced[i][c], r[c]) for i, r in plain.items() for c in ("n", "m"))


def test_no_look_ahead(spark, cars):
    """Changing a target changes no history value of that row or an earlier one."""
    plan = [("driverId", [H.prev_mean("x", "m"), H.roll_mean("x", 5, "r"), H.lag_of("x", "l")]),
            ("circuitId", [H.prev_mean("x", "km"), H.prev_std("x", "ks")])]
    before = _collect(H.add_history(cars, plan, ORDER, SLICES))
    changed = cars.withColumn("x", F.when(F.col("rowId") == 200, 1e6).otherwise(F.col("x")))
    after = _collect(H.add_history(changed, plan, ORDER, SLICES))
    assert all(_near(before[i][c], after[i][c]) for i in range(201) for c in ("m", "r", "l", "km", "ks"))
    assert any(not _near(before[i][c], after[i][c]) for i in range(201, len(before)) for c in ("m", "km"))


def test_partitioning_does_not_matter(spark, cars):
    plan = [("driverId", [H.prev_mean("x", "m"), H.prev_count("n")])]
    a = _collect(H.add_history(cars.repartition(1), plan, ORDER, SLICES))
    b = _collect(H.add_history(cars.repartition(7), plan, ORDER, SLICES))
    assert a == b


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_scan(spark, cars, descending):
    out = prefix_scan(cars, order=["raceId", "rowId"], slices=["year", "round"], count="n",
                      sums={"s": "laps"}, descending=descending).collect()
    rows = sorted(out, key=lambda r: (r["raceId"], r["rowId"]), reverse=descending)
    total = 0.0
    for i, r in enumerate(rows):
        assert r["n"] == i and r["s"] == total
        total += r["laps"]


def test_hash_rank_is_a_permutation(spark, cars):
    ranks = [r["k"] for r in hash_rank(cars, ["rowId"], name="k").collect()]
    assert sorted(ranks) == list(range(len(ranks)))
    per = hash_rank(cars, ["rowId"], name="k", keys=["constructorId"]).groupBy("constructorId").agg(
        F.max("k").alias("m"), F.count("*").alias("n"), F.count_distinct("k").alias("d")).collect()
    assert all(r["m"] + 1 == r["n"] == r["d"] for r in per)


def test_value_slices_grow_with_the_value(spark, cars):
    rows = value_slices(cars.where("x is not null"), "x", name="s", rows_per_slice=50).select("x", "s").collect()
    ordered = [r["s"] for r in sorted(rows, key=lambda r: r["x"])]
    assert ordered == sorted(ordered) and len(set(ordered)) > 4


def test_slices_follow_the_rows_not_the_calendar(spark):
    """A key with one row a day had a slice, its halo and a value table for each day."""
    days = spark.range(400).select(F.lit(1).alias("k"), (F.col("id") / 100).cast("int").alias("year"), F.col("id").cast("int").alias("round"))
    cut = H.slice_numbers(days, ["k"], ["year", "round"], 150).groupBy("__cut").agg(F.count(F.lit(1)).alias("n"), F.min("round").alias("a"), F.max("round").alias("b"))
    assert [(r["n"], r["a"], r["b"]) for r in cut.orderBy("__cut").collect()] == [(150, 0, 149), (150, 150, 299), (100, 300, 399)]
