import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.operators import quantiles as Q


@pytest.mark.parametrize("by", [[], ["g"]])
def test_bracketed_quantiles_are_exact(spark, by, monkeypatch):
    monkeypatch.setattr(Q, "MIN_ACCURACY", 200)  # brackets get to work on a small table
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=4000), np.repeat(0.25, 600), rng.exponential(50, size=1500)])
    groups = np.where(np.arange(len(values)) % 10 < 7, 1, 2)
    df = spark.createDataFrame([(int(g), None if i % 50 == 0 else float(v)) for i, (g, v) in enumerate(zip(groups, values))],
                               "g int, v double").repartition(5)
    out = Q.grouped_agg(df, by, [F.count("v").alias("n")],
                        {"q1": ("v", 0.25), "med": ("v", 0.5), "q3": ("v", 0.75)}, max_rows=10)
    keep = np.arange(len(values)) % 50 != 0
    for r in out.collect():
        x = values[keep & (groups == r["g"])] if by else values[keep]
        assert r["n"] == len(x)
        assert np.allclose([r["q1"], r["med"], r["q3"]], np.quantile(x, [0.25, 0.5, 0.75]), rtol=0, atol=1e-12)


def test_small_groups_need_no_bracket(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 5.0), (3, None)], "g int, v double")
    out = {r["g"]: r["m"] for r in Q.grouped_agg(df, ["g"], [], {"m": ("v", 0.5)}, max_rows=1).collect()}
    assert out == {1: 1.5, 2: 5.0, 3: None}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_narrowed_brackets_are_exact(spark, by):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.normal(size=6000), np.repeat(0.25, 900), rng.exponential(50, size=2100)])
    groups = np.where(np.arange(len(values)) % 10 < 7, 1, 2)
    df = spark.createDataFrame([(None if g == 2 else 1, None if i % 50 == 0 else float(v))
                                for i, (g, v) in enumerate(zip(groups, values))], "g int, v double").repartition(5)
    wanted = {"least": 0.0, "q1": 0.25, "med": 0.5, "q9": 0.9, "most": 1.0}
    assert Q.narrowing_passes(len(values), 100, 20) >= 2
    out = Q.grouped_agg(df, by, [F.count("v").alias("n")], {a: ("v", p) for a, p in wanted.items()},
                        max_rows=10, accuracy=100, bracket_rows=20)
    keep, rows = np.arange(len(values)) % 50 != 0, out.collect()
    assert len(rows) == (2 if by else 1)
    for r in rows:
        x = values[keep & (groups == (r["g"] or 2))] if by else values[keep]
        assert r["n"] == len(x)
        assert np.allclose([r[a] for a in wanted], np.quantile(x, list(wanted.values())), rtol=0, atol=1e-12)


def test_passes_grow_with_the_logarithm_of_the_rows():
    assert [Q.narrowing_passes(n, Q.MIN_ACCURACY, Q.BRACKET_ROWS) for n in (10**6, 10**9, 10**11, 10**13)] == [0, 0, 1, 2]


def test_small_groups_meet_before_their_value_tables(spark):
    """Pieces of small groups in every task used to be shuffled as a value table each."""
    df = spark.range(3000).repartition(6).select((F.col("id") % 900).alias("g"), F.col("id").cast("double").alias("v"))
    out = Q.grouped_agg(df, ["g"], [F.count("v").alias("n")], {"m": ("v", 0.5)}, sizes={"": 3000})
    plan = out._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.index("partial_percentile") < plan.index("Exchange hashpartitioning(g")  # printed from the result down
    assert {(r["n"], r["m"] - r["g"]) for r in out.where("g < 300").collect()} == {(4, 1350.0)}
