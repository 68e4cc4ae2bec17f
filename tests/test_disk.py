"""Shuffles and written tables that are done with go, whole rows are not shuffled to split them."""

import os

import pytest
from pyspark.sql import functions as F

from pitwall.evaluation import tournament as T
from pitwall.models import estimators as M
from pitwall.models import gram
from pitwall.operators import history as H
from pitwall.operators import sampling as G
from pitwall.session import _DROPS, materialise, passing_shuffles, remove_written, shared_folder


def _shuffles(spark) -> int:
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    return sum(f.startswith("shuffle_") for d in env.blockManager().diskBlockManager().localDirsString()
               for _, _, files in os.walk(d) for f in files)


def test_written_tables_leave_no_shuffle(spark):
    spark._jvm.System.gc()
    df = spark.range(20_000).groupBy((F.col("id") % 5_003).alias("k")).count().repartition(3, "count")
    before = _shuffles(spark)
    table = materialise(df)
    assert _shuffles(spark) <= before and table.count() == 5_003
    assert spark.conf.get(_DROPS, "false") == "false"
    spark.conf.set(_DROPS, "true")
    with passing_shuffles(spark), passing_shuffles(spark):
        pass
    assert spark.conf.get(_DROPS) == "true"
    spark.conf.set(_DROPS, "false")


def test_tables_that_are_done_go(spark):
    folder = shared_folder(spark)
    first = materialise(spark.range(10).toDF("a"))
    held = set(os.listdir(folder))
    second = materialise(first.withColumn("b", F.col("a") + 1), done=[first])
    assert len(held - set(os.listdir(folder))) == 1 and second.count() == 10
    remove_written(second)
    with pytest.raises(ValueError):
        remove_written(_elsewhere(spark))


def _elsewhere(spark):
    path = f"{shared_folder(spark)}/other"
    spark.range(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("hot", [10**6, 40])
def test_histories_in_steps(spark, cars, hot):
    plan = [("driverId", [H.prev_mean("x", "m"), H.lag_of("x", "l")]), (["driverId", "circuitId"], [H.prev_count("n")]),
            ("constructorId", [H.roll_mean("x", 5, "r")]), ("circuitId", [H.prev_std("x", "s")])]
    order = ["year", "round", "raceId", "rowId"]
    want = H.add_history(cars, plan, order, ["year", "round"], hot_rows=hot)
    got = H.add_history(materialise(cars), plan, order, ["year", "round"], hot_rows=hot, steps=True)
    rows = [sorted(map(repr, df.select("rowId", "m", "l", "n", F.round("r", 6), F.round("s", 6)).collect())) for df in (want, got)]
    assert rows[0] == rows[1]


def test_split_takes_the_first_of_each_class_without_shuffling_rows(spark):
    df = materialise(spark.range(3_000).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 3).alias("label"), F.repeat(F.lit("x"), 50).alias("wide")))
    got = G.split_stratified(df, ["id"], "label")
    rows = got.withColumn("h", G.hash_order("id")).collect()
    by: dict = {}
    for r in sorted(rows, key=lambda r: (r["h"], r["id"])):
        by.setdefault(r["label"], []).append(r["split"])
    assert len(rows) == 3_000 and len(by) == 4
    for sides in by.values():
        n = int(len(sides) * 0.2 + 0.5)
        assert sides == ["test"] * n + ["train"] * (len(sides) - n)
    again = G.split_stratified(df.unionByName(df).repartition(3), ["id"], "label").groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in again if r["split"] == "test"} == {
        (k, "test"): int(2 * len(v) * 0.2 + 0.5) for k, v in by.items()}


def test_encoded_folds_go_when_scored(spark):
    df = materialise(spark.range(300).select("id", (F.col("id") % 5).cast("string").alias("c"), F.rand(1).alias("x"),
                                             (F.col("id") % 5 + F.rand(2)).alias("label"), (F.col("id") % 3).alias("fold")))
    splits, pool = T.stratified_splits(df, "fold", 3), [c for c in M.regressors() if c.gram]
    held = []
    plain = gram.score_grid

    def watched(rows, *rest):
        held.append(rows.inputFiles())
        return plain(rows, *rest)

    gram.score_grid = watched
    try:
        found = T.gram_search(splits, pool, categories=["c"], numbers=["x"])
    finally:
        gram.score_grid = plain
    assert [len(found[c.name]) for c in pool] == [14, 77] and len(held) == 3
    assert not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for files in held for f in files)
