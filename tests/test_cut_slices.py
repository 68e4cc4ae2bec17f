from pyspark.sql import Window
from pyspark.sql import functions as F

from pitwall.operators.scan import cut_slices, prefix_scan


def test_large_slots_are_cut_and_the_scan_stays_the_same(spark):
    rows = [(1, i, i % 5) for i in range(400)] + [(2, i, 1) for i in range(6)] + [(None, i // 9, 2) for i in range(90)]
    df = spark.createDataFrame(rows, "slot long, id long, n long").withColumn("row", F.monotonically_increasing_id())
    cut = cut_slices(df, ["slot"], "id", name="cut", rows_per_slice=20, pieces=16)
    pieces = {r["slot"]: (r["k"], r["most"]) for r in cut.groupBy("slot", "cut").count().groupBy("slot").agg(
        F.count(F.lit(1)).alias("k"), F.max("count").alias("most")).collect()}
    assert pieces[2] == (1, 6) and pieces[1][0] == 16 and pieces[1][1] <= 40 and pieces[None][0] > 5
    got = prefix_scan(cut, order=["id", "row"], slices=["slot", "cut"], count="c", sums={"before": "n"})
    w = Window.orderBy("slot", "id", "row")
    want = df.withColumn("c", F.row_number().over(w) - 1).withColumn(
        "before", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    key = lambda d: sorted((r["row"], r["c"], r["before"]) for r in d.collect())
    assert key(got) == key(want)
