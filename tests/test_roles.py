import datetime as dt

from pitwall.queries import roles as R


def _tables(spark, folder):
    day = dt.datetime(1998, 2, 6)
    flags = {1: ["A", "R"], 2: ["R", "S"], 3: ["N"], 4: [None, "R"], 5: [None]}
    lines = [(o, 7, i + 1, 3.0, 10.0, 0.01, f) for o, fs in flags.items() for i, f in enumerate(fs)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_tax double, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(7, 2)], "s_suppkey long, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(o, 1, day) for o in flags], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{folder}/orders.parquet")
    return folder


def test_status_is_of_the_largest_flag_without_sorted_groups(spark, tmp_path):
    """The largest text of a group made Spark sort all lines."""
    sf = _tables(spark, str(tmp_path))
    rows = R.results(spark, sf)
    assert {r["raceId"]: r["statusId"] for r in rows.collect()} == {1: 2, 2: 1, 3: 1, 4: 2, 5: 1}
    assert "SortAggregate" not in rows._jdf.queryExecution().executedPlan().toString()


def test_tables_are_cut_from_one_written_table(spark, tmp_path):
    sf = _tables(spark, str(tmp_path))
    c = R.written_cars(spark, sf)
    assert R.written_cars(spark, sf) is c
    for cut in (R.results, R.qualifying, R.driver_standings, R.team_standings):
        assert sorted(map(str, cut(spark, sf, c).collect())) == sorted(map(str, cut(spark, sf).collect()))
        assert not any("lineitem" in f for f in cut(spark, sf, c).inputFiles())
