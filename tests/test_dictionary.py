from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pitwall.models import dictionary as D
from pitwall.models import prep
from pitwall.operators import scan


def test_slots_are_dense_and_rare_ones_share_one(spark, monkeypatch):
    rows = [(f"v{i % 700}" if i < 1400 else f"rare{i}", "x'\\\"" if i % 2 else None) for i in range(1500)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(5)
    got = {}
    for r in D.dense_slots(D.category_counts(df, ["a", "b"]), 2).collect():
        got.setdefault(r["column"], {})[r["value"]] = r["slot"]
    assert sorted(s for v, s in got["a"].items() if not v.startswith("rare")) == list(range(700))
    assert {s for v, s in got["a"].items() if v.startswith("rare")} == {700}
    assert got["b"] == {"x'\\\"": 0}


def test_encoder_looks_up_fills_and_leaves_out(spark):
    train = spark.createDataFrame([(i, f"d{i % 300}", None, 1.0 * i) for i in range(900)] + [(900, "once", None, 5.0)],
                                  "id long, driverId string, circuitId string, grid double")
    pre = prep.fit_preprocessor(train, ["driverId", "circuitId"], ["grid"], kind="tree", min_frequency=2)
    rows = spark.createDataFrame([(0, "d7", "c", 2.5), (1, None, None, None), (2, "new", None, 0.0), (3, "once", None, 1.0)],
                                 "id long, driverId string, circuitId string, grid double")
    out = pre.transform(rows.withColumn("slot", F.lit(1)).withColumn("value", F.lit("x")))
    assert out.columns == [*rows.columns, "slot", "value", "features"]
    v = {r["id"]: r["features"] for r in out.collect()}
    assert all(x.size == 302 for x in v.values())
    table = {r["value"]: r["slot"] for r in pre.stages[0].table(spark).collect()}
    assert dict(zip(v[0].indices, v[0].values)) == {table["d7"]: 1.0, 301: 2.5}
    # the most frequent value fills, the smallest on ties; the median fills numbers
    assert dict(zip(v[1].indices, v[1].values)) == {table["d0"]: 1.0, 301: 449.0}
    assert dict(zip(v[2].indices, v[2].values)) == {}
    assert dict(zip(v[3].indices, v[3].values)) == {300: 1.0, 301: 1.0}
    names = D.slot_names(spark, out.schema["features"].metadata["slots"], [table["d7"], 300, 301])
    assert names == {table["d7"]: "driverId=d7", 300: "driverId=once", 301: "grid__n"}


def test_encoder_is_stored_with_its_dictionary(spark, tmp_path):
    train = spark.createDataFrame([(f"d{i % 9}", float(i % 5)) for i in range(60)], "driverId string, grid double")
    pre = prep.fit_preprocessor(train, ["driverId"], ["grid"], min_frequency=2)
    pre.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert loaded.stages[0].path.startswith(str(tmp_path)) and loaded.stages[0].uid == pre.stages[0].uid
    a, b = (sorted(map(str, p.transform(train).select(vector_to_array("features")).collect())) for p in (pre, loaded))
    assert a == b


def test_no_category_is_frequent(spark):
    train = spark.createDataFrame([("a",), ("b",)], "driverId string")
    out = prep.fit_preprocessor(train, ["driverId"], [], min_frequency=10).transform(train)
    assert [r["features"].toArray().tolist() for r in out.collect()] == [[1.0], [1.0]]


def test_sparse_parts_cost_what_is_set(spark):
    """As a dense array this vector would take 16 GB."""
    df = spark.createDataFrame([(Vectors.sparse(2_000_000_000, [5, 1_999_999_999], [1.0, 2.5]),)], ["features"])
    assert tuple(df.select(D.sparse_parts("features").alias("p")).first()["p"]) == (2_000_000_000, [5, 1_999_999_999], [1.0, 2.5])
