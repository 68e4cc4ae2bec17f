"""NULLs, line breaks, large ids and folders: what an earlier version got wrong."""

import pytest
from pyspark.sql import functions as F

from pitwall import session as S
from pitwall.models import prep
from pitwall.operators import sampling as G
from pitwall.operators.scan import prefix_scan, value_slices
from pitwall.sources import tables as IO


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame([(i, None if i % 10 == 0 else "ab"[i % 2]) for i in range(100)], "id long, label string")


def test_rows_without_a_label_stay(labelled):
    split = G.split_stratified(labelled, ["id"], "label").collect()
    assert len(split) == 100 and sum(r["split"] == "test" for r in split if r["label"] is None) == 2
    folds = G.fold_stratified(labelled, ["id"], "label").collect()
    assert len(folds) == 100 and all(r["fold"] is not None for r in folds)
    assert G.fold_group(labelled, "label").count() == 100
    weights = {r["label"]: r["weight"] for r in prep.class_weights(labelled, "label").collect()}
    assert weights[None] == pytest.approx(100 / (3 * 10))
    assert len(G.sample_rows(labelled, ["id"], 7).collect()) == 7


@pytest.mark.parametrize("rows_per_slice", [10, 1000])
@pytest.mark.parametrize("descending", [False, True])
def test_sliced_sums_with_null_nan_and_ties(spark, rows_per_slice, descending):
    values = [None, float("nan"), 1.0, 1.0, 2.0, -3.0, float("inf"), 0.5] * 20
    df = spark.createDataFrame([(i, v, i % 7) for i, v in enumerate(values)], "id long, x double, n long")
    sliced = value_slices(df, "x", name="slice", rows_per_slice=rows_per_slice)
    got = prefix_scan(sliced, order=["x", "id"], slices=["slice"], count="c", sums={"before": "n"}, descending=descending)
    order = [F.col(c).desc() if descending else F.col(c) for c in ("x", "id")]
    from pyspark.sql import Window

    plain = df.withColumn("c", F.row_number().over(Window.orderBy(*order)) - 1).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    key = lambda d: sorted((r["id"], r["c"], r["before"]) for r in d.collect())
    assert key(got) == key(plain)


@pytest.mark.parametrize("bom", [False, True])
def test_own_csv_keeps_every_cell(spark, tmp_path, bom):
    rows = [("a\nb", 1), ('say "x", y', 2), ("  blanks  ", 3), ("", 4), (None, None), ("é\r\nü", 2**62 + 1)]
    df = spark.createDataFrame(rows, "text string, n long")
    IO.write_csv(df, str(tmp_path / "t"), bom=bom)
    got = IO.read_own_csv(spark, str(tmp_path / "t"), df.schema).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.shared_folder(Session())
