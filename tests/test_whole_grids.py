"""Single fits and searches run the settings of the whole grids."""

import pytest

from pitwall.models import estimators as M
from pitwall.queries import QUERIES, fitted


def test_single_fits_run_to_their_end():
    svc = M.linear_svc({"C": 1.0}, M.Facts(100), 42)
    assert svc.getMaxIter() >= 1_000 and "max_iter" not in fitted._candidate(M.classifiers(), "linear_svc").grid[0]


def test_the_search_runs_whole_grids(monkeypatch):
    pools = {}
    monkeypatch.setattr(fitted, "cls_sides", lambda *a: (None, None))
    monkeypatch.setattr(fitted, "materialise", lambda df: type("Rows", (), {"drop": lambda *a: None})())
    monkeypatch.setattr(fitted.G, "fold_stratified", lambda *a: None)
    monkeypatch.setattr(fitted.T, "stratified_splits", lambda *a: [])

    def stop(train, test, splits, pool, **rest):
        pools.update({c.name: list(c.grid) for c in pool})
        raise InterruptedError

    monkeypatch.setattr(fitted.T, "tournament", stop)
    with pytest.raises(InterruptedError):
        fitted.eval_grid_cv(None, "")
    assert {p["C"] for p in pools["logreg"]} == {0.1, 1.0, 10.0} and {p["C"] for p in pools["linear_svc"]} == {0.5, 1.0, 2.0}
    assert not any("max_iter" in p for grid in pools.values() for p in grid)


@pytest.mark.parametrize("name,trees", [("model_rf_cls", 300)])
def test_the_forest_is_a_point_of_the_whole_grid(monkeypatch, name, trees):
    seen = {}

    def stop(spark, sf, model, params=None, weighted=None):
        seen.update(params)
        raise InterruptedError

    monkeypatch.setattr(fitted, "_fit_cls", stop)
    with pytest.raises(InterruptedError):
        QUERIES[name](None, "")
    assert seen["n_estimators"] >= trees and seen in fitted._candidate(M.classifiers(full=True), "rf").grid
