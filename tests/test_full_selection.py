"""Selection, tuning and importance queries cover all features with the operators' own bounds."""

import pytest
from pyspark.sql import functions as F

from bureauflow.operators import models
from bureauflow.plans import catalog

SMALL = "/root/testdata/sf0.001"


def features_of(df):
    return {r["feature"] for r in df.collect()}


def test_all_features_are_candidates(spark):
    assert features_of(catalog.e9_forward_by_gain(spark, SMALL)) == set(catalog.PAIRED)
    assert features_of(catalog.l1_logistic(spark, SMALL)) == {*(f"{f}_woe" for f in catalog.PAIRED), "(intercept)"}


@pytest.mark.parametrize("name", ["e10_sequential_selection", "l2_boosted", "l3_grid_search", "m18_importance"])
def test_operators_run_with_their_own_bounds(spark, monkeypatch, name):
    seen = []

    def noted(df, features, *args, **given):
        seen.append((list(features), given))
        raise InterruptedError

    for f in ("sequential_selection", "fit_boosted", "grid_search"):
        monkeypatch.setattr(models, f, noted)
    with pytest.raises(InterruptedError):
        catalog.QUERIES[name](spark, SMALL)
    assert seen == [(catalog.PAIRED, {})]


def test_grid_search_grows_all_trees(spark, monkeypatch):
    kept, fit = [], models.fit_boosted
    run = models.grid_search

    def noted(df, features, grid, **given):
        def grown(*args, **params):
            kept.append((list(args[1]), fit(*args, **params)))
            return kept[-1][1]

        return run(df, features, grid, fit=grown, **given)

    monkeypatch.setattr(models, "grid_search", noted)
    catalog.l3_grid_search(spark, SMALL)
    assert [(f, m.stages[-1].getNumTrees) for f, m in kept] == [(catalog.PAIRED, 20)] * 2


def test_fold_frames_weigh_as_each_fold_alone(frame):
    data = models.fold_column(frame, folds=3)
    for k, (rows, held) in enumerate(models.fold_frames(data, "target", 3)):
        own = models._weights(data.where(F.col("fold") != k), "target")
        assert rows.exceptAll(own).isEmpty() and own.exceptAll(rows).isEmpty()
        assert held.where(F.col("fold") != k).isEmpty()
