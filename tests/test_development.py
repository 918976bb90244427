"""Both development runs from end to end on the model frame."""

from bureauflow.operators import models
from bureauflow.plans import development as dev
from bureauflow.plans import fixtures as fx


def test_develop_model(frame):
    out = dev.develop_model(
        frame.drop("quarter"), fx.MODEL_FEATURES, "2000-06-30", iv_range=(0.0, 10.0), max_psi=10,
        max_features=2, folds=2, fit=models.fit_logistic, segments=["segment"],
    )
    assert "signal" in out.features and "const_1" not in out.features
    perf = {r["period"]: r["auc"] for r in out.tables["performance"].collect()}
    assert perf["train"] > 0.7 and abs(perf["train"] - perf["test"]) < 0.1
    assert {"constant", "iv", "psi", "temporal", "selection", "lift"} <= set(out.tables)


def test_develop_scorecard(frame):
    out = dev.develop_scorecard(
        frame.drop("quarter"), fx.MODEL_FEATURES, "2000-06-30", iv_range=(0.0, 10.0), max_psi=10
    )
    assert "signal" in out.features
    rows = out.scored.select("target", "scorecard_score", "probability_bad").toPandas()
    # more points mean less risk
    assert rows[["scorecard_score", "probability_bad"]].corr().iloc[0, 1] < -0.9
    assert out.tables["cutoffs"].count() > 1


def test_distinct_values_are_counted_once(frame):
    """IV and AUC of a run's steps come from counted values, with the same tables, and don't expand the rows again."""
    import math

    from bureauflow.operators import elimination
    from pyspark.sql import functions as F

    names = ["signal", "o_totalprice", "avg_discount", "const_1"]
    data = dev.prepare(frame.drop("quarter"), "2000-06-30").persist()
    train = data.where("split = 'train'")
    counts = elimination.period_counts(data, names).persist()
    values = counts.where("split = 'train'").groupBy("feature", "value")
    values = values.agg(*[F.sum(x).alias(x) for x in ("n", "good", "bad")]).persist()

    def same(got, want):
        got, want = ({r["feature"]: r.asDict() for r in x.collect()} for x in (got, want))
        assert got.keys() == want.keys() and len(got)
        for f in want:
            for k, v in want[f].items():
                assert got[f][k] == v or math.isclose(got[f][k], v, rel_tol=1e-9, abs_tol=1e-12), (f, k)

    counted = elimination.iv_filter(train, names, values=values)
    same(counted, elimination.iv_filter(train, names))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" not in plan.split("InMemoryRelation")[0]
    same(elimination.temporal_filter(data, names[:3], counts=counts), elimination.temporal_filter(data, names[:3]))
    for x in (values, counts, data):
        x.unpersist()
