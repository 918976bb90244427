"""Checks, samples and correlations in the cases that a plain frame doesn't show."""

import numpy as np
import pandas as pd
from bureauflow.operators import binning, elimination, models, psi, quality, splitting
from bureauflow.sources import tables
from pyspark.sql import functions as F


def _status(df):
    return {r["check_name"]: (r["status"], r["severity"]) for r in df.collect()}


def test_missing_columns_fail_their_checks(spark, frame):
    names = ["o_totalprice", "signal"]
    plain = _status(quality.pre_model_checks(frame, names))
    assert plain["target_exists"][0] == "PASS" and plain["date_exists"][0] == "PASS"
    bare = _status(quality.pre_model_checks(frame.drop("target", "date", "uid"), names))
    assert bare["target_exists"] == ("FAIL", "critical") and bare["date_exists"] == ("FAIL", "critical")
    assert not {"target_binary", "bad_rate_range", "date_coverage", "leakage"} & set(bare)
    none = _status(quality.pre_model_checks(frame.limit(0), names))
    assert {none[k][0] for k in ("non_empty", "date_exists", "date_coverage", "bad_rate_range")} == {"FAIL"}


def test_bad_rate_severity_and_single_class(frame):
    rare = frame.withColumn("target", F.when(F.col("uid") % 500 == 0, 1).otherwise(0))
    assert _status(quality.pre_model_checks(rare, ["signal"]))["bad_rate_range"] == ("FAIL", "critical")
    one = _status(quality.pre_model_checks(frame.withColumn("target", F.lit(1)), ["signal"]))
    assert one["leakage"] == ("WARNING", "warning")


def test_every_feature_is_tested_for_leakage(frame):
    wide = frame.withColumns({f"noise{k}": F.rand(k) * 1000 for k in range(60)})
    wide = wide.withColumn("leak", F.col("target") * 0.001)
    names = [f"noise{k}" for k in range(60)] + ["leak"]
    assert _status(quality.pre_model_checks(wide, names))["leakage"][0] == "WARNING"


def test_monitor_keeps_features_without_current_values(frame):
    names = ["o_totalprice", "signal"]
    baseline = psi.fit_baseline(binning.long_form(frame, names, []))
    gone = frame.withColumn("signal", F.lit(None).cast("double"))
    now = binning.long_form(gone, names, [])
    assert {r["feature"] for r in psi.monitor(baseline, now).collect()} == set(names)


def test_samples_and_splits_do_not_depend_on_partitions(frame):
    a, b = (tables.bounded(frame.repartition(n), 100, ["uid"]) for n in (2, 7))
    assert sorted(r["uid"] for r in a.collect()) == sorted(r["uid"] for r in b.collect())
    assert a.count() == 100
    x, y = (splitting.random_split(frame.repartition(n)).select("uid", "split") for n in (2, 7))
    assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 120)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 3.0
    names = [f"c{k}" for k in range(x.shape[1])]
    pdf = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{n} double" for n in names))
    pairs = elimination.correlation_pairs(df.repartition(5), names)
    size = lambda q: len(q._jdf.queryExecution().optimizedPlan().toString())
    half = elimination.correlation_pairs(df, names[:60])
    assert size(pairs) < 2.6 * size(half)
    want = pdf.corr().to_numpy()
    index = {n: k for k, n in enumerate(names)}
    rows = pairs.collect()
    assert len(rows) == 120 * 119 // 2
    for r in rows:
        w = want[index[r["feature_a"]], index[r["feature_b"]]]
        assert r["correlation"] is None if np.isnan(w) else abs(r["correlation"] - w) < 1e-6


def test_greedy_filter_and_inflation(spark):
    pairs = spark.createDataFrame(
        [("a", "b", 0.95), ("a", "c", 0.2), ("b", "c", -0.92), ("a", "d", None), ("b", "d", 0.1), ("c", "d", 0.0)],
        "feature_a string, feature_b string, correlation double",
    )
    out = {r["feature"]: (r["status"], r["eliminated_by"]) for r in elimination.correlation_filter(pairs, list("abcd"), {"b": 0.1, "a": 0.3, "c": 0.2, "d": 0.0}).collect()}
    assert out == {"a": ("Kept", None), "b": ("Eliminated", "a"), "c": ("Kept", None), "d": ("Kept", None)}
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4))
    x = np.column_stack([x, x[:, 0] + 0.1 * rng.normal(size=300)])
    names = list("vwxyz")
    m = np.corrcoef(x.T)
    table = spark.createDataFrame([(names[i], names[j], float(m[i, j])) for i in range(5) for j in range(i + 1, 5)], "feature_a string, feature_b string, correlation double")
    rows = {r["feature"]: r for r in elimination.vif_filter(table, names).collect()}
    inflation = np.diag(np.linalg.inv(m))
    worst = names[int(np.argmax(inflation))]
    assert rows[worst]["status"] == "Eliminated" and rows[worst]["round"] == 1
    left = [k for k in range(5) if names[k] != worst]
    after = np.diag(np.linalg.inv(m[np.ix_(left, left)]))
    for k, v in zip(left, after, strict=True):
        assert abs(rows[names[k]]["vif_final"] - v) < 1e-9 and abs(rows[names[k]]["vif_initial"] - inflation[k]) < 1e-9


def test_bootstrap_is_the_same_in_every_partitioning(frame):
    fine = frame.withColumn("fine", F.col("score") + (F.col("uid") % 997) / 1e5)
    a, b = (
        {r["segment"]: r for r in models.bootstrap_auc(fine.repartition(n), "fine", "target", "segment", 60).collect()}
        for n in (2, 5)
    )
    assert a.keys() == b.keys()
    for k, r in a.items():
        assert abs(r["ci_lower"] - b[k]["ci_lower"]) < 1e-12 and r["iterations"] == 60
        assert r["ci_lower"] < r["auc"] < r["ci_upper"]
