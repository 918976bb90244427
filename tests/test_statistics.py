"""Binning, stability, elimination, metrics and scorecard against small references."""

import math

import numpy as np
import pandas as pd
import pytest
from bureauflow.operators import (
    binning, calibration, cutoffs, elimination, metrics, models, psi, quality, scorecard, splitting,
)
from bureauflow.schema import SCHEMAS
from bureauflow.sources import tables as src
from pyspark.sql import functions as F

NAMES = ["o_totalprice", "c_acctbal", "n_lines", "sum_price", "signal"]


@pytest.fixture(scope="module")
def pdf(frame):
    return frame.toPandas()


def test_qcut_matches_pandas(frame, pdf):
    rows = binning.qcut(binning.long_form(frame, NAMES, ["uid"])).toPandas()
    for f in NAMES:
        want = pd.qcut(pdf[f], 10, labels=False, duplicates="drop").value_counts().sort_index()
        got = rows[rows.feature == f].bin.value_counts().sort_index()
        assert list(got) == list(want)


def test_information_value(frame, pdf):
    got = {r["feature"]: r["iv"] for r in binning.information_value(
        binning.long_form(frame, NAMES, ["target"])).collect()}
    for f in NAMES:
        d = pdf[[f, "target"]].dropna()
        b = pd.qcut(d[f], 10, labels=False, duplicates="drop")
        g = (d.target == 0).groupby(b).sum() / (d.target == 0).sum()
        m = (d.target == 1).groupby(b).sum() / (d.target == 1).sum()
        g, m = g.clip(lower=1e-6), m.clip(lower=1e-6)
        assert got[f] == pytest.approx(((g - m) * np.log(g / m)).sum(), rel=1e-9)


def test_monotonic_bins(frame):
    bins = binning.fit_woe(frame, NAMES).toPandas()
    for _, g in bins[bins.bin_id >= 0].groupby("feature"):
        step = np.diff(g.sort_values("bin_id").woe)
        assert len(g) <= 2 or (step >= 0).all() or (step <= 0).all()
    assert bins.groupby("feature").n.sum().eq(frame.count()).all()
    summary = binning.iv_summary(binning.fit_woe(frame, NAMES)).toPandas()
    assert summary.is_monotonic.all()


def test_woe_encode_edges(spark, frame):
    bins = binning.fit_bins(frame, ["c_acctbal"])
    rows = {r["bin_id"]: r for r in bins.collect()}
    odd = spark.createDataFrame([(-1e9,), (1e9,), (None,)], "c_acctbal double")
    got = [r["c_acctbal_woe"] for r in binning.woe_encode(odd, bins).collect()]
    assert got == [rows[0]["woe"], rows[max(rows)]["woe"], 0.0]


def _psi(a, b, n=10):
    edges = np.unique(np.quantile(a, np.linspace(0, 1, n + 1)))
    edges[0], edges[-1] = -np.inf, np.inf
    e = np.histogram(-a, -edges[::-1])[0] / len(a)  # right-closed bins
    x = np.histogram(-b, -edges[::-1])[0] / len(b)
    e, x = np.maximum(e, 1e-4), np.maximum(x, 1e-4)
    return ((x - e) * np.log(x / e)).sum()


def test_psi(frame, pdf):
    base, cmp = psi.date_split(frame, "date", "1997-12-31")
    long = lambda d, k: binning.long_form(d, ["o_totalprice"], k)
    got = psi.psi(long(base, ["base_id"]), long(cmp, ["base_id", "label"])).first()["psi"]
    old = pd.to_datetime(pdf.date) <= "1997-12-31"
    assert got == pytest.approx(_psi(pdf[old].o_totalprice.values, pdf[~old].o_totalprice.values))


def test_same_population_has_no_psi(frame):
    base = psi.fit_baseline(binning.long_form(frame, NAMES))
    out = psi.monitor(base, binning.long_form(frame, NAMES))
    assert all(abs(r["psi"]) < 1e-12 and r["status"] == "stable" for r in out.collect())
    assert psi.alerts(out).count() == 0


def test_perfect_and_useless_scores(spark):
    rows = [(i % 2, float(i % 2), 0.5) for i in range(40)]
    df = spark.createDataFrame(rows, "target int, perfect double, flat double")
    good = metrics.auc_table(df, "perfect", "target").first()
    assert good["gini"] == 1 and good["ks"] == 1
    flat = metrics.auc_table(df, "flat", "target").first()
    assert flat["auc"] == 0.5 and flat["ks"] == 0
    assert metrics.auc_table(df.where("target = 1"), "flat", "target").first()["auc"] is None


def test_greedy_correlation(frame, pdf):
    names = ["n_lines", "sum_qty", "sum_price", "c_acctbal"]
    iv = {"n_lines": 0.1, "sum_qty": 0.3, "sum_price": 0.2, "c_acctbal": 0.05}
    pairs = elimination.correlation_pairs(frame, names)
    got = {r["feature"]: r["status"] for r in
           elimination.correlation_filter(pairs, names, iv, 0.7).collect()}
    corr, lost = pdf[names].corr().abs(), set()
    for a in sorted(names, key=lambda f: -iv[f]):
        if a not in lost:
            lost |= {b for b in names if b != a and b not in lost and corr.loc[a, b] > 0.7}
    assert {f for f, s in got.items() if s == "Eliminated"} == lost and lost


def test_vif(frame, pdf):
    names = ["n_lines", "sum_qty", "sum_price", "c_acctbal"]
    out = elimination.vif_filter(elimination.correlation_pairs(frame, names), names).collect()
    want = dict(zip(names, np.diag(np.linalg.inv(pdf[names].corr().values))))
    for r in out:
        assert r["vif_initial"] == pytest.approx(want[r["feature"]], rel=1e-6)
        assert r["status"] == "Eliminated" or r["vif_final"] <= 5


def test_one_standard_error():
    assert models.one_standard_error([0.6, 0.69, 0.7, 0.695], [0.01, 0.02, 0.02, 0.01]) == 1
    assert models.one_standard_error([0.5, 0.7], [0.0, 0.0]) == 1


def test_chi_squared_tail():
    assert calibration.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert calibration.chi2_tail(5.991464547107979, 2) == pytest.approx(0.05, rel=1e-9)
    assert calibration.chi2_tail(15.50731305586545, 8) == pytest.approx(0.05, rel=1e-9)
    assert calibration.chi2_tail(14.067140449340169, 7) == pytest.approx(0.05, rel=1e-9)


@pytest.mark.parametrize("method", ["platt", "isotonic", "temperature"])
def test_calibration_stays_a_probability(frame, method):
    out = calibration.METHODS[method](frame, "score", "target")
    r = out.agg(F.min("calibrated").alias("lo"), F.max("calibrated").alias("hi")).first()
    assert 0 <= r["lo"] <= r["hi"] <= 1


def test_isotonic_improves_brier(frame):
    r = calibration.calibration_result(frame, "score", "target", "isotonic").first()
    assert r["brier_after"] <= r["brier_before"]


def test_split(frame):
    s = splitting.stratified_split(frame, "2000-06-30").persist()
    again = splitting.stratified_split(frame.repartition(7), "2000-06-30")
    assert s.select("uid", "split").exceptAll(again.select("uid", "split")).count() == 0
    assert s.count() == frame.count() and s.select("uid").distinct().count() == s.count()
    meta = {r["split"]: r for r in splitting.split_metadata(s).collect()}
    assert meta["test"]["bad_rate"] == pytest.approx(meta["train"]["bad_rate"], abs=0.01)
    assert {x for x in meta if x.startswith("oot_")}
    with pytest.raises(ValueError):
        splitting.validate_target(frame.where("target = 1"))


def test_scorecard_points(spark):
    bins = spark.createDataFrame(
        [("f", 0, 0.0, 1.0, 10, 5, 5, 0.5, 0.1), ("f", 1, 1.5, 3.0, 10, 5, 5, -0.5, 0.1),
         ("f", -1, None, None, 2, 1, 1, 0.2, 0.0)], binning.BINS_SCHEMA)
    card = scorecard.build_scorecard(bins, {"f": -1.0}, 0.1)
    factor = 20 / math.log(2)
    base = 600 - factor * math.log(50) - factor * 0.1
    got = {r["bin_id"]: r["points"] for r in card.collect()}
    assert got == {0: round(base + factor * 0.5), 1: round(base - factor * 0.5), -1: round(base + factor * 0.2)}
    rows = spark.createDataFrame([(0.5,), (1.2,), (2.0,), (None,)], "f double")
    out = [r["scorecard_score"] for r in scorecard.score_rows(rows, card, None, None).collect()]
    assert out == [got[0], 0, got[1], got[-1]]


def test_cutoffs(frame, pdf):
    r = cutoffs.approval_cutoff(frame, "score", 0.6).first()
    assert r["cutoff"] == pytest.approx(np.percentile(pdf.score, 40))
    table = cutoffs.at_cutoffs(frame, "score", "target", [0.4]).first()
    assert table["approval_rate"] == pytest.approx((pdf.score >= 0.4).mean())
    assert table["tp"] + table["fn"] == pdf.target.sum()
    assert cutoffs.several_cutoffs(frame, "score", "target").count() == 4


def test_quality_gate(small):
    apps, bureau = small
    bad = quality.report([quality.null_checks(bureau, {"default_date": 0.0})])
    with pytest.raises(quality.QualityError):
        quality.require(bad)
    quality.require(quality.null_checks(bureau, {"product_type": 0.0}))
    assert quality.validate_schema(apps, SCHEMAS["applications"]).count() == 0
    with pytest.raises(quality.QualityError):
        quality.validate_and_raise(apps.drop("target"), SCHEMAS["applications"])
    wrong = apps.withColumn("target", F.col("target").cast("string"))
    assert quality.validate_schema(wrong, SCHEMAS["applications"]).first()["issue"] == "type"


def test_csv_round_trip(spark, small, tmp_path):
    apps, _ = small
    path = str(tmp_path / "apps")
    apps.write.option("header", True).csv(path)
    back = src.read_files(spark, path, "csv", SCHEMAS["applications"])
    assert back.exceptAll(apps).count() == 0 and back.count() == apps.count()


def test_selection_steps(frame):
    data = frame.fillna(0)
    chosen, steps = models.sequential_selection(
        data, ["signal", "c_acctbal"], folds=2, max_features=2)
    assert chosen[0] == "signal" and steps.where("optimal").count() == 1
    _, back = models.sequential_selection(
        data, ["signal", "c_acctbal"], direction="backward", folds=2)
    assert back.first()["feature"] == "c_acctbal"
