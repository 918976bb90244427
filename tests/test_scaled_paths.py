"""Operators that work in ranges, rounds and batches, against plain versions and with tiny ranges."""

import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from bureauflow.functions import ranking
from bureauflow.operators import binning, calibration, cutoffs, elimination, metrics, models, newton, psi
from bureauflow.plans import catalog
from pyspark.sql import functions as F

NAMES = ["o_totalprice", "c_acctbal", "signal"]


def jobs_of(spark, build):
    """Number of jobs that run while build() makes a plan."""
    group = f"plan-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_runs_while_plans_are_built(spark, frame):
    fine = frame.withColumn("fine", F.col("o_totalprice"))
    plans = [
        lambda: ranking.quantiles(fine, [], "fine", [0.5], max_group=10),
        lambda: ranking.first_k(fine, "signal", "uid", F.lit(10), ["segment"], max_group=10),
        lambda: psi.plan_psi(psi.by_period(frame), NAMES),
        lambda: psi.plan_psi(psi.by_halves(frame), NAMES),
        lambda: psi.plan_psi(psi.by_consecutive_quarters(frame), NAMES),
        lambda: calibration.isotonic(fine, "fine", "target"),
        lambda: models.bootstrap_auc(fine, "fine", "target", "segment", 20),
        lambda: cutoffs.several_cutoffs(fine, "fine", "target"),
        lambda: elimination.correlation_pairs(frame, NAMES, "spearman"),
    ]
    assert [jobs_of(spark, p) for p in plans] == [0] * len(plans)


def plain_isotonic(pairs):
    """{score: value} by pooling adjacent violators, one score at a time."""
    blocks = []
    for score in sorted({s for s, _ in pairs}):
        own = [y for s, y in pairs if s == score]
        blocks.append([[score], len(own), sum(own)])
        while len(blocks) > 1 and Fraction(blocks[-2][2], blocks[-2][1]) >= Fraction(blocks[-1][2], blocks[-1][1]):
            scores, n, bad = blocks.pop()
            blocks[-1] = [blocks[-1][0] + scores, blocks[-1][1] + n, blocks[-1][2] + bad]
    return {s: bad / n for scores, n, bad in blocks for s in scores}


@pytest.mark.parametrize("sizes", [(20, 3, 2), (4_096, 256, 3)])
def test_isotonic_steps(spark, frame, monkeypatch, sizes):
    for name, value in zip(("RANGE_ROWS", "FAN_IN", "ROUNDS"), sizes):
        monkeypatch.setattr(calibration, name, value)
    for score in (F.col("o_totalprice"), F.col("signal"), -F.col("o_totalprice"), F.lit(0.5)):
        rows = frame.select(score.cast("double").alias("s"), "target")
        want = plain_isotonic([tuple(r) for r in rows.collect()])
        got = {r["score"]: r["calibrated"] for r in calibration.isotonic_steps(rows, "s", "target").collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    assert calibration.isotonic_steps(frame.limit(0), "signal", "target").collect() == []


def test_isotonic_keeps_rows_without_score(frame):
    rows = frame.withColumn("s", F.when(F.col("uid") % 3 != 0, F.col("signal")))
    out = calibration.isotonic(rows, "s", "target")
    assert out.count() == rows.count()
    assert out.where(F.col("s").isNull() != F.col("calibrated").isNull()).isEmpty()


def test_bootstrap_in_small_ranges(frame, monkeypatch):
    run = lambda: sorted(models.bootstrap_auc(frame, "o_totalprice", "target", "segment", 40).collect())
    whole = run()
    monkeypatch.setattr(models, "RANGE_ROWS", 7)
    monkeypatch.setattr(models, "FAN_IN", 3)
    monkeypatch.setattr(models, "BLOCK", 2)
    for a, b in zip(whole, run()):
        assert a[:3] == b[:3] and a[3:5] == pytest.approx(b[3:5], abs=1e-12)


def test_poisson_draws_follow_the_distribution():
    u = (np.arange(20_000) + 0.5)[None] / 20_000
    for mean in (1, 7, 1_000, 10**7):
        x = models.poisson_draws(u, np.array([mean]))[0]
        assert x.mean() == pytest.approx(mean, rel=0.01) and x.var() == pytest.approx(mean, rel=0.02)
    assert (models.poisson_draws(u, np.array([0])) == 0).all()
    keys = np.arange(50)
    v = models.uniforms(keys, np.arange(400))
    assert len(np.unique(v)) == v.size and abs(v.mean() - 0.5) < 0.01


def test_newton_fits_equal_spark_s(frame):
    rows = frame.select(*NAMES, "target", "uid").fillna(0)
    data = models.fold_column(rows, folds=3)
    sets = [["signal"], ["signal", "o_totalprice"], NAMES]
    fits, stats = newton.fit_many(data, NAMES, sets, "target", [-1, 1])
    for k, own in enumerate(sets):
        for number, fold in enumerate((-1, 1)):
            fit = fits[2 * k + number]
            model = models.fit_logistic(data.where(F.col("fold") != fold), own).stages[-1]
            assert np.allclose(fit.beta[:-1], model.coefficients.toArray(), atol=2e-4)
            assert fit.beta[-1] == pytest.approx(model.intercept, abs=2e-4)
    scores = newton.held_out_scores(data, NAMES, fits[5:6], stats, [7], "target")
    assert scores.count() == data.where("fold = 1").count() and scores.first()["set"] == 7


def test_selection_is_the_same_fitted_together_or_one_by_one(frame):
    rows = frame.select(*NAMES, "target", "uid").fillna(0)
    alone = lambda *args, **given: models.fit_logistic(*args, **given)
    together = models.sequential_selection(rows, NAMES, folds=2)
    one_by_one = models.sequential_selection(rows, NAMES, folds=2, fit=alone)
    assert together[0] == one_by_one[0]
    for a, b in zip(together[1].orderBy("step").collect(), one_by_one[1].orderBy("step").collect()):
        assert a[:3] == b[:3] and a["mean_auc"] == pytest.approx(b["mean_auc"], abs=1e-3)
    back = models.sequential_selection(rows, NAMES, folds=2, direction="backward")
    assert set(back[0]) <= set(NAMES)


def test_spearman_of_many_features(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(120, 300)), 1)
    x[rng.random(x.shape) < 0.4] = 0
    x[:, 7], x[3:40] = 2.0, x[2]
    names = [f"f{k}" for k in range(300)]
    got = elimination.correlation_pairs(spark.createDataFrame(pd.DataFrame(x, columns=names)), names, "spearman").toPandas()
    want = np.corrcoef(pd.DataFrame(x).rank().to_numpy().T)
    at = {n: k for k, n in enumerate(names)}
    expected = np.array([want[at[a], at[b]] for a, b in zip(got.feature_a, got.feature_b)])
    assert len(got) == 300 * 299 // 2 and np.allclose(got.correlation.astype(float), expected, atol=1e-9, equal_nan=True)


@pytest.mark.parametrize("sizes", [(1, 64, 2), (3, 7, 1), (32, 64, 64)])
def test_spearman_blocks_and_ranges(spark, monkeypatch, sizes):
    """Ranks across blocks and ranges, with ties, equal rows, negative, missing, infinite and constant values; the rows' matrices are made once."""
    for name, value in zip(("BLOCKS", "RANGES", "LEAST_IN_RANGE"), sizes):
        monkeypatch.setattr(elimination, name, value)
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(3_000, 4)) * [1, 10, 100, 1], 1)
    x[rng.random(x.shape) < 0.2] = 0
    x[:1_000], x[5, 0], x[6, 1], x[:, 3] = x[0], np.inf, -np.inf, -2.0
    x[1_500:1_600, 2] = np.nan
    names = list("abcd")
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    result = elimination.correlation_pairs(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)), names, "spearman")
    got = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in result.collect()}
    want = np.corrcoef(pd.DataFrame(np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)).rank().to_numpy().T[:3])
    assert len(got) == 6 and all(got[n, "d"] is None for n in "abc")
    assert all(got[names[a], names[b]] == pytest.approx(want[a, b], abs=1e-9) for a in range(3) for b in range(a + 1, 3))
    assert result._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[2].count("moments(") == 1


def test_monotonic_and_small_bins(spark):
    rng = random.Random(4)
    schema = binning.BINS_SCHEMA
    rows = []
    for f in range(12):
        for k in range(rng.randrange(1, 11)):
            n, bad = rng.randrange(2, 300), 0
            bad = rng.randrange(1, n)
            rows.append((f"f{f}", k, float(k), k + 0.5, n, n - bad, bad, 0.0, 0.0))
        rows.append((f"f{f}", -1, None, None, 5, 3, 2, 0.0, 0.0))
    totals = (sum(r[5] for r in rows), sum(r[6] for r in rows))
    woe = lambda g, b: float(np.log(max(g / totals[0], 1e-6) / max(b / totals[1], 1e-6)))

    def monotonic(bins):
        bins = [list(b) for b in bins]
        while len(bins) > 2:
            w = [woe(b[5], b[6]) for b in bins]
            sign = 1 if w[-1] >= w[0] else -1
            off = [k for k in range(len(bins) - 1) if sign * (w[k + 1] - w[k]) < 0]
            if not off:
                break
            a, b = bins[off[0]], bins.pop(off[0] + 1)
            a[3], a[4], a[5], a[6] = b[3], a[4] + b[4], a[5] + b[5], a[6] + b[6]
        return bins

    from pyspark.sql.functions import lit

    frame = spark.createDataFrame(rows, schema).withColumn("woe", lit(0.0))
    frame = binning._with_woe(frame, totals)
    got = {}
    for r in binning.make_monotonic(frame, totals).collect():
        got.setdefault(r["feature"], []).append(r)
    for f in {r[0] for r in rows}:
        want = monotonic(sorted(r for r in rows if r[0] == f and r[1] >= 0))
        own = sorted((r for r in got[f] if r["bin_id"] >= 0), key=lambda r: r["bin_id"])
        assert [tuple(r)[1:7] for r in own] == [tuple(b)[1:7] for b in want]
        assert all(r["woe"] == pytest.approx(woe(r["good"], r["bad"])) for r in own)
        assert sum(r["bin_id"] == -1 for r in got[f]) == 1


def test_runs_are_replaced_and_compared(spark, tmp_path):
    folder = str(tmp_path / "runs")
    run = lambda psis: spark.createDataFrame([(f, p, s) for f, p, s in psis], "feature string, psi double, status string")
    psi.record_run(run([("a", 0.01, "stable"), ("b", 0.3, "critical")]), folder, "2024-01-31")
    psi.record_run(run([("a", 0.9, "critical")]), folder, "2024-02-29")
    psi.record_run(run([("a", 0.2, "warning"), ("b", 0.2, "warning")]), folder, "2024-02-29")
    runs = psi.read_runs(spark, folder)
    assert sorted((str(r["run_date"]), r["features"], r["stable"], r["warning"], r["critical"]) for r in psi.run_history(runs).collect()) == [
        ("2024-01-31", 2, 1, 0, 1), ("2024-02-29", 2, 0, 2, 0)]
    found = {(str(r["run_date"]), r["feature"], r["change"], r["previous_status"]) for r in psi.status_changes(runs).collect()}
    assert found == {("2024-01-31", "b", "new", None), ("2024-02-29", "a", "worse", "stable"), ("2024-02-29", "b", "better", "critical")}
    assert psi.read_runs(spark, folder, "2024-02-01").count() == 2


def test_sketch_cuts_are_within_their_bound(frame):
    long = binning.long_form(frame, NAMES)
    for r in binning.rank_errors(long, [0.1, 0.5, 0.9]).collect():
        assert r["rank_error"] <= 2 * r["bound"]
    out = binning.approximate_bins(frame, "sum_price", 4).groupBy("sum_price_bin").count().collect()
    assert sum(r["count"] for r in out) == frame.count() and 4 <= len(out) <= 5


def test_several_cutoffs_of_an_empty_frame(frame):
    rows = frame.withColumn("safe", 1 - F.col("score"))
    assert cutoffs.several_cutoffs(rows.limit(0), "safe", "target").collect() == []
    assert {r["method"] for r in cutoffs.several_cutoffs(rows, "safe", "target").collect()} == {"ks", "approval_50", "approval_70", "bad_rate_5"}


def test_formulas_of_the_dictionary(spark):
    from bureauflow.operators import registry

    rows = registry.registry(spark).collect()
    assert all(r["formula"] and "compute(" not in r["formula"] for r in rows)
    assert len({r["name"] for r in rows}) == len(rows)


def test_repeated_applications_count_once(small):
    from bureauflow.operators.extractor import extract_features

    apps, bureau = small
    once = extract_features(apps, bureau)
    twice = extract_features(apps.union(apps.withColumn("application_date", F.date_add("application_date", 3))), bureau)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_catalog_has_the_over_full_queries():
    assert {"f10_sequence_over_full", "f33_payment_behavior_over_full"} <= set(catalog.QUERIES)


def test_held_out_auc_by_ranges_is_exact(frame):
    rows = frame.select(*NAMES, "target", "uid").fillna(0)
    data = models.fold_column(rows.unionByName(rows), folds=3).repartition(5).persist()  # every score is tied
    sets = [["signal"], NAMES]
    fits, stats = newton.fit_many(data, NAMES, sets, "target", [0, 1, 2])
    number = [0, 0, 0, 1, 1, 1]
    scores = newton.held_out_scores(data, NAMES, fits, stats, number, "target")
    want = {(r["set"], r["fold"]): r["auc"] for r in metrics.auc_table(scores, "score", "target", ["set", "fold"]).collect()}
    n = data.count()
    for drawn, size in ((newton.draw(data, NAMES, n), n), (newton.draw(data, NAMES, n), 20), (np.zeros((0, 3)), 20)):
        got = newton.held_out_aucs(data, NAMES, fits, stats, number, drawn, n / 3, "target", range_rows=size)
        assert {(r["set"], r["fold"]): r["auc"] for r in got.collect()} == pytest.approx(want, abs=1e-12)
    one_class = newton.held_out_aucs(data.where("target = 1"), NAMES, fits[:1], stats, [0], drawn, n / 3, "target")
    assert [r["auc"] for r in one_class.collect()] == [None]
    data.unpersist()


def test_selection_sends_no_row_for_a_score(spark, frame, monkeypatch):
    """The AUCs of a step are not read off a table of a row for every score, which is sent and sorted twice."""
    monkeypatch.setattr(newton, "held_out_scores", lambda *_: pytest.fail("scores are laid out"))
    rows = frame.select(*NAMES, "target", "uid").fillna(0)
    assert models.sequential_selection(rows, NAMES, folds=2)[0]
    assert models.forward_by_gain(rows, rows, NAMES).count() == 3
