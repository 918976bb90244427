"""Paths for applicants and columns that do not fit one task give the same results."""

import math

import numpy as np
import pytest
from bureauflow.functions import ranking
from bureauflow.operators.families import FAMILIES, family_frame
from bureauflow.plans import catalog
from bureauflow.plans import features as ft
from bureauflow.schema import KEY
from pyspark.sql import functions as F


def _by_key(df):
    return {(r["application_id"], r["customer_id"]): r.asDict() for r in df.collect()}


def _same(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_overfull_applicants(small):
    apps, bureau = small
    # one applicant holds a third of all tradelines, several on the same day
    hot = bureau.where("application_id = 'APP_2'").select("application_id", "customer_id").first()
    extra = bureau.where("tradeline_id % 2 = 0").withColumns(
        {"application_id": F.lit(hot[0]), "customer_id": F.lit(hot[1])}
    )
    skewed = bureau.unionByName(extra)
    names = list(FAMILIES)
    plain = _by_key(family_frame(apps, skewed, names))
    split = _by_key(family_frame(apps, skewed, names, max_rows_per_key=12))
    assert plain.keys() == split.keys()
    wrong = {
        (f, k, plain[k][f], split[k][f])
        for k in plain for f in plain[k]
        if f not in KEY and not _same(plain[k][f], split[k][f])
    }
    assert not wrong, sorted(wrong, key=str)[:5]


def test_overfull_applicants_in_cube(small):
    apps, bureau = small
    key = lambda r: (r["application_id"], r["customer_id"], r["cube_product"], r["cube_window"], r["cube_status"])
    plain = {key(r): r for r in ft.cube_long(apps, bureau).collect()}
    split = {key(r): r for r in ft.cube_long(apps, bureau, max_rows_per_key=8).collect()}
    assert plain.keys() == split.keys()
    for k in plain:
        assert plain[k]["cnt"] == split[k]["cnt"] and plain[k]["sum"] == split[k]["sum"]
        assert _same(plain[k]["std"], split[k]["std"])


@pytest.mark.parametrize("limit", [10**9, 20])
def test_quantiles(frame, limit):
    pdf = frame.select("segment", "o_totalprice").toPandas()
    probs = [0.0, 0.1, 0.37, 0.5, 0.99, 1.0]
    got = ranking.quantiles(frame, ["segment"], "o_totalprice", probs, max_group=limit)
    for r in got.collect():
        want = np.quantile(pdf[pdf.segment == r["segment"]].o_totalprice, probs)
        assert np.allclose(r["q"], want, rtol=1e-12)


@pytest.mark.parametrize("limit", [10**9, 20])
def test_cumulative(frame, limit):
    rows = ranking.cumulative(frame, [], "signal", {"n": F.lit(1), "bad": F.col("target")}, limit)
    got = {r["signal"]: r for r in rows.collect()}
    pdf = frame.select("signal", "target").toPandas()
    for v, r in got.items():
        assert r["n_before"] == (pdf.signal < v).sum() and r["n"] == (pdf.signal == v).sum()
        assert r["bad_before"] == pdf[pdf.signal < v].target.sum()
        assert r["n_total"] == len(pdf)


@pytest.mark.parametrize("limit", [10**9, 20])
@pytest.mark.parametrize("by", [[], ["segment"]])
def test_first_k(frame, limit, by):
    k = F.floor(F.col("n_total") * 0.3)
    got = ranking.first_k(frame, "signal", "uid", k, by, limit).where("selected")
    pdf = frame.select("uid", "signal", "segment").toPandas().sort_values(["signal", "uid"])
    groups = [g for _, g in pdf.groupby("segment")] if by else [pdf]
    want = {u for g in groups for u in g.uid.head(int(len(g) * 0.3))}
    assert {r["uid"] for r in got.select("uid").collect()} == want


@pytest.mark.parametrize("by", [[], ["segment"]])
def test_few_large_groups_stay_where_they_are(frame, monkeypatch, by):
    """No join lays rows out by group alone: two classes would be two tasks."""
    monkeypatch.setattr(ranking, "FEW_GROUPS_FROM", 1)
    chosen = ranking.first_k(frame, "signal", "uid", F.floor(F.col("n_total") * 0.3), by, 20)
    pdf = frame.select("uid", "signal", "segment").toPandas().sort_values(["signal", "uid"])
    groups = [g for _, g in pdf.groupby("segment")] if by else [pdf]
    want = {u for g in groups for u in g.uid.head(int(len(g) * 0.3))}
    assert {r["uid"] for r in chosen.where("selected").select("uid").collect()} == want
    plan = chosen._jdf.queryExecution().sparkPlan().toString()
    joins = [x for x in plan.splitlines() if "SortMergeJoin" in x or "ShuffledHashJoin" in x]
    assert all("_chunk" in x for x in joins), joins


def test_range_of_a_value(spark):
    """As many cuts below as a comparison with each of them finds, for any number of cuts."""
    for n in (0, 1, 14, 15, 16, 17, 31, 32, 100, 255):
        cuts = [2 * i for i in range(n)]
        coarse = cuts[ranking.STRIDE - 1 :: ranking.STRIDE]
        rows = spark.range(-1, 2 * n + 2).select(
            "id", F.lit(cuts).cast("array<bigint>").alias("_cuts"), F.lit(coarse).cast("array<bigint>").alias("_coarse")
        )
        for r in rows.select("id", ranking._below("id").alias("below")).collect():
            assert r["below"] == sum(x < r["id"] for x in cuts)


def test_chunked_auc(spark, frame):
    from bureauflow.operators.metrics import auc_table
    from conftest import SMALL

    want = auc_table(frame, "o_totalprice", "target").first()["auc"]
    assert catalog.m1b_auc_chunked(spark, SMALL).first()["auc"] == round(want, 6)


def test_overfull_applicants_with_missing_values(small):
    """NULL dates, amounts and payments, an applicant of one day and one without defaults."""
    apps, bureau = small
    gap = lambda name, k: F.when(F.col("tradeline_id") % k != 0, F.col(name)).alias(name)
    gaps = {"opening_date": 4, "total_amount": 7}
    holes = bureau.select(*[gap(x, gaps[x]) if x in gaps else F.col(x) for x in bureau.columns])
    one_day = F.col("application_id") == "APP_3"
    clean = F.col("application_id") == "APP_5"
    holes = holes.withColumns(
        {
            "opening_date": F.when(one_day, F.lit("1996-05-05").cast("date")).otherwise(F.col("opening_date")),
            "default_date": F.when(~clean, F.col("default_date")),
        }
    )
    names = list(FAMILIES)
    plain = _by_key(family_frame(apps, holes, names))
    split = _by_key(family_frame(apps, holes, names, max_rows_per_key=5))
    assert plain.keys() == split.keys()
    wrong = {
        (f, k, plain[k][f], split[k][f])
        for k in plain for f in plain[k]
        if f not in KEY and not _same(plain[k][f], split[k][f])
    }
    assert not wrong, (len(wrong), sorted({w[0] for w in wrong}), sorted(wrong, key=str)[:5])


def test_overfull_applicants_write_what_is_read(small, monkeypatch):
    """Gaps need days: neither amounts nor names of applicants are written and exchanged with the rows."""
    from bureauflow.operators import profile

    written = []
    save = profile.src.save_artefact
    monkeypatch.setattr(profile.src, "save_artefact", lambda df, path: (written.append(set(df.columns)), save(df, path)))
    apps, bureau = small
    plain = _by_key(family_frame(apps, bureau, ["interval"]))
    split = _by_key(family_frame(apps, bureau, ["interval"], max_rows_per_key=3))
    assert all(_same(plain[k][f], split[k][f]) for k in plain for f in plain[k] if f not in KEY)
    rows = [x for x in written if not x & set(KEY)]
    assert rows and all(not x & {"amt", "product", "total_amount", "payment"} for x in rows), rows
    assert len(written) == len(rows) + 2  # the numbers of the applicants, and their result


@pytest.mark.parametrize("size", [6, 10**9])
def test_distribution_of_overfull_applicants(small, monkeypatch, size):
    """Applicants of more values than fit a task get the same distribution."""
    from bureauflow.operators import profile

    monkeypatch.setattr(profile._hot_distribution, "__defaults__", (size,))
    apps, bureau = small
    names = ["anomaly", "payment", "concentration", "payment_behavior"]
    plain = _by_key(family_frame(apps, bureau, names))
    split = _by_key(family_frame(apps, bureau, names, max_rows_per_key=3))
    assert plain.keys() == split.keys()
    wrong = [(f, k) for k in plain for f in plain[k] if f not in KEY and not _same(plain[k][f], split[k][f])]
    assert not wrong, wrong[:5]
