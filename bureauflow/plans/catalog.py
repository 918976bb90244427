"""Registered queries: one per operator, over the whole derived tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bureauflow.functions import ranking
from bureauflow.operators import binning, calibration, cutoffs, elimination, extractor, metrics
from bureauflow.operators import enrich as en
from bureauflow.operators import families as fam
from bureauflow.operators import models, psi, quality, registry, scorecard, splitting
from bureauflow.operators.cube import cube_wide
from bureauflow.plans import features as ft
from bureauflow.plans import fixtures as fx
from bureauflow.schema import CREDIT_PRODUCTS, KEY, NON_CREDIT_PRODUCTS, SCHEMAS
from bureauflow.sources import tables as src

c = F.col
TRAIN_END = "2000-06-30"
FEATURES = fx.MODEL_FEATURES
PAIRED = [f for f in FEATURES if f != "const_1"]
# a second score, so that model comparison has something to rank
COEFFICIENTS = {"signal": -0.9, "o_totalprice": -0.4}
MEANS = {"signal": -0.1, "o_totalprice": 0.05}
SCALES = {"signal": 1.5, "o_totalprice": 0.5}
INTERCEPT = -0.7

FAMILY_IDS = {
    "f3": "ratio", "f4": "temporal", "f5": "trend", "f6": "risk_signal", "f7": "diversity",
    "f8": "behavioral", "f9": "default_pattern", "f10": "sequence", "f11": "size_pattern",
    "f12": "burst", "f13": "interval", "f14": "seasonal", "f15": "weighted", "f16": "co_applicant",
    "f17": "relative", "f18": "complexity", "f19": "time_decay", "f20": "default_lifecycle",
    "f21": "early_default", "f22": "amount_tier", "f23": "cross_product", "f24": "freshness",
    "f25": "concentration", "f26": "anomaly", "f27": "payment", "f28": "remaining_term",
    "f29": "obligation", "f30": "dti_proxy", "f31": "maturity", "f32": "duration_risk",
    "f33": "payment_behavior", "f34": "term_structure",
}


def canon(df: DataFrame) -> DataFrame:
    """Six decimals for small doubles, two for large ones (off the decimal ties); no negative zero."""
    cols = []
    for name, kind in df.dtypes:
        x = f"`{name}`"
        if kind == "double":
            large = f"round({x} + 0.00137D, 2)"
            x = f"CASE WHEN abs({x}) < 1000 THEN round({x}, 6) ELSE {large} END + 0D AS `{name}`"
        cols.append(x)
    return df.selectExpr(*cols)


def _doubles(df: DataFrame, keys: list[str] = KEY) -> DataFrame:
    rest = [f"cast(`{x}` as double) as `{x}`" for x in df.columns if x not in keys]
    return canon(df.selectExpr(*keys, *rest))


def tables(spark, sf_dir):
    return fx.applications(spark, sf_dir), fx.credit_bureau(spark, sf_dir)


def frame(spark, sf_dir):
    """Model frame with its quarter."""
    return metrics.with_quarter(fx.model_frame(spark, sf_dir))


def split_frame(spark, sf_dir):
    return splitting.stratified_split(frame(spark, sf_dir), TRAIN_END)


def train_frame(spark, sf_dir):
    return frame(spark, sf_dir).where(c("date") <= F.lit(TRAIN_END).cast("date"))


QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- features -------------------------------------------------------------------------------------


@query
def f1_amount_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon(ft.cube_long(*tables(spark, sf_dir)))


@query
def f2_count_cube(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    return _doubles(cube_wide(apps, ft.cube_long(apps, bureau), "count"))


def _family(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apps, bureau = tables(spark, sf_dir)
        if name == "amount_tier":  # scaled so that every tier is populated
            bureau = bureau.withColumn("total_amount", c("total_amount") / 25)
        return _doubles(fam.family_frame(apps, bureau, [name]))

    return run


QUERIES.update({f"{i}_{n}": _family(n) for i, n in FAMILY_IDS.items()})


def _over_full(name):
    """A family with so low a limit that most applicants, and many of their days, are over-full."""

    def run(spark, sf_dir):
        apps, bureau = tables(spark, sf_dir)
        return _doubles(fam.family_frame(apps, bureau, [name], max_rows_per_key=3))

    return run


QUERIES.update({
    f"{i}_{FAMILY_IDS[i]}_over_full": _over_full(FAMILY_IDS[i]) for i in ("f10", "f13", "f17", "f26", "f33")
})


@query
def f35_wide_frame(spark, sf_dir):
    return canon(ft.wide_frame(*tables(spark, sf_dir)))


@query
def f36_reconciliation(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    return ft.reconcile(ft.wide_frame(apps, bureau), apps)


def _extractor(groups):
    def run(spark, sf_dir):
        out = extractor.extract_features(*tables(spark, sf_dir), groups)
        names = [n for g in groups for n in extractor.GROUPS[g]]
        return _doubles(out.select(*KEY, *names))

    return run


QUERIES.update({
    f"x{i}_{g}": _extractor([g])
    for i, g in enumerate(
        ["amounts", "counts", "products", "defaulted", "temporal", "periods", "non_credit",
         "derived", "recovery_time"], 1)
})


# --- sources, projections, joins --------------------------------------------------------------------


@query
def s1_file_scan(spark, sf_dir):
    return canon(src.read_files(spark, f"{sf_dir}/customer.parquet"))


@query
def s2_pruned_scan(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    return canon(src.read(orders, ["o_orderkey", "o_totalprice"], "o_orderstatus = 'F'"))


@query
def s3_value_list(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    bad = apps.where(c("target") == 1)
    few = src.read_with_values(bureau, "product_type", ["MORTGAGE", "CASH_FACILITY"])
    return canon(src.read_with_values(few, "application_id", bad).select("tradeline_id", "total_amount"))


@query
def s4_date_range(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    out = src.read_with_dates(
        bureau, "opening_date", "1997-01-01", "1998-06-30", "total_amount > 50000"
    )
    return out.select("tradeline_id", "opening_date")


@query
def s5_named_readers(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    recent = src.read_applications(apps, date_range=("1999-06-01", "1999-12-31"))
    return src.read_credit_bureau(bureau, recent).select("tradeline_id", *KEY)


@query
def s6_renamed_columns(spark, sf_dir):
    apps, _ = tables(spark, sf_dir)
    return src.rename_columns(apps, {"application_id": "app", "absent": "x"}).select(
        "app", "customer_id"
    )


@query
def s7_split_joined(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    people, lines = src.split_joined(en.attach_tradelines(apps, bureau))
    return people.join(
        lines.groupBy(*KEY).agg(F.count("*").alias("tradelines")), KEY, "left"
    ).select(*KEY, "application_date", "target", "tradelines")


@query
def s8_partitioned_write(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    path = src.artefact_folder(spark, f"tradelines-{uuid.uuid4().hex}")
    src.write(bureau, path, partition_by=["product_type"])
    back = src.read_files(spark, path)
    return canon(back.groupBy("product_type").agg(
        F.count("*").alias("n"), F.sum("total_amount").alias("amount")
    ))


@query
def s1_csv_scan(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
    path = src.artefact_folder(spark, f"customer-{uuid.uuid4().hex}")
    rows.write.option("header", True).csv(path)
    return src.read_files(spark, path, "csv", rows.schema)


@query
def s9_bounded_sample(spark, sf_dir):
    return src.bounded(frame(spark, sf_dir), 5000, ["uid"]).select("uid", "target")


@query
def s10_saved_bins(spark, sf_dir):
    path = src.artefact_folder(spark, f"bins-{uuid.uuid4().hex}")
    src.save_artefact(binning.fit_bins(frame(spark, sf_dir), FEATURES), path)
    return canon(src.load_artefact(spark, path))


@query
def p1_credit_split(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    a = en.credit_only(bureau).select("tradeline_id", F.lit("credit").alias("kind"))
    return a.union(en.non_credit_only(bureau).select("tradeline_id", F.lit("signal")))


@query
def p2_dimension_filter(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    rows = en.enrich(en.attach_application_date(bureau, apps))
    return rows.where((c("p") == "cf") & c("w24") & c("d")).select("tid", "amt")


@query
def p3_schema_issues(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    issues = quality.validate_schema(bureau, SCHEMAS["credit_bureau"])
    return canon(
        quality.null_profile(bureau).join(issues.select("column", "issue"), "column", "left")
    )


@query
def p5_date_coercion(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    text = F.when(c("o_orderkey") % 7 == 0, "n/a").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return src.coerce_dates(orders.select("o_orderkey", text.alias("opening_date")))


@query
def p7_kept_columns(spark, sf_dir):
    m = frame(spark, sf_dir)
    names = elimination.kept(elimination.constant_features(m, FEATURES))
    return canon(elimination.keep_columns(m, sorted(names), ["uid"]))


@query
def j1_applicants_with_tradelines(spark, sf_dir):
    return canon(en.attach_tradelines(*tables(spark, sf_dir)).select(*KEY, "tradeline_id", "total_amount"))


@query
def j2_dated_tradelines(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    return en.attach_application_date(bureau, apps).select("tradeline_id", "application_date")


@query
def j3_full_outer_groups(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    credit = en.credit_only(bureau).groupBy(*KEY).agg(F.count("*").alias("credits"))
    other = en.non_credit_only(bureau).groupBy(*KEY).agg(F.count("*").alias("signals"))
    return extractor.combine_groups([credit, other])


@query
def j4_restored_target(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    credit = en.credit_only(bureau).groupBy(*KEY).agg(F.count("*").alias("credits"))
    return extractor.restore_target(credit, apps)


@query
def j5_orphans(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    return quality.orphans(bureau, apps.where(c("target") == 0), KEY).select("tradeline_id")


@query
def j7_bin_lookup(spark, sf_dir):
    m = frame(spark, sf_dir)
    bins = binning.fit_bins(m, FEATURES)
    long = binning.long_form(m, FEATURES, ["uid"])
    return canon(binning.bin_lookup(long, bins).drop("value"))


@query
def j9_performance_with_intervals(spark, sf_dir):
    m = split_frame(spark, sf_dir).withColumnRenamed("split", "period")
    perf = metrics.performance_by_period(m, "score", "target", "uid")
    return models.with_intervals(perf, models.bootstrap_auc(m, "score", "target", "period"))


@query
def u1_combined_oot(spark, sf_dir):
    m = metrics.combine_oot(split_frame(spark, sf_dir))
    return m.groupBy("period").agg(F.count("*").alias("n"), F.sum("target").alias("bads"))


@query
def u2_first_per_uid(spark, sf_dir):
    apps, _ = tables(spark, sf_dir)
    later = apps.withColumn("application_date", F.date_add("application_date", 10))
    return ft.first_per_uid(apps.unionByName(later)).select("uid", "application_date", "target")


@query
def u3_exact_dedup(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    twice = bureau.unionByName(bureau.where(c("tradeline_id") % 3 == 0))
    return twice.distinct().select("tradeline_id", "product_type")


@query
def u4_invalid_values(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    return quality.invalid_values(bureau, "product_type", ["MORTGAGE"])


@query
def t1_ordered_tradelines(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    rows = en.enrich(en.attach_application_date(en.credit_only(bureau), apps))
    w = Window.partitionBy(*KEY).orderBy("opening", "amt", "product", "tid")
    return rows.select("tid", F.row_number().over(w).cast("bigint").alias("position"))


@query
def t2_top_values(spark, sf_dir):
    return binning.categorical_stats(fx.table(spark, sf_dir, "lineitem"), "l_partkey")


@query
def t3_top_share(spark, sf_dir):
    m = frame(spark, sf_dir).withColumn("_desc", -c("score"))
    k = F.greatest(F.lit(1), F.floor(c("n_total") * 0.05))
    return ranking.first_k(m, "_desc", "uid", k).where("selected").select("uid")


@query
def t4_ranked_features(spark, sf_dir):
    m = frame(spark, sf_dir)
    iv = binning.information_value(binning.long_form(m, FEATURES, ["target"]))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last(F.round("iv", 6)), "feature")
    return canon(iv.select("feature", "iv", F.row_number().over(w).cast("bigint").alias("position")))


# --- binning and statistics -----------------------------------------------------------------------


@query
def a1_qcut(spark, sf_dir):
    long = binning.long_form(frame(spark, sf_dir), FEATURES, ["uid"])
    binned = binning.qcut(long)
    return canon(binned.groupBy("feature", "bin").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    ))


@query
def a2_approximate_bins(spark, sf_dir):
    out = binning.approximate_bins(frame(spark, sf_dir), "sum_price")
    return out.groupBy("sum_price_bin").agg(F.count("*").alias("n"))


@query
def a2_sketch_rank_errors(spark, sf_dir):
    """Whether every cut stands within twice the sketch's 99% bound, five standard deviations."""
    long = binning.long_form(frame(spark, sf_dir), FEATURES)
    out = binning.rank_errors(long, [i / 10 for i in range(1, 10)])
    return out.select("feature", "prob", "n", (c("rank_error") <= 2 * c("bound")).alias("within"))


@query
def a3_approximate_iv(spark, sf_dir):
    return binning.approximate_iv(binning.long_form(frame(spark, sf_dir), FEATURES, ["target"]))


@query
def a4_woe_table(spark, sf_dir):
    long = binning.long_form(frame(spark, sf_dir), FEATURES, ["target"])
    return canon(binning.woe_table(binning.qcut(long)))


@query
def a4_adaptive_iv(spark, sf_dir):
    long = binning.long_form(frame(spark, sf_dir), FEATURES, ["target"])
    return canon(binning.information_value(long, min_samples=3000))


@query
def a5_information_value(spark, sf_dir):
    long = binning.long_form(frame(spark, sf_dir), FEATURES, ["target"])
    return canon(binning.information_value(long))


@query
def a6_smoothed_iv(spark, sf_dir):
    long = binning.long_form(frame(spark, sf_dir), FEATURES, ["target"])
    return canon(binning.smoothed_information_value(long))


@query
def a6_categorical_iv(spark, sf_dir):
    m = frame(spark, sf_dir)
    return canon(binning.information_value_by_value(m, ["segment", "quarter"]))


@query
def a8_woe_bins(spark, sf_dir):
    return canon(binning.fit_bins(frame(spark, sf_dir), FEATURES))


@query
def a9_merged_bins(spark, sf_dir):
    m = frame(spark, sf_dir)
    bins = binning.fit_bins(m, FEATURES)
    return canon(binning.merge_small_bins(bins, binning.class_totals(m)))


@query
def a10_monotonic_bins(spark, sf_dir):
    return canon(binning.fit_woe(frame(spark, sf_dir), FEATURES))


@query
def a11_woe_encode(spark, sf_dir):
    m = frame(spark, sf_dir)
    out = binning.woe_encode(m, binning.fit_bins(m, PAIRED))
    return canon(out.select("uid", *[f"{f}_woe" for f in PAIRED]))


@query
def a12_psi(spark, sf_dir):
    plan = psi.by_date(train_frame(spark, sf_dir), "date", "1997-12-31")
    return canon(psi.plan_psi_bins(plan, FEATURES))


def _monitored(spark, sf_dir):
    m = frame(spark, sf_dir)
    early = c("date") <= F.lit("1997-12-31").cast("date")
    baseline = psi.fit_baseline(binning.long_form(m.where(early), FEATURES))
    return psi.monitor(baseline, binning.long_form(m.where(~early), FEATURES))


@query
def a13_psi_monitor(spark, sf_dir):
    return canon(_monitored(spark, sf_dir))


@query
def a13_monitor_bins(spark, sf_dir):
    m = frame(spark, sf_dir)
    early = c("date") <= F.lit("1997-12-31").cast("date")
    baseline = psi.fit_baseline(binning.long_form(m.where(early), FEATURES))
    return canon(psi.monitor_bins(baseline, binning.long_form(m.where(~early), FEATURES)))


def _runs(spark, sf_dir):
    """Three yearly runs against one baseline; the second is repeated after a run of half its rows."""
    m = frame(spark, sf_dir)
    saved = src.artefact_folder(spark, f"baseline-{uuid.uuid4().hex}")
    early = c("date") <= F.lit("1995-12-31").cast("date")
    src.save_artefact(psi.fit_baseline(binning.long_form(m.where(early), FEATURES)), saved)
    baseline = src.load_artefact(spark, saved)
    folder = src.artefact_folder(spark, f"runs-{uuid.uuid4().hex}")
    of = lambda year: m.where(F.year("date") == year)
    for year, rows in ((1996, of(1996)), (1997, of(1997).where("uid % 2 = 0")), (1998, of(1998)), (1997, of(1997))):
        psi.record_run(psi.monitor(baseline, binning.long_form(rows, FEATURES), warning=0.001, critical=0.005), folder, f"{year}-12-31")
    return psi.read_runs(spark, folder)


@query
def a14_run_history(spark, sf_dir):
    return canon(psi.run_history(_runs(spark, sf_dir)))


@query
def a14_status_changes(spark, sf_dir):
    return canon(psi.status_changes(_runs(spark, sf_dir)))


@query
def a14_alerts(spark, sf_dir):
    return psi.alerts(_monitored(spark, sf_dir))


@query
def a14_monitoring_record(spark, sf_dir):
    return psi.run_record(_monitored(spark, sf_dir), "2001-01-01")


@query
def a15_psi_by_quarter(spark, sf_dir):
    return canon(psi.plan_psi(psi.by_period(train_frame(spark, sf_dir)), FEATURES))


@query
def a15_psi_by_year(spark, sf_dir):
    return canon(psi.plan_psi(psi.by_period(train_frame(spark, sf_dir), period="year"), FEATURES))


@query
def a15_psi_consecutive(spark, sf_dir):
    return canon(psi.plan_psi(psi.by_consecutive_quarters(train_frame(spark, sf_dir)), FEATURES))


@query
def a15_psi_halves(spark, sf_dir):
    return canon(psi.plan_psi(psi.by_halves(train_frame(spark, sf_dir)), FEATURES))


@query
def a16_numeric_stats(spark, sf_dir):
    return canon(binning.numeric_stats(frame(spark, sf_dir), FEATURES))


@query
def a17_categorical_stats(spark, sf_dir):
    return binning.categorical_stats(frame(spark, sf_dir), "segment")


@query
def a18_histogram(spark, sf_dir):
    m = frame(spark, sf_dir)
    return canon(metrics.histogram(m, "o_totalprice", ["segment"]))


@query
def a19_score_bands(spark, sf_dir):
    return canon(metrics.score_bands(frame(spark, sf_dir), "o_totalprice", "target"))


@query
def a19_score_distribution(spark, sf_dir):
    return canon(metrics.distribution_summary(split_frame(spark, sf_dir), "score", ["split"]))


# --- quality --------------------------------------------------------------------------------------


@query
def q1_null_checks(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    return canon(quality.null_checks(
        bureau, {"product_type": 0.0, "default_date": 0.5, "closure_date": 0.99}
    ))


@query
def q2_range_checks(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    return canon(quality.range_checks(
        bureau, {"total_amount": (0, 100000000), "duration_months": (24, 100)}
    ))


@query
def q3_allowed_values(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    full = en.attach_tradelines(apps, bureau)
    return canon(quality.allowed_value_checks(full, {
        "product_type": CREDIT_PRODUCTS, "applicant_type": ["PRIMARY", "CO_APPLICANT"]
    }))


@query
def q4_duplicates(spark, sf_dir):
    _, bureau = tables(spark, sf_dir)
    return canon(quality.duplicate_check(bureau, [*KEY, "product_type"]))


@query
def q5_date_rules(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    return canon(quality.expression_checks(
        en.attach_application_date(bureau, apps), quality.DATE_RULES
    ))


@query
def q6_uniqueness(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    return canon(quality.report([
        quality.uniqueness_check(apps, KEY), quality.uniqueness_check(bureau, ["application_id"])
    ]))


@query
def q7_report(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    return quality.summary(quality.report([
        quality.null_checks(bureau, {"product_type": 0.0, "total_amount": 0.0}),
        quality.range_checks(bureau, {"duration_months": (24, 100)}),
        quality.orphan_check(bureau, apps, KEY),
        quality.allowed_value_checks(
            bureau, {"product_type": CREDIT_PRODUCTS + NON_CREDIT_PRODUCTS}
        ),
    ]))


@query
def q8_feature_quality(spark, sf_dir):
    return canon(elimination.feature_quality(frame(spark, sf_dir), FEATURES))


@query
def q9_correlation_matrix(spark, sf_dir):
    return canon(elimination.correlation_matrix(frame(spark, sf_dir), PAIRED))


@query
def q9_spearman(spark, sf_dir):
    return canon(elimination.correlation_pairs(frame(spark, sf_dir), PAIRED, "spearman"))


@query
def q10_high_correlations(spark, sf_dir):
    pairs = elimination.correlation_pairs(frame(spark, sf_dir), PAIRED)
    return canon(elimination.high_correlations(pairs, 0.5))


@query
def q11_univariate(spark, sf_dir):
    return canon(elimination.univariate_report(frame(spark, sf_dir), FEATURES))


@query
def q12_outliers(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    return quality.outlier_shares(bureau, ["total_amount", "monthly_payment"], 1.5, 2.0)


@query
def q13_pre_model_checks(spark, sf_dir):
    return quality.pre_model_checks(frame(spark, sf_dir), FEATURES)


@query
def q14_post_model_checks(spark, sf_dir):
    m = split_frame(spark, sf_dir).withColumnRenamed("split", "period")
    return quality.post_model_checks(
        metrics.performance_by_period(m, "score", "target", "uid"),
        psi.score_psi(m, "score"),
        binning.information_value(binning.long_form(m, FEATURES, ["target"])).select(
            "feature", c("iv").alias("importance")
        ),
        binning.fit_bins(m, FEATURES),
    )


@query
def q15_data_dictionary(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    temporal = apps.join(fam.family_frame(apps, bureau, ["temporal"]), KEY)
    out = registry.data_dictionary(temporal, list(fam.family_columns(["temporal"])))
    formula = c("formula").isNotNull() & ~c("formula").contains("compute(")
    return canon(out.withColumn("has_formula", formula).drop("formula"))


# --- elimination and splits -----------------------------------------------------------------------


@query
def e1_constant(spark, sf_dir):
    return canon(elimination.constant_features(frame(spark, sf_dir), FEATURES))


@query
def e2_missing(spark, sf_dir):
    return canon(elimination.missing_features(split_frame(spark, sf_dir), FEATURES, 0.01))


@query
def e3_iv_filter(spark, sf_dir):
    return canon(elimination.iv_filter(frame(spark, sf_dir), FEATURES))


@query
def e4_psi_filter(spark, sf_dir):
    table = psi.plan_psi(psi.by_period(train_frame(spark, sf_dir)), FEATURES)
    return canon(elimination.psi_filter(table, FEATURES, 0.05))


@query
def e5_temporal_filter(spark, sf_dir):
    return canon(elimination.temporal_filter(split_frame(spark, sf_dir), FEATURES))


def _iv_map(m):
    iv = binning.information_value(binning.long_form(m, FEATURES, ["target"]))
    return {r["feature"]: r["iv"] for r in iv.collect()}


@query
def e6_correlation_filter(spark, sf_dir):
    m = frame(spark, sf_dir)
    pairs = elimination.correlation_pairs(m, PAIRED)
    return canon(elimination.correlation_filter(pairs, PAIRED, _iv_map(m), 0.5))


@query
def e6_correlation_pairs(spark, sf_dir):
    return canon(elimination.correlation_pairs(frame(spark, sf_dir), PAIRED))


@query
def e7_pairwise_filter(spark, sf_dir):
    m = frame(spark, sf_dir)
    iv = binning.information_value(binning.long_form(m, PAIRED, ["target"])).select("feature", "iv")
    pairs = elimination.correlation_pairs(m, PAIRED)
    return canon(elimination.correlation_filter_pairwise(pairs, iv, 0.5))


@query
def e8_vif(spark, sf_dir):
    m = frame(spark, sf_dir)
    pairs = elimination.correlation_pairs(m, PAIRED)
    return canon(elimination.vif_filter(pairs, PAIRED, _iv_map(m)))


@query
def e9_forward_by_gain(spark, sf_dir):
    m = split_frame(spark, sf_dir).fillna(0, subset=FEATURES).select("split", "target", *FEATURES).persist()
    try:
        train, test = m.where("split = 'train'"), m.where("split = 'test'")
        iv = _iv_map(train)
        return models.forward_by_gain(train, test, sorted(PAIRED, key=lambda f: (-iv[f], f)))
    finally:
        m.unpersist()


@query
def e10_sequential_selection(spark, sf_dir):
    m = train_frame(spark, sf_dir).fillna(0, subset=FEATURES)
    return models.sequential_selection(m, PAIRED)[1]


@query
def p6_feature_columns(spark, sf_dir):
    m = frame(spark, sf_dir)
    meta = ["uid", "date", "target", "segment", "quarter", "score"]
    long = binning.long_form(m, splitting.feature_columns(m, meta))
    return long.groupBy("feature").agg(F.count("*").alias("n"), F.count("value").alias("known"))


@query
def e11_stratified_split(spark, sf_dir):
    return splitting.split_index(split_frame(spark, sf_dir))


@query
def e12_temporal_split(spark, sf_dir):
    return splitting.split_index(splitting.temporal_split(frame(spark, sf_dir), TRAIN_END))


@query
def e13_random_split(spark, sf_dir):
    return splitting.split_index(splitting.random_split(frame(spark, sf_dir), 0.2, 0.1))


@query
def e14_split_metadata(spark, sf_dir):
    return canon(splitting.split_metadata(split_frame(spark, sf_dir)))


# --- metrics --------------------------------------------------------------------------------------


@query
def m1_auc_by_feature(spark, sf_dir):
    long = binning.long_form(frame(spark, sf_dir), FEATURES, ["target"])
    return canon(metrics.auc_table(long, "value", "target", ["feature"]).select(
        "feature", "n", "n_bads", "auc", "gini"
    ))


@query
def m1b_auc_chunked(spark, sf_dir):
    m = frame(spark, sf_dir)
    # a low limit sends the whole column through the chunked path
    cum = ranking.cumulative(
        m, [], "o_totalprice", {"n": F.lit(1), "bad": c("target").cast("bigint")}, max_group=100
    )
    good = c("n") - c("bad")
    area = F.sum(c("bad") * (c("n_before") - c("bad_before") + good / 2))
    return canon(cum.agg((
        area / (F.max("bad_total") * (F.max("n_total") - F.max("bad_total")))
    ).alias("auc")))


@query
def m2_ks_by_feature(spark, sf_dir):
    long = binning.long_form(frame(spark, sf_dir), FEATURES, ["target"])
    return canon(metrics.auc_table(long, "value", "target", ["feature"]).select(
        "feature", "ks", "ks_threshold", "ks_signed"
    ))


@query
def m3_lift_table(spark, sf_dir):
    return canon(metrics.lift_table(frame(spark, sf_dir), "o_totalprice", "target", ["segment"]))


@query
def m4_precision_at_k(spark, sf_dir):
    m = split_frame(spark, sf_dir)
    return canon(metrics.precision_lift_at_k(m, "score", "target", "uid", 0.10, ["split"]))


@query
def m5_confusion(spark, sf_dir):
    return canon(metrics.confusion_table(frame(spark, sf_dir), "score", "target", by=["segment"]))


@query
def m6_log_loss(spark, sf_dir):
    return canon(metrics.log_loss(split_frame(spark, sf_dir), "score", "target", ["split"]))


@query
def m7_performance_by_period(spark, sf_dir):
    m = split_frame(spark, sf_dir).withColumnRenamed("split", "period")
    return canon(metrics.performance_by_period(m, "score", "target", "uid"))


@query
def m7_performance_by_quarter(spark, sf_dir):
    m = frame(spark, sf_dir).withColumnRenamed("quarter", "period")
    return canon(metrics.performance_by_period(m, "score", "target", "uid", min_rows=30))


@query
def m8_variable_quarterly_auc(spark, sf_dir):
    long = binning.long_form(frame(spark, sf_dir), FEATURES, ["target", "quarter"])
    return canon(metrics.quarterly_auc_summary(metrics.variable_quarterly_auc(long)))


@query
def m9_quarterly_trend(spark, sf_dir):
    m = split_frame(spark, sf_dir).withColumnRenamed("split", "period")
    perf = metrics.auc_table(m, "score", "target", ["period"])
    return canon(metrics.quarterly_trend(perf))


@query
def m10_bootstrap(spark, sf_dir):
    m = split_frame(spark, sf_dir)
    return canon(models.bootstrap_auc(m, "score", "target", "split"))


@query
def m11_score_psi(spark, sf_dir):
    m = split_frame(spark, sf_dir).withColumnRenamed("split", "period")
    return canon(psi.score_psi(m, "o_totalprice"))


@query
def m12_segment_performance(spark, sf_dir):
    m = split_frame(spark, sf_dir)
    return canon(metrics.segment_performance(m, "score", "target", "segment", "split"))


@query
def m12_segment_confusion(spark, sf_dir):
    m = split_frame(spark, sf_dir)
    return canon(metrics.segment_confusion(m, "score", "target", "segment", "split"))


@query
def m13_model_comparison(spark, sf_dir):
    m = frame(spark, sf_dir).withColumn("flat", (c("uid") % 97) / 100.0)
    out = metrics.compare_models(m, ["score", "flat"], "target")
    return canon(out.select(
        "model", "auc", "gini", "ks", "accuracy", "precision", "recall", "f1",
        c("rank").cast("bigint").alias("rank"),
    ))


def _calibrated(method):
    def run(spark, sf_dir):
        return calibration.calibration_result(frame(spark, sf_dir), "score", "target", method)

    return run


QUERIES.update({f"m14_calibration_{k}": _calibrated(k) for k in calibration.METHODS})


@query
def m14_isotonic_steps(spark, sf_dir):
    return canon(calibration.isotonic_steps(frame(spark, sf_dir), "score", "target"))


@query
def m15_calibration_quality(spark, sf_dir):
    m = frame(spark, sf_dir)
    hl = calibration.hosmer_lemeshow(m, "score", "target")
    return canon(
        calibration.brier(m, "score", "target")
        .join(calibration.expected_calibration_error(m, "score", "target"))
        .join(hl.withColumn("dof", c("dof").cast("bigint")))
    )


@query
def m15_calibration_curve(spark, sf_dir):
    return canon(calibration.calibration_curve(frame(spark, sf_dir), "score", "target"))


def _safe(spark, sf_dir):
    """Score where higher means lower risk."""
    return frame(spark, sf_dir).withColumn("safe", 1 - c("score") + (c("uid") % 10) / 200.0)


@query
def m16_cutoffs(spark, sf_dir):
    m = _safe(spark, sf_dir)
    named = lambda d, n: d.select(F.lit(n).alias("method"), "cutoff")
    out = named(cutoffs.ks_cutoff(m, "safe", "target"), "ks")
    for d, n in (
        (cutoffs.cost_cutoff(m, "safe", "target", 5, 1), "cost"),
        (cutoffs.approval_cutoff(m, "safe", 0.6), "approval"),
        (cutoffs.bad_rate_cutoff(m, "safe", "target", 0.1), "bad_rate"),
    ):
        out = out.unionByName(named(d, n))
    return canon(out)


@query
def m17_cutoff_table(spark, sf_dir):
    return canon(cutoffs.cutoff_table(_safe(spark, sf_dir), "safe", "target"))


@query
def m17_several_cutoffs(spark, sf_dir):
    return canon(cutoffs.several_cutoffs(_safe(spark, sf_dir), "safe", "target"))


@query
def m18_importance(spark, sf_dir):
    m = train_frame(spark, sf_dir).fillna(0, subset=FEATURES)
    model = models.fit_boosted(m, PAIRED)
    return models.tree_importance(model, spark, PAIRED)


# --- models and scorecard -------------------------------------------------------------------------


@query
def l1_logistic(spark, sf_dir):
    m = train_frame(spark, sf_dir).select("target", *PAIRED).persist()  # read by the bins and the passes of the fit
    try:
        encoded = binning.woe_encode(m, binning.fit_woe(m, PAIRED))
        woe = [f"{f}_woe" for f in PAIRED]
        return models.coefficient_table(models.fit_logistic(encoded, woe), spark, woe)
    finally:
        m.unpersist()


@query
def l2_boosted(spark, sf_dir):
    m = split_frame(spark, sf_dir).fillna(0, subset=FEATURES)
    model = models.fit_boosted(m.where("split = 'train'"), PAIRED)
    return metrics.auc_table(models.predict(model, m), "probability_bad", "target", ["split"])


@query
def l3_grid_search(spark, sf_dir):
    m = split_frame(spark, sf_dir).fillna(0, subset=FEATURES)
    grid = [{"maxDepth": 2}, {"maxDepth": 3}]  # the other values are fit_boosted's own
    return models.grid_search(m, PAIRED, grid)[1]


@query
def l3_stability_objective(spark, sf_dir):
    long = binning.long_form(split_frame(spark, sf_dir), PAIRED, ["target", "split"])
    perf = metrics.auc_table(long, "value", "target", ["feature", "split"])
    return canon(models.stability_objective(perf, by="feature"))


def _scorecard(spark, sf_dir):
    m = frame(spark, sf_dir)
    bins = binning.fit_bins(m, list(COEFFICIENTS))
    return m, scorecard.build_scorecard(bins, COEFFICIENTS, INTERCEPT)


@query
def l4_scorecard(spark, sf_dir):
    _, card = _scorecard(spark, sf_dir)
    return canon(card.select("feature", "bin_id", "woe", "coefficient", "points"))


@query
def l5_scaled_scorecard(spark, sf_dir):
    bins = binning.fit_bins(frame(spark, sf_dir), list(COEFFICIENTS))
    card = scorecard.build_scaled_scorecard(bins, COEFFICIENTS, MEANS, SCALES, INTERCEPT)
    return canon(card.select("feature", "bin_id", "woe", "coefficient", "points"))


@query
def l6_scored_rows(spark, sf_dir):
    m, card = _scorecard(spark, sf_dir)
    return scorecard.score_rows(m, card).select("uid", "scorecard_score")


@query
def l7_joint_scores(spark, sf_dir):
    apps, bureau = tables(spark, sf_dir)
    counts = en.credit_only(bureau).groupBy(*KEY).agg(F.count("*").alias("credits"))
    scored = extractor.restore_target(counts, apps).withColumn("s", 850 - 10 * c("credits"))
    return canon(scorecard.joint_scores(scored, "s"))


# --- whole runs -----------------------------------------------------------------------------------


def _performance(out):
    return canon(out.tables["performance"])


@query
def d1_develop_model(spark, sf_dir):
    """From candidates to performance by period, with the run's own elimination steps and folds; the table's target
    changes with the date, so the limits of IV and PSI are wide."""
    from bureauflow.plans import development

    return _performance(development.develop_model(
        frame(spark, sf_dir).drop("quarter"), FEATURES, TRAIN_END, iv_range=(0.0, 10.0), max_psi=10, fit=models.fit_logistic, segments=["segment"]
    ))


@query
def d2_develop_scorecard(spark, sf_dir):
    from bureauflow.plans import development

    return _performance(development.develop_scorecard(
        frame(spark, sf_dir).drop("quarter"), FEATURES, TRAIN_END, iv_range=(0.0, 10.0), max_psi=10
    ))
