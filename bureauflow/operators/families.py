"""Feature families as expressions over the applicant profile.

Every family is a function from the profile to named Columns. Undefined times and ages are NULL and
undefined ratios of amounts or counts are 0, except where a family documents NULL ratios;
`undefined="zero"` turns the NULL times into 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureauflow.functions.expressions import add_all, entropy, flag, ratio, ratio0
from bureauflow.operators.enrich import MAX_ROWS_PER_KEY, credit_only, with_optional_columns
from bureauflow.operators.profile import applicant_profile
from bureauflow.schema import DAYS_PER_MONTH, KEY, PRODUCT_NAMES, PRODUCTS

Columns = dict[str, Column]
c = F.col


def num(name: str) -> Column:
    """Profile counter or sum with 0 for applicants without tradelines."""
    return F.coalesce(c(name), F.lit(0))


def dbl(name: str) -> Column:
    return F.coalesce(c(name).cast("double"), F.lit(0.0))


def months(days: str) -> Column:
    return c(days) / DAYS_PER_MONTH


def ratio_features() -> Columns:
    out: Columns = {}
    for p in PRODUCTS:
        out[f"{p}_to_total_ratio"] = ratio(num(f"n_{p}"), c("n"))
        out[f"{p}_amt_to_total_ratio"] = ratio(num(f"sum_{p}"), c("sum"))
    for name, col in (("active", "na"), ("defaulted", "nd"), ("recovered", "nr")):
        out[f"{name}_ratio"] = ratio(c(col), c("n"))
    for m in (3, 6, 12, 24):
        out[f"{m}m_concentration_ratio"] = ratio(c(f"n_w{m}"), c("n"))
    return out


def temporal_features() -> Columns:
    at_least_0 = lambda x: F.when(x.isNotNull(), F.greatest(x, F.lit(0)))
    return {
        "oldest_credit_age_months": months("age_max"),
        "newest_credit_age_months": months("age_min"),
        "avg_credit_age_months": c("age_avg"),
        "credit_history_length_months": F.coalesce(months("age_max"), F.lit(0.0)),
        "days_since_last_default": at_least_0(c("since_dflt")),
        "days_since_last_credit": at_least_0(c("age_min")),
        "avg_time_to_default_days": c("ttd_avg"),
        "avg_recovery_time_days": c("rec_avg"),
    }


def trend_features() -> Columns:
    out: Columns = {}
    for m in (3, 6):
        out[f"credit_velocity_{m}m"] = ratio0(num(f"n_w{m}"), num("n"))
        out[f"amount_velocity_{m}m"] = ratio0(num(f"sum_w{m}"), dbl("sum"))
    for name, col in (("cnt", "n"), ("amt", "sum"), ("default", "nd")):
        six, twelve = num(f"{col}_w6"), num(f"{col}_w12")
        out[f"{name}_trend_6m_vs_12m"] = six - (twelve - six)
    return out


def risk_signal_features() -> Columns:
    return {
        "has_overdraft": flag(c("od_n") > 0),
        "overdraft_count": num("od_n"),
        "overdraft_amount": dbl("od_amt"),
        "has_overlimit": flag(c("ol_n") > 0),
        "overlimit_count": num("ol_n"),
        "overlimit_amount": dbl("ol_amt"),
        "financial_stress_flag": flag((c("od_n") > 0) | (c("ol_n") > 0)),
        "has_current_default": flag(c("nd") > c("nr")),
        "ever_defaulted": flag(c("nd") > 0),
    }


def _distinct_products() -> Column:
    return add_all([flag(c(f"n_{p}") > 0) for p in PRODUCTS])


def diversity_features() -> Columns:
    shares = [ratio0(num(f"n_{p}"), num("n")) for p in PRODUCTS]
    return {
        "distinct_product_count": _distinct_products(),
        "product_diversity_ratio": _distinct_products() / 4.0,
        "hhi_product": add_all([s * s for s in shares]),
        "secured_ratio": ratio(num("n_mg"), c("n")),
        "unsecured_ratio": 1 - ratio(num("n_mg"), c("n")),
        "revolving_ratio": ratio(num("n_cf"), c("n")),
    }


def behavioral_features() -> Columns:
    out: Columns = {
        "min_time_to_default_days": c("ttd_min"),
        "max_time_to_default_days": c("ttd_max"),
        "std_time_to_default_days": c("ttd_std"),
        "min_recovery_time_days": c("rec_min"),
        "max_recovery_time_days": c("rec_max"),
        "recovery_success_rate": ratio0(num("nr"), num("nd")),
        "mature_credit_ratio": ratio0(num("n_mature"), num("n")),
        "new_credit_ratio": ratio0(num("n_new"), num("n")),
    }
    for p in PRODUCTS:
        for stat in ("min", "max", "avg"):
            out[f"{p}_time_to_default_{stat}_days"] = c(f"ttd_{stat}_{p}")
    return out


def default_pattern_features() -> Columns:
    nd = num("nd")
    out: Columns = {
        "default_count_ever": nd,
        "default_recurrence_count": F.greatest(nd - 1, F.lit(0)),
        "has_multiple_defaults": flag(nd > 1),
        "has_recovered_default": flag(c("nr") > 0),
        "all_defaults_recovered": flag((nd > 0) & (c("nr") == nd)),
        "default_amount_ratio": ratio0(dbl("sumd"), dbl("sum")),
        "avg_default_severity": dbl("avgd"),
        "max_default_severity": dbl("maxd"),
        "default_to_active_ratio": ratio0(nd, num("na")),
    }
    for p in PRODUCTS:
        out[f"{p}_default_rate"] = ratio0(num(f"nd_{p}"), num(f"n_{p}"))
    return out


def sequence_features() -> Columns:
    out: Columns = {}
    for end in ("first", "last"):
        for p in PRODUCTS:
            out[f"{end}_product_{PRODUCT_NAMES[p]}"] = flag(c(f"{end}_{p}") > 0)
    out["product_transition_count"] = num("transitions")
    out["moved_to_secured"] = flag(c("mg_position") > 1)
    out["moved_to_unsecured"] = flag((c("mg_position") == 1) & (c("last_mg") == 0))
    out["same_product_streak"] = num("streak")
    return out


def size_pattern_features() -> Columns:
    out: Columns = {
        "has_small_credit": flag(c("n_small") > 0),
        "has_large_credit": flag(c("n_large") > 0),
        "has_very_large_credit": flag(c("n_vlarge") > 0),
        "small_credit_count": num("n_small"),
        "large_credit_count": num("n_large"),
        "small_credit_ratio": ratio(c("n_small"), c("n")),
        "large_credit_ratio": ratio(c("n_large"), c("n")),
        "max_to_avg_amount_ratio": ratio(c("max"), c("avg")),
        "max_to_min_amount_ratio": ratio(c("max"), c("min")),
        "amount_coefficient_of_variation": ratio(c("std"), c("avg")),
        "amount_range": c("max") - c("min"),
        "median_credit_amount": c("amt_med"),
        "amount_skewness": c("skew"),
    }
    for p in PRODUCTS:
        out[f"{p}_avg_amount"] = c(f"avg_{p}")
    return out


def _pair(value: Column, single: int = 0) -> Column:
    """value for applicants with at least two credits."""
    return F.when(c("n") >= 2, value).otherwise(F.lit(single))


def burst_features() -> Columns:
    out: Columns = {
        "credits_in_30_days": _pair(c("c30")),
        "credits_in_60_days": _pair(c("c60")),
        "credits_in_90_days": _pair(c("c90")),
        "has_credit_burst_30d": flag((c("n") >= 2) & (c("c30") >= 2)),
        "has_credit_burst_60d": flag((c("n") >= 2) & (c("c60") >= 3)),
        "max_credits_same_month": num("month_peak"),
        "amount_in_30_days": _pair(c("a30")).cast("double"),
        "amount_in_60_days": _pair(c("a60")).cast("double"),
        "burst_intensity_30d": _pair(c("c30")).cast("double"),
        "burst_intensity_60d": _pair(c("c60")) / 2.0,
    }
    for p in PRODUCTS:
        out[f"{p}_burst_count"] = F.when(
            (c("n") >= 2) & (c(f"n_{p}") >= 2), c(f"n_{p}")
        ).otherwise(F.lit(0))
    return out


def _gap_avg() -> Column:
    return c("gap_sum") / (c("n") - 1)


def _gap_std() -> Column:
    k = c("n") - 1
    return F.sqrt(k * c("gap_sq") - c("gap_sum") * c("gap_sum")) / k


def _gap_cv() -> Column:
    return ratio0(F.when(c("n") >= 2, _gap_std()), F.when(c("n") >= 2, _gap_avg()))


def _gap_trend() -> Column:
    """Mean gap of the second half minus the first half; gaps telescope to day differences."""
    k = c("n") - 1
    half = F.floor(k / 2)
    late = (c("day_last") - c("day_half")) / (k - half)
    early = (c("day_half") - c("day_first")) / half
    return F.when(k >= 3, late - early).otherwise(F.lit(0.0))


def interval_features() -> Columns:
    two = c("n") >= 2
    earlier = (c("gap_sum") - c("gap_last")) / (c("n") - 2)
    out: Columns = {
        "avg_inter_credit_days": F.when(two, _gap_avg()),
        "min_inter_credit_days": c("gap_min"),
        "max_inter_credit_days": c("gap_max"),
        "std_inter_credit_days": F.when(two, _gap_std()),
        "median_inter_credit_days": c("gap_med"),
        "inter_credit_cv": _gap_cv(),
        "has_rapid_succession": flag(c("n_rapid") > 0),
        "rapid_succession_count": num("n_rapid"),
        "longest_credit_gap_days": c("gap_max"),
        "recent_vs_historical_interval": F.when(
            c("n") >= 4, ratio0(c("gap_last"), earlier)
        ).otherwise(F.lit(0.0)),
        "interval_trend": _gap_trend(),
        "is_accelerating": flag(_gap_trend() < -7),
        "is_decelerating": flag(_gap_trend() > 7),
    }
    for p in PRODUCTS:
        out[f"{p}_avg_interval_days"] = F.when(
            c(f"n_{p}") >= 2, (c(f"day_last_{p}") - c(f"day_first_{p}")) / (c(f"n_{p}") - 1)
        )
    return out


def _quarters() -> list[Column]:
    return [add_all([num(f"m{3 * q + i}") for i in (1, 2, 3)]) for q in range(4)]


def _first_peak(counts: list[Column], start: int) -> Column:
    """Position of the largest counter, the first one on a tie; 0 when all are 0."""
    peak = F.greatest(*counts)
    out = F.when(peak == 0, 0)
    for i, n in enumerate(counts):
        out = out.when(n == peak, start + i)
    return out


def seasonal_features() -> Columns:
    q = _quarters()
    share = [ratio0(x, num("n")) for x in q]
    out: Columns = {
        "most_common_opening_month": _first_peak([num(f"m{i}") for i in range(1, 13)], 1),
        "most_common_opening_quarter": _first_peak(q, 1),
    }
    for i, n in enumerate(q):
        out[f"credits_in_q{i + 1}"] = n
    out["credits_in_december"] = num("m12")
    out["is_year_end_heavy"] = flag(share[3] > 0.25)
    out["is_summer_heavy"] = flag(ratio0(q[1] + q[2], num("n")) > 0.5)
    out["monthly_spread"] = add_all([flag(c(f"m{i}") > 0) for i in range(1, 13)]) / 12.0
    out["quarterly_concentration"] = add_all([s * s for s in share])
    return out


def weighted_features() -> Columns:
    return {
        "amount_weighted_default_rate": ratio0(dbl("sumd"), dbl("sum")),
        "amount_weighted_age_months": ratio0(dbl("age_amt"), dbl("sum")),
        "amount_weighted_product_score": ratio0(dbl("score_amt"), dbl("sum")),
        "recent_amount_weight": ratio0(dbl("sum_w6"), dbl("sum")),
        "large_credit_weight": ratio0(dbl("sum_large"), dbl("sum")),
        "defaulted_amount_weighted_age": ratio0(dbl("age_amt_d"), dbl("sumd")),
    }


def co_applicant_features() -> Columns:
    """Needs the application totals of `with_application_totals`."""
    other = lambda name: num(f"app_{name}") - num(name)
    co_nd, co_n = other("nd"), other("n")
    joint = c("app_people") > 1
    return {
        "is_primary_applicant": flag(c("applicant_type") == "PRIMARY"),
        "is_co_applicant": flag(c("applicant_type") == "CO_APPLICANT"),
        "application_has_co_applicant": flag(joint),
        "co_applicant_credit_count": F.when(joint, co_n).otherwise(0),
        "co_applicant_default_count": F.when(joint, co_nd).otherwise(0),
        "co_applicant_default_rate": F.when(joint, ratio0(co_nd, co_n)).otherwise(0.0),
        "co_applicant_total_amount": F.when(
            joint, dbl("app_sum") - dbl("sum")
        ).otherwise(0.0),
        "primary_vs_co_amount_ratio": ratio0(
            dbl("app_primary_sum"), dbl("app_sum") - dbl("app_primary_sum")
        ),
        "combined_default_exposure": dbl("app_sumd"),
        "either_has_default": flag(c("app_nd") > 0),
        "both_have_default": flag(joint & (c("app_with_default") == c("app_people"))),
    }


def with_application_totals(apps: DataFrame, bureau: DataFrame) -> DataFrame:
    """Applicants with the totals over all applicants of their application.

    Computed from narrow tradeline columns and attached before the wide profile is joined, so no
    wide row is shuffled by application.
    """
    default = c("default_date").isNotNull()
    per_person = (
        credit_only(with_optional_columns(bureau))
        .groupBy(*KEY)
        .agg(
            F.count("*").alias("n"),
            F.count_if(default).alias("nd"),
            F.sum("total_amount").alias("amount"),
            F.sum(F.when(default, c("total_amount"))).alias("amount_d"),
        )
    )
    totals = (
        apps.select(*KEY, "applicant_type")
        .join(per_person, KEY, "left")
        .groupBy("application_id")
        .agg(
            F.count("*").alias("app_people"),
            F.sum("n").alias("app_n"),
            F.sum("nd").alias("app_nd"),
            F.sum("amount").alias("app_sum"),
            F.sum("amount_d").alias("app_sumd"),
            F.sum(F.when(c("applicant_type") == "PRIMARY", c("amount"))).alias("app_primary_sum"),
            F.count_if(c("nd") > 0).alias("app_with_default"),
        )
    )
    # an applicant without an application id is kept, and belongs to no application
    return apps.join(totals, "application_id", "left")


def relative_features() -> Columns:
    n = num("n")
    half = F.floor(n / 2)
    early = c("sum_half") / half
    late = (c("sum") - c("sum_half")) / (n - half)
    six, twelve, two_years = num("nd_w6"), num("nd_w12"), num("n_w24")
    return {
        "latest_amount_vs_average": ratio0(c("amt_last"), c("avg")),
        "latest_amount_vs_max": ratio0(c("amt_last"), c("max")),
        "is_largest_credit_recent": flag(c("recent_max") == c("max")),
        "is_smallest_credit_recent": flag(c("recent_min") == c("min")),
        "amount_growth_rate": F.when(n >= 2, ratio0(late - early, early)).otherwise(0.0),
        "credit_count_growth_rate": num("n_w12") - (two_years - num("n_w12")),
        "default_rate_trend": six - (twelve - six),
        "amount_percentile_latest": ratio0(num("n_below_last"), n),
        "recency_of_max_amount": months("age_of_max"),
        "latest_vs_first_amount_ratio": ratio0(c("amt_last"), c("amt_first")),
    }


def complexity_features() -> Columns:
    n = num("n")
    distinct = _distinct_products()
    product_entropy = entropy([num(f"n_{p}") for p in PRODUCTS], n)
    combos = add_all(
        [flag(c(f"nd_{p}") > 0) + flag(c(f"n_{p}") > c(f"nd_{p}")) for p in PRODUCTS]
    )
    any_credit = lambda x: F.when(n > 0, x).otherwise(F.lit(0.0))
    return {
        "product_entropy": product_entropy,
        "amount_entropy": F.when(
            n > 1, entropy([num(f"slot{i}") for i in range(1, 6)], n)
        ).otherwise(0.0),
        "has_all_product_types": flag(distinct >= 4),
        "single_product_customer": flag(distinct == 1),
        "dual_product_customer": flag(distinct == 2),
        "product_status_combinations": combos,
        "portfolio_complexity_score": F.least(
            F.lit(10.0), distinct * 2 + product_entropy * 2
        ),
        "credit_frequency_regularity": any_credit(1 / (1 + _gap_cv())),
        "amount_regularity": any_credit(1 / (1 + ratio(c("std"), c("avg")))),
    }


def time_decay_features() -> Columns:
    n = num("n")
    return {
        "recency_weighted_default_count": dbl("w180_d"),
        "recency_weighted_default_amount": dbl("w180_damt"),
        "time_decay_total_amount": ratio0(dbl("w180_amt"), dbl("w180")),
        "time_decay_default_severity": dbl("w180_damt"),
        "recent_activity_score": ratio0(num("n_180"), n),
        "historical_activity_score": ratio0(n - num("n_180"), n),
        "recency_weighted_amount": dbl("w_amt"),
        "exponential_decay_default_score": dbl("exp_damt"),
        "half_life_30d_amount": dbl("hl30"),
        "half_life_90d_amount": dbl("hl90"),
        "recency_score": F.when(n == 0, 0.0)
        .when(c("age_max") > 0, 1 - c("age_min") / c("age_max"))
        .otherwise(1.0),
        "stale_portfolio_flag": flag((n == 0) | (c("age_min") > 365)),
        "fresh_portfolio_flag": flag(c("age_min") < 90),
    }


def default_lifecycle_features() -> Columns:
    n, nr, nd = num("n"), num("nr"), num("nd")
    again = c("dflt_after_r1") > 0
    return {
        "credits_after_first_recovery": num("after_r1"),
        "defaulted_again_after_recovery": flag(again),
        "days_clean_before_first_default": F.when(
            nd > 0, c("dflt_day_min") - c("day_first")
        ).otherwise(c("age_max")),
        "time_since_last_recovery_days": c("since_rec"),
        "recovery_to_new_credit_days": c("open_after_r1"),
        "multiple_recovery_cycles": flag(nr > 1),
        "recovery_cycle_count": nr,
        "clean_after_recovery": flag(
            (n > 0) & F.when(nr > 0, c("dflt_after_r1") == 0).otherwise(nd == 0)
        ),
        "first_default_age_months": months("first_dflt"),
        "last_default_age_months": months("since_dflt"),
    }


def early_default_features() -> Columns:
    return {
        "has_early_default_90d": flag(c("n_e90") > 0),
        "has_early_default_180d": flag(c("n_e180") > 0),
        "has_early_default_365d": flag(c("n_e365") > 0),
        "early_default_count_90d": num("n_e90"),
        "early_default_count_180d": num("n_e180"),
        "early_default_ratio": ratio0(num("n_e180"), num("nd")),
        "fastest_default_days": c("ttd_min"),
        "slowest_default_days": c("ttd_max"),
        "early_default_amount": dbl("sum_e180"),
        "early_default_amount_ratio": ratio0(dbl("sum_e180"), dbl("sumd")),
    }


TIERS = ["micro", "small_tier", "medium_tier", "large_tier"]


def amount_tier_features() -> Columns:
    n = [num(f"tier{i}") for i in range(4)]
    d = [num(f"tier{i}_d") for i in range(4)]
    rate = [ratio0(x, y) for x, y in zip(d, n)]
    out: Columns = {}
    for i, tier in enumerate(TIERS):
        out[f"{tier}_count"] = n[i]
        out[f"{tier}_default_rate"] = rate[i]
    out["micro_credit_count"] = n[0]
    out["micro_credit_default_rate"] = rate[0]
    out["tier_with_most_defaults"] = _first_peak(d, 0)
    used = [F.when(x > 0, r) for x, r in zip(n, rate)]
    top = F.greatest(*used)
    best = F.when(top.isNull(), 0)
    for i, r in enumerate(used):
        best = best.when(r == top, i)
    out["tier_with_highest_default_rate"] = best
    out["tier_spread"] = add_all([flag(x > 0) for x in n])
    out["dominant_tier"] = _first_peak(n, 0)
    return out


def cross_product_features() -> Columns:
    n, nd = num("n"), num("nd")
    hit = add_all([flag(c(f"nd_{p}") > 0) for p in PRODUCTS])
    elsewhere = nd - num("nd_mg")
    return {
        "cf_default_then_il_default": flag(c("cf_il") > 0),
        "il_default_then_cf_default": flag(c("il_cf") > 0),
        "multi_product_default": flag(hit > 1),
        "multi_product_default_count": hit,
        "mortgage_with_default_elsewhere": flag((c("n_mg") > 0) & (elsewhere > 0)),
        "all_products_clean": flag(nd == 0),
        "unsecured_default_rate": ratio0(elsewhere, n - num("n_mg")),
        "secured_default_rate": ratio0(num("nd_mg"), num("n_mg")),
        "high_risk_product_only": flag((n > 0) & (c("n_il") + c("n_mg") == 0)),
        "low_risk_product_only": flag((n > 0) & (c("n_mg") == n)),
        "cross_product_default_spread": ratio0(hit, _distinct_products()),
    }


def freshness_features() -> Columns:
    avg_gap = F.coalesce(F.when(c("n") >= 2, _gap_avg()), F.lit(0.0))
    return {
        "newest_credit_age_at_app_days": c("age_min"),
        "applied_with_fresh_credit_30d": flag(c("age_min") <= 30),
        "applied_with_fresh_credit_60d": flag(c("age_min") <= 60),
        "credits_near_application_before": num("n_before"),
        "credits_near_application_after": num("n_after"),
        "amount_near_application_before": dbl("amt_before_app"),
        "credit_surge_at_application": flag(c("n_before") + c("n_after") > 2),
        "application_timing_score": F.least(F.lit(1.0), avg_gap / 365.0),
    }


def concentration_features() -> Columns:
    total = dbl("sum")
    top1 = ratio0(dbl("max"), total)
    defaulted = ratio0(dbl("sumd"), total)
    product = ratio0(F.greatest(*[num(f"sum_{p}") for p in PRODUCTS]), total)
    return {
        "single_large_exposure_flag": flag(top1 > 0.5),
        "top_credit_concentration": top1,
        "top_2_concentration": ratio0(dbl("top2"), total),
        "top_3_concentration": ratio0(dbl("top3"), total),
        "max_single_credit_amount": dbl("max"),
        "min_single_credit_amount": dbl("min"),
        "defaulted_concentration": defaulted,
        "active_concentration": ratio0(dbl("suma"), total),
        "single_product_concentration": product,
        "concentration_risk_score": F.least(
            F.lit(10.0), (top1 * 3 + defaulted * 5 + product * 2) * 10
        ),
    }


def anomaly_features() -> Columns:
    two = c("n") >= 2
    z = ratio0(c("amt_last") - c("avg_prev"), F.when(c("std_prev") > 0, c("std_prev")))
    outlier = two & (F.abs(z) > 2)
    last_count = add_all([F.when(c(f"last_{p}") > 0, c(f"n_{p}")).otherwise(0) for p in PRODUCTS])
    new_product = two & (last_count == 1)
    fast = _gap_trend() < -7
    return {
        "latest_amount_zscore": F.when(two, z).otherwise(0.0),
        "is_latest_amount_outlier": flag(outlier),
        "amount_iqr_outlier_count": F.when(two, c("n_iqr_out")).otherwise(0),
        "behavior_change_flag": flag(outlier | new_product),
        "sudden_large_credit_flag": flag(two & (c("amt_last") > c("avg_prev") * 3)),
        "sudden_product_change": flag(new_product),
        "unusual_timing_flag": flag(two & ((c("n_rapid") > 0) | fast)),
        "risk_score_change": F.when(two, dbl("w180_d")).otherwise(0.0),
        "velocity_anomaly_flag": flag(two & fast),
        "dormancy_break_flag": flag(c("gap_last") > 365),
    }


def payment_features() -> Columns:
    sums = {p: F.when(c(f"n_{p}") > 0, c(f"pay_{p}")) for p in PRODUCTS}
    top = F.greatest(*sums.values())
    # Index of the product with the largest payment (IL, MG, IS, CF).
    index = {"cf": 3, "il": 0, "is": 2, "mg": 1}
    largest = F.when(num("np") == 0, 0)
    for p, i in index.items():
        largest = largest.when(sums[p] == top, i)
    return {
        "total_monthly_payment": dbl("pay_sum"),
        "avg_monthly_payment": dbl("pay_avg"),
        "max_monthly_payment": dbl("pay_max"),
        "min_monthly_payment": dbl("pay_min"),
        "std_monthly_payment": dbl("pay_std"),
        "il_monthly_payment_total": dbl("pay_il"),
        "mg_monthly_payment_total": dbl("pay_mg"),
        "is_monthly_payment_total": dbl("pay_is"),
        "active_monthly_payment": dbl("pay_active"),
        "payment_count": num("np"),
        "payment_concentration": ratio0(dbl("pay_max"), dbl("pay_sum")),
        "largest_payment_product": largest.otherwise(0),
        "high_payment_credit_count": num("pay_hi"),
        "low_payment_credit_count": num("pay_lo"),
        "median_monthly_payment": dbl("pay_med"),
    }


def remaining_term_features() -> Columns:
    return {
        "avg_remaining_months": dbl("rem_avg"),
        "max_remaining_months": dbl("rem_max"),
        "min_remaining_months": dbl("rem_min"),
        "total_remaining_months": dbl("rem_sum"),
        "has_maturing_3m": flag(c("nt_3") > 0),
        "has_maturing_6m": flag(c("nt_6") > 0),
        "has_maturing_12m": flag(c("nt_12") > 0),
        "maturing_amount_3m": dbl("sumt_3"),
        "maturing_amount_6m": dbl("sumt_6"),
        "maturing_count_6m": num("nt_6"),
        "weighted_remaining_term": ratio0(dbl("rem_amt"), dbl("sumt")),
        "remaining_term_spread": dbl("rem_max") - dbl("rem_min"),
    }


def obligation_features() -> Columns:
    total = dbl("sum")
    burden = total + dbl("future_pay")
    return {
        "total_credit_burden": burden,
        "future_payment_obligation": dbl("future_pay"),
        "past_payment_made": dbl("past_pay"),
        "single_credit_burden_ratio": ratio0(dbl("max"), burden),
        "mortgage_burden_ratio": ratio0(dbl("sum_mg"), burden),
        "unsecured_burden_ratio": ratio0(total - dbl("sum_mg"), burden),
        "new_burden_12m": dbl("sum_w12"),
        "burden_growth_rate": ratio0(dbl("sum_w12"), total),
        "burden_per_credit": ratio0(burden, num("n")),
        "monthly_burden_intensity": ratio0(dbl("pay_sum"), num("np")),
        "high_burden_flag": flag(burden > 200000),
        "burden_to_amount_ratio": ratio0(burden, total),
    }


def dti_proxy_features() -> Columns:
    pay, total, n = dbl("pay_sum"), dbl("sum"), num("n")
    annual = ratio0(pay * 12, total)
    return {
        "payment_to_amount_ratio": ratio0(pay, total),
        "payment_intensity": ratio0(pay, n),
        "avg_payment_per_credit": ratio0(pay, n),
        "payment_to_exposure_ratio": ratio0(pay, dbl("max")),
        "high_payment_credit_ratio": ratio0(num("pay_hi"), n),
        "unsustainable_payment_flag": flag(annual > 0.5),
        "payment_vs_historical_avg": F.lit(1.0),
        "payment_growth_rate": F.lit(0.0),
        "annualized_payment_ratio": annual,
        "payment_efficiency_score": F.least(F.lit(10.0), annual * 10),
    }


def maturity_features() -> Columns:
    rate = ratio0(num("nc_clean"), num("nc"))
    return {
        "recently_closed_count": num("nc"),
        "recently_closed_amount": dbl("sumc"),
        "closed_without_default": num("nc_clean"),
        "closed_with_default": num("nc") - num("nc_clean"),
        "closure_success_rate": rate,
        "avg_closure_to_plan": F.lit(1.0),
        "early_closure_count": F.lit(0),
        "on_time_closure_count": num("nc"),
        "maturity_behavior_score": F.least(F.lit(10.0), rate * 10),
        "has_recent_closure": flag(c("nc") > 0),
    }


def _spread_over_half() -> Column:
    """Is the deviation of the durations more than half their mean? In whole numbers, as a tie is neither."""
    n, total, squares = (c(x).cast("decimal(38,0)") for x in ("nu", "dur_sum", "dur_squares"))
    return (total > 0) & (4 * n * (n * squares - total * total) > (n - 1) * total * total)


def duration_risk_features() -> Columns:
    cv = ratio(c("dur_std"), c("dur_avg"))
    return {
        "avg_duration_months": dbl("dur_avg"),
        "max_duration_months": dbl("dur_max"),
        "min_duration_months": dbl("dur_min"),
        "duration_spread": dbl("dur_max") - dbl("dur_min"),
        "duration_cv": F.when(num("nu") == 0, 0.0).otherwise(cv),
        "prefers_long_term": flag(ratio(c("n_gt60"), c("nu")) > 0.5),
        "prefers_short_term": flag(ratio(c("n_lt24"), c("nu")) > 0.5),
        "mixed_duration_portfolio": flag(_spread_over_half()),
        "duration_to_amount_ratio": ratio0(dbl("dur_sum"), dbl("sumu") / 10000),
        "high_duration_high_amount": flag(c("n_long_big") > 0),
    }


def payment_behavior_features() -> Columns:
    some = num("np") > 0
    cv = ratio0(F.coalesce(c("pay_std"), F.lit(0.0)), dbl("pay_avg"))
    return {
        "payment_amount_cv": cv,
        "payment_consistency_score": F.when(some, 1 / (1 + cv)).otherwise(0.0),
        "has_minimum_payments": flag(c("pay_tiny") > 0),
        "first_payment_vs_last": F.when(
            num("np") >= 2, ratio0(c("pay_first"), c("pay_last"))
        ).otherwise(0.0),
        "payment_trend_slope": dbl("pay_slope"),
        "avg_payment_by_vintage": dbl("pay_avg"),
        "payment_spread": dbl("pay_max") - dbl("pay_min"),
        "payment_skewness": dbl("pay_skew"),
    }


def term_structure_features() -> Columns:
    nu = num("nu")
    some = nu > 0
    share = [
        ratio0(num("n_lt12"), nu),
        ratio0(nu - num("n_lt12") - num("n_gt60"), nu),
        ratio0(num("n_gt60"), nu),
    ]
    hhi = add_all([s * s for s in share])
    diversity = F.when(some, 1 - hhi).otherwise(0.0)
    return {
        "weighted_avg_term": ratio0(dbl("dur_amt"), dbl("sumu")),
        "term_concentration_hhi": hhi,
        "term_diversity_score": diversity,
        "short_term_ratio": share[0],
        "medium_term_ratio": share[1],
        "long_term_ratio": share[2],
        "amortizing_ratio": ratio0(nu, num("n")),
        "term_structure_score": diversity * 10,
    }


FAMILIES: dict[str, Callable[[], Columns]] = {
    "ratio": ratio_features,
    "temporal": temporal_features,
    "trend": trend_features,
    "risk_signal": risk_signal_features,
    "diversity": diversity_features,
    "behavioral": behavioral_features,
    "default_pattern": default_pattern_features,
    "sequence": sequence_features,
    "size_pattern": size_pattern_features,
    "burst": burst_features,
    "interval": interval_features,
    "seasonal": seasonal_features,
    "weighted": weighted_features,
    "co_applicant": co_applicant_features,
    "relative": relative_features,
    "complexity": complexity_features,
    "time_decay": time_decay_features,
    "default_lifecycle": default_lifecycle_features,
    "early_default": early_default_features,
    "amount_tier": amount_tier_features,
    "cross_product": cross_product_features,
    "freshness": freshness_features,
    "concentration": concentration_features,
    "anomaly": anomaly_features,
    "payment": payment_features,
    "remaining_term": remaining_term_features,
    "obligation": obligation_features,
    "dti_proxy": dti_proxy_features,
    "maturity": maturity_features,
    "duration_risk": duration_risk_features,
    "payment_behavior": payment_behavior_features,
    "term_structure": term_structure_features,
}

# Times and ages of something that never happened: NULL by default, 0 on request.
UNDEFINED_TIMES = [
    "oldest_credit_age_months",
    "newest_credit_age_months",
    "avg_credit_age_months",
    "days_since_last_default",
    "days_since_last_credit",
    "avg_time_to_default_days",
    "avg_recovery_time_days",
    "min_time_to_default_days",
    "max_time_to_default_days",
    "std_time_to_default_days",
    "min_recovery_time_days",
    "max_recovery_time_days",
    *[f"{p}_time_to_default_{s}_days" for p in PRODUCTS for s in ("min", "max", "avg")],
    "avg_inter_credit_days",
    "min_inter_credit_days",
    "max_inter_credit_days",
    "std_inter_credit_days",
    "median_inter_credit_days",
    "longest_credit_gap_days",
    *[f"{p}_avg_interval_days" for p in PRODUCTS],
    "recency_of_max_amount",
    "fastest_default_days",
    "slowest_default_days",
    "newest_credit_age_at_app_days",
]
# As above, but still NULL for applicants without any credit.
UNDEFINED_LIFECYCLE = [
    "time_since_last_recovery_days",
    "recovery_to_new_credit_days",
    "first_default_age_months",
    "last_default_age_months",
]


def family_columns(names: list[str], undefined: str = "null") -> Columns:
    """Feature expressions of the named families."""
    if undefined not in ("null", "zero"):
        raise ValueError("undefined must be 'null' or 'zero'")
    out: Columns = {}
    for name in names:
        out.update(FAMILIES[name]())
    if undefined == "zero":
        for f in set(UNDEFINED_TIMES) & set(out):
            out[f] = F.coalesce(out[f], F.lit(0))
        for f in set(UNDEFINED_LIFECYCLE) & set(out):
            out[f] = F.when(num("n") > 0, F.coalesce(out[f], F.lit(0)))
    return out


def family_frame(
    apps: DataFrame,
    bureau: DataFrame,
    names: list[str],
    undefined: str = "null",
    max_rows_per_key: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """One row per applicant with the features of the named families.

    Aggregates and window columns no named family reads are pruned from the plan.
    """
    people = with_application_totals(apps, bureau) if "co_applicant" in names else apps
    cols = family_columns(names, undefined)
    profile = applicant_profile(apps, bureau, max_rows_per_key, exprs=list(cols.values()))
    frame = people.join(profile, KEY, "left")
    return frame.select(*KEY, *[e.alias(k) for k, e in cols.items()])
