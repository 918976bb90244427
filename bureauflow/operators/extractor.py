"""The compact feature set: 81 columns from one aggregate over the dated tradelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureauflow.functions.expressions import flag, ratio0, sum_if
from bureauflow.operators.enrich import attach_application_date, with_optional_columns
from bureauflow.schema import CREDIT_PRODUCTS, KEY

PERIODS = [3, 6, 12, 24]


def _measures() -> dict[str, Column]:
    c = F.col
    credit = c("product_type").isin(CREDIT_PRODUCTS)
    other = ~credit
    dflt, rec, amt, age = c("default_date"), c("recovery_date"), c("total_amount"), c("age")
    on_credit = lambda x: F.when(credit, x)
    out = {
        "total_credit_amount": sum_if(credit, amt),
        "avg_credit_amount": F.avg(on_credit(amt)),
        "max_credit_amount": F.max(on_credit(amt)),
        "min_credit_amount": F.min(on_credit(amt)),
        "std_credit_amount": F.stddev_samp(on_credit(amt)),
        "total_exposure": F.sum(amt),
        "total_credit_count": F.count_if(credit),
        "distinct_product_count": sum(
            (F.max(F.coalesce(c("product_type") == p, F.lit(False)).cast("int")) for p in CREDIT_PRODUCTS),
            F.lit(0),
        ),
        "active_credit_count": F.count_if(credit & dflt.isNull()),
        "defaulted_credit_count": F.count_if(credit & dflt.isNotNull() & rec.isNull()),
        "recovered_credit_count": F.count_if(credit & rec.isNotNull()),
        "ever_defaulted_count": F.count_if(credit & dflt.isNotNull()),
        "total_record_count": F.count("*"),
        "total_defaulted_amount": sum_if(credit & dflt.isNotNull() & rec.isNull(), amt),
        "oldest_credit_age_months": F.max(on_credit(age)),
        "newest_credit_age_months": F.min(on_credit(age)),
        "avg_credit_age_months": F.avg(on_credit(age)),
        "avg_time_to_default_days": F.avg(on_credit(F.datediff(dflt, "opening_date"))),
        "avg_recovery_time_days": F.avg(on_credit(F.datediff(rec, dflt))),
        "days_since_last_default": F.min(on_credit(F.datediff("application_date", dflt))),
        "non_auth_overdraft_count": F.count_if(c("product_type") == "NON_AUTH_OVERDRAFT"),
        "non_auth_overdraft_amount": sum_if(c("product_type") == "NON_AUTH_OVERDRAFT", amt),
        "overlimit_count": F.count_if(c("product_type") == "OVERLIMIT"),
        "overlimit_amount": sum_if(c("product_type") == "OVERLIMIT", amt),
    }
    for p in CREDIT_PRODUCTS:
        is_p = c("product_type") == p
        out[f"{p}_count"] = F.count_if(is_p)
        out[f"{p}_total_amount"] = sum_if(is_p, amt)
        out[f"{p}_avg_amount"] = F.avg(F.when(is_p, amt))
        out[f"{p}_default_count"] = F.count_if(is_p & dflt.isNotNull())
    for m in PERIODS:
        recent = age <= m
        out[f"credits_opened_last_{m}m"] = F.count_if(credit & recent)
        out[f"amount_opened_last_{m}m"] = sum_if(credit & recent, amt)
        out[f"defaults_last_{m}m"] = F.count_if(credit & recent & dflt.isNotNull())
        out[f"overdraft_events_last_{m}m"] = F.count_if(other & recent)
    return out


def _derived() -> dict[str, Column]:
    c = F.col
    n, total = c("total_credit_count"), c("total_credit_amount")
    out = {
        "has_current_default": flag(c("defaulted_credit_count") > 0),
        "has_ever_defaulted": flag(c("ever_defaulted_count") > 0),
        "has_non_auth_overdraft": flag(c("non_auth_overdraft_count") > 0),
        "has_overlimit": flag(c("overlimit_count") > 0),
        "financial_stress_flag": flag(
            (c("non_auth_overdraft_count") > 0) | (c("overlimit_count") > 0)
        ),
        "default_ratio": ratio0(c("defaulted_credit_count"), n),
        "recovery_ratio": ratio0(c("recovered_credit_count"), c("ever_defaulted_count")),
        "default_amount_ratio": ratio0(c("total_defaulted_amount"), total),
        "secured_ratio": ratio0(c("MORTGAGE_count"), n),
        "revolving_ratio": ratio0(c("CASH_FACILITY_count"), n),
        "high_risk_product_ratio": ratio0(c("INSTALLMENT_SALE_count"), n),
        "credit_velocity": ratio0(c("credits_opened_last_3m"), n),
        "amount_velocity": ratio0(c("amount_opened_last_3m"), total),
        "product_diversity_ratio": c("distinct_product_count") / 4.0,
        "credit_history_length_months": c("oldest_credit_age_months"),
    }
    for p in CREDIT_PRODUCTS:
        out[f"{p}_ratio"] = ratio0(c(f"{p}_count"), n)
        out[f"{p}_amount_ratio"] = ratio0(c(f"{p}_total_amount"), total)
    trends = {
        "credit_count_trend_6m_vs_12m": "credits_opened",
        "credit_amount_trend_6m_vs_12m": "amount_opened",
        "default_trend_6m_vs_12m": "defaults",
    }
    for name, stem in trends.items():
        six, twelve = c(f"{stem}_last_6m"), c(f"{stem}_last_12m")
        out[name] = six - (twelve - six)
    return out


GROUPS = {
    "amounts": ["total_credit_amount", "avg_credit_amount", "max_credit_amount",
                "min_credit_amount", "std_credit_amount", "total_exposure"],
    "counts": ["total_credit_count", "distinct_product_count", "active_credit_count",
               "defaulted_credit_count", "recovered_credit_count", "ever_defaulted_count",
               "total_record_count"],
    "products": [f"{p}_{s}" for p in CREDIT_PRODUCTS
                 for s in ("count", "total_amount", "avg_amount", "default_count")],
    "defaulted": ["total_defaulted_amount"],
    "temporal": ["oldest_credit_age_months", "newest_credit_age_months", "avg_credit_age_months",
                 "avg_time_to_default_days", "days_since_last_default"],
    "periods": [f"{s}_last_{m}m" for m in PERIODS
                for s in ("credits_opened", "amount_opened", "defaults", "overdraft_events")],
    "non_credit": ["non_auth_overdraft_count", "non_auth_overdraft_amount", "overlimit_count",
                   "overlimit_amount"],
    "derived": ["has_current_default", "has_ever_defaulted", "has_non_auth_overdraft",
                "has_overlimit", "financial_stress_flag", "default_ratio", "recovery_ratio",
                "default_amount_ratio", "secured_ratio", "revolving_ratio",
                "high_risk_product_ratio", "credit_velocity", "amount_velocity",
                "credit_count_trend_6m_vs_12m", "credit_amount_trend_6m_vs_12m",
                "default_trend_6m_vs_12m", "product_diversity_ratio",
                "credit_history_length_months",
                *[f"{p}{s}" for p in CREDIT_PRODUCTS for s in ("_ratio", "_amount_ratio")]],
    "recovery_time": ["avg_recovery_time_days"],
}


def extract_features(
    apps: DataFrame, bureau: DataFrame, groups: list[str] | None = None
) -> DataFrame:
    """Applications with the named feature groups (all by default); missing features are 0.

    One row per applicant: of repeated applications the first by date, then by the other columns.
    """
    rest = ["application_date", *[x for x in apps.columns if x not in (*KEY, "application_date")]]
    first = apps.groupBy(*KEY).agg(F.min(F.struct(*rest)).alias("_first"))
    apps = first.select(*KEY, "_first.*").select(*apps.columns)
    dated = attach_application_date(with_optional_columns(bureau), apps).withColumn(
        "age", F.months_between("application_date", "opening_date")
    )
    measured = dated.groupBy(*KEY).agg(*[e.alias(k) for k, e in _measures().items()])
    zeros = {k: 0 for k in measured.columns if k not in KEY}
    full = apps.join(measured, KEY, "left").fillna(zeros)
    names = [n for g in (groups or GROUPS) for n in GROUPS[g]]
    derived = _derived()
    return full.select(
        *apps.columns,
        F.concat_ws("||", *KEY).alias("uid"),
        *[derived[n].alias(n) if n in derived else F.col(n) for n in names],
    )


def combine_groups(frames: list[DataFrame]) -> DataFrame:
    """Full outer combination of independently built feature groups; missing values are 0."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, KEY, "full_outer")
    return out.fillna(0, subset=[c for c in out.columns if c not in KEY])


def restore_target(features: DataFrame, apps: DataFrame) -> DataFrame:
    """Application columns (with the untouched target) and features, missing features 0."""
    names = [c for c in features.columns if c not in KEY]
    return apps.join(features, KEY, "left").fillna(0, subset=names)
