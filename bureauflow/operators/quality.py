"""Data-quality rules, schema validation and pre-/post-model checks as result tables.

All rules of one kind are evaluated in one aggregate over the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = "check_name, check_type, severity, passed, observed, threshold".split(", ")

# Type names of schema declarations and the Spark types they accept.
TYPE_NAMES = {
    "string": (T.StringType,),
    "integer": (T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "date": (T.DateType,),
    "timestamp": (T.TimestampType,),
    "boolean": (T.BooleanType,),
}


class QualityError(ValueError):
    pass


def _as_rows(wide: DataFrame, rules: list[tuple[str, str, str, float]]) -> DataFrame:
    """One-row aggregate (columns r0, r1, ...) to one result row per rule."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(kind).alias("check_type"),
                (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
                (F.col(f"r{i}") <= limit).alias("passed"),
                F.col(f"r{i}").cast("double").alias("observed"),
                F.lit(float(limit)).alias("threshold"),
            )
            for i, (name, kind, severity, limit) in enumerate(rules)
        ]
    )
    return wide.select(F.inline(rows))


def _share(cond: Column) -> Column:
    return F.coalesce(F.count_if(cond) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0))


def null_checks(df: DataFrame, rules: dict[str, float], severity: str = "error") -> DataFrame:
    """Share of NULLs per column against its maximum."""
    agg = df.agg(*[_share(F.col(c).isNull()).alias(f"r{i}") for i, c in enumerate(rules)])
    return _as_rows(agg, [(f"null_{c}", "null", severity, m) for c, m in rules.items()])


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, null_count, null_ratio, non_null_count."""
    columns = columns or df.columns
    agg = df.agg(
        F.count("*").alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                (F.col("n") - F.col(f"c{i}")).alias("null_count"),
                ((F.col("n") - F.col(f"c{i}")) / F.col("n")).alias("null_ratio"),
                F.col(f"c{i}").alias("non_null_count"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return agg.select(F.inline(rows))


def range_checks(
    df: DataFrame, rules: dict[str, tuple[float | None, float | None]], severity: str = "warning"
) -> DataFrame:
    """Number of values below the minimum or above the maximum."""
    exprs = []
    for i, (c, (low, high)) in enumerate(rules.items()):
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(c) < low)
        if high is not None:
            bad = bad | (F.col(c) > high)
        exprs.append(F.count_if(bad).alias(f"r{i}"))
    return _as_rows(df.agg(*exprs), [(f"range_{c}", "range", severity, 0) for c in rules])


def allowed_value_checks(
    df: DataFrame, rules: dict[str, list], severity: str = "error"
) -> DataFrame:
    """Number of values outside the list; NULL is not a violation."""
    agg = df.agg(
        *[F.count_if(~F.col(c).isin(v)).alias(f"r{i}") for i, (c, v) in enumerate(rules.items())]
    )
    return _as_rows(agg, [(f"allowed_{c}", "allowed", severity, 0) for c in rules])


def invalid_values(df: DataFrame, column: str, allowed: list, k: int = 5) -> DataFrame:
    """The k first distinct values outside the list."""
    bad = df.where(~F.col(column).isin(allowed)).select(column).distinct()
    return bad.orderBy(column).limit(k)


def duplicate_check(
    df: DataFrame,
    columns: list[str] | None = None,
    max_ratio: float = 0.01,
    severity: str = "warning",
) -> DataFrame:
    """Share of rows that repeat another row (or its listed columns)."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count("*").alias("n"))
    agg = groups.agg(
        F.coalesce(
            (F.sum("n") - F.count("*")) / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)
        ).alias("r0")
    )
    return _as_rows(agg, [("duplicate_rows", "duplicate", severity, max_ratio)])


def expression_checks(
    df: DataFrame, rules: dict[str, tuple[str, float]], severity: str = "error"
) -> DataFrame:
    """Share of rows violating a SQL condition, such as date order, against a tolerance."""
    agg = df.agg(
        *[
            _share(~F.coalesce(F.expr(cond), F.lit(False))).alias(f"r{i}")
            for i, (cond, _) in enumerate(rules.values())
        ]
    )
    return _as_rows(agg, [(k, "date", severity, tol) for k, (_, tol) in rules.items()])


# Declared date-order rules and their tolerances.
DATE_RULES = {
    "opening_date_before_application": ("opening_date <= application_date", 0.01),
    "default_after_opening": ("default_date IS NULL OR default_date >= opening_date", 0.001),
    "recovery_after_default": (
        "recovery_date IS NULL OR (default_date IS NOT NULL AND recovery_date >= default_date)",
        0.001,
    ),
}


def uniqueness_check(df: DataFrame, columns: list[str], severity: str = "error") -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(*columns).agg(F.count("*").alias("n"))
    agg = repeated.agg(F.count_if(F.col("n") > 1).alias("r0"))
    return _as_rows(agg, [("unique_" + "_".join(columns), "uniqueness", severity, 0)])


def orphan_check(
    child: DataFrame,
    parent: DataFrame,
    keys: list[str],
    max_ratio: float = 0.0,
    severity: str = "error",
) -> DataFrame:
    """Share of child rows without a parent."""
    known = parent.select(*keys).distinct().withColumn("known", F.lit(True))
    agg = child.join(known, keys, "left").agg(_share(F.col("known").isNull()).alias("r0"))
    return _as_rows(agg, [("orphans_" + "_".join(keys), "referential", severity, max_ratio)])


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    return child.join(parent, keys, "left_anti")


def report(results: list[DataFrame]) -> DataFrame:
    """All result rows of a table."""
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def summary(results: DataFrame) -> DataFrame:
    """checks, errors, warnings, passed (no failed check of severity error)."""
    failed = ~F.col("passed")
    errors = F.count_if(failed & (F.col("severity") == "error"))
    return results.agg(
        F.count("*").alias("checks"),
        errors.alias("errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
        (errors == 0).alias("passed"),
    )


def require(results: DataFrame) -> None:
    """Raise when a check of severity error failed."""
    bad = results.where(~F.col("passed") & (F.col("severity") == "error"))
    names = [r.check_name for r in bad.select("check_name").collect()]
    if names:
        raise QualityError(f"failed checks: {', '.join(names)}")


def validate_schema(df: DataFrame, expected: T.StructType, strict: bool = True) -> DataFrame:
    """Differences between the schema of df and the expected one: column, issue, expected, actual."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    accepted = {kind: types for types in TYPE_NAMES.values() for kind in types}
    rows = [(c, "missing", want[c].simpleString(), None) for c in want if c not in have]
    for c in want:
        same = accepted.get(type(want[c]), (type(have.get(c)),))
        if c in have and not isinstance(have[c], same):
            rows.append((c, "type", want[c].simpleString(), have[c].simpleString()))
    if strict:
        rows += [(c, "extra", None, t.simpleString()) for c, t in have.items() if c not in want]
    return df.sparkSession.createDataFrame(
        rows, "column string, issue string, expected string, actual string"
    )


def validate_and_raise(df: DataFrame, expected: T.StructType, strict: bool = True) -> None:
    issues = validate_schema(df, expected, strict).collect()
    if issues:
        raise QualityError("; ".join(f"{r.column}: {r.issue}" for r in issues))


def outlier_shares(df: DataFrame, columns: list[str], iqr: float = 3.0, z: float = 4.0) -> DataFrame:
    """feature, iqr_outliers, z_outliers, n: values outside the quartile fences / beyond z sigmas."""
    from bureauflow.functions import ranking
    from bureauflow.operators.binning import long_form

    long = long_form(df, columns)
    q = ranking.quantiles(long, ["feature"], "value", [0.25, 0.75])
    moments = long.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    bounds = q.join(moments, "feature").select(
        "feature",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("q3"),
        "mean",
        "std",
    )
    fence = iqr * (F.col("q3") - F.col("q1"))
    v = F.col("value")
    # one row per feature: bounded by the number of columns
    return (
        long.join(F.broadcast(bounds), "feature")
        .groupBy("feature")
        .agg(
            F.count_if((v < F.col("q1") - fence) | (v > F.col("q3") + fence)).alias(
                "iqr_outliers"
            ),
            F.count_if(F.abs(v - F.col("mean")) > z * F.col("std")).alias("z_outliers"),
            F.count("value").alias("n"),
        )
    )


def _check_rows(wide: DataFrame, checks: list[tuple[str, Column, str | Column]]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                status.alias("status"),
                (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
            )
            for name, status, severity in checks
        ]
    )
    return wide.select(F.inline(rows))


def _grade(fail: Column | None = None, warn: Column | None = None) -> Column:
    out = F.lit("PASS")
    if warn is not None:
        out = F.when(warn, "WARNING").otherwise(out)
    if fail is not None:
        out = F.when(fail, "FAIL").otherwise(out)
    return out


def pre_model_checks(
    df: DataFrame,
    features: list[str],
    target: str = "target",
    date: str = "date",
    id_column: str = "uid",
) -> DataFrame:
    """Checks before model development: check_name, status, severity.

    A missing column fails its check and leaves out those that need it. Scalars come from one
    aggregate; the leakage check folds the univariate AUC of every feature.
    """
    from bureauflow.operators.binning import long_form
    from bureauflow.operators.metrics import auc_table

    has = {name: name in df.columns for name in (target, date, id_column)}
    t = F.col(target) if has[target] else F.lit(None).cast("int")
    d = F.col(date) if has[date] else F.lit(None).cast("date")
    quarters = F.year(F.max(d)) * 4 + F.quarter(F.max(d)) - (
        F.year(F.min(d)) * 4 + F.quarter(F.min(d))
    )
    wide = df.agg(
        F.count("*").alias("n"),
        F.count_if(t.isNotNull() & ~t.isin(0, 1)).alias("odd_targets"),
        F.count_if(t.isNull()).alias("null_targets"),
        F.avg(t).alias("bad_rate"),
        F.min(t).alias("lowest"),
        F.max(t).alias("highest"),
        F.count(d).alias("dates"),
        (quarters + 1).alias("quarters"),
    )
    if has[id_column]:
        ids = df.groupBy(id_column).agg(F.count("*").alias("k"))
        wide = wide.join(ids.agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("repeated_ids")))
    else:
        wide = wide.withColumn("repeated_ids", F.lit(0))
    present = [f for f in features if f in df.columns]
    if has[target] and present:
        auc = auc_table(long_form(df, present, [target]), "value", target, ["feature"])
        leaks = (F.col("n") >= 50) & (F.greatest(F.col("auc"), 1 - F.col("auc")) > 0.95)
        wide = wide.join(auc.agg(F.count_if(leaks).alias("leaking")))
    numeric = {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
    }
    r = F.col("bad_rate")
    no_rate = r.isNull() | (r < 0.01) | (r > 0.50)
    checks = [
        ("non_empty", _grade(F.col("n") == 0), "critical"),
        ("target_exists", _grade(F.lit(not has[target])), "critical"),
    ]
    if has[target]:
        checks += [
            ("target_binary", _grade(F.col("odd_targets") > 0), "critical"),
            ("target_no_nulls", _grade(F.col("null_targets") > 0), "critical"),
            (
                "bad_rate_range",
                _grade(no_rate, (r < 0.03) | (r > 0.40)),
                F.when(no_rate, "critical").otherwise("warning"),
            ),
        ]
    checks.append(("date_exists", _grade(F.lit(not has[date]) | (F.col("dates") == 0)), "critical"))
    if has[date]:
        short = F.col("quarters").isNull() | (F.col("quarters") < 2)
        checks.append(("date_coverage", _grade(short), "critical"))
    mixed = any(f not in numeric for f in features)
    checks += [
        ("features_numeric", _grade(warn=F.lit(mixed)), "warning"),
        ("duplicate_ids", _grade(warn=F.col("repeated_ids") > 0), "warning"),
        ("sample_size", _grade(warn=F.col("n") < 500), "warning"),
    ]
    if has[target] and present:
        # one class alone can't be told apart, which is worth a warning of its own
        single = F.col("lowest").eqNullSafe(F.col("highest"))
        checks.append(("leakage", _grade(warn=single | (F.col("leaking") > 0)), "warning"))
    return _check_rows(wide, checks)


def post_model_checks(
    performance: DataFrame,
    score_psi: DataFrame,
    importance: DataFrame,
    bins: DataFrame,
    min_auc: float = 0.65,
    max_overfit_gap: float = 0.05,
    max_oot_drop: float = 0.08,
    max_score_psi: float = 0.25,
    max_concentration: float = 0.50,
    min_oot_bads: int = 50,
) -> DataFrame:
    """Checks on result tables (one row per period, feature or bin): check_name, status, severity."""
    period, auc = F.lower("period"), F.col("auc")
    by = lambda cond: F.max(F.when(cond, auc))
    oot = period.startswith("oot")
    perf = performance.agg(
        F.min("auc").alias("min_auc"),
        F.min("gini").alias("min_gini"),
        (by(period == "train") - by(period == "test")).alias("gap"),
        (by(period == "test") - F.min(F.when(oot, auc))).alias("drop"),
        F.min(F.when(oot, F.col("n_bads"))).alias("oot_bads"),
    )
    psi = score_psi.agg(F.max("psi").alias("max_psi"))
    share = importance.agg((F.max("importance") / F.sum("importance")).alias("top_share"))
    w = Window.partitionBy("feature").orderBy("bin_id")
    steps = bins.where(F.col("bin_id") >= 0).withColumn("step", F.col("woe") - F.lag("woe").over(w))
    mono = (
        steps.groupBy("feature")
        .agg(((F.min("step") >= 0) | (F.max("step") <= 0)).alias("mono"))
        .agg(F.count_if(~F.col("mono")).alias("non_monotonic"))
    )
    return _check_rows(
        perf.join(psi).join(share).join(mono),
        [
            ("discrimination_auc", _grade(F.col("min_auc") < min_auc), "critical"),
            ("discrimination_gini", _grade(warn=F.col("min_gini") < 2 * min_auc - 1), "warning"),
            ("overfitting", _grade(warn=F.col("gap") > max_overfit_gap), "warning"),
            ("oot_stability", _grade(warn=F.col("drop") > max_oot_drop), "warning"),
            ("score_psi", _grade(warn=F.col("max_psi") > max_score_psi), "warning"),
            ("concentration", _grade(warn=F.col("top_share") > max_concentration), "warning"),
            ("woe_monotonicity", _grade(warn=F.col("non_monotonic") > 0), "info"),
            ("oot_sample_size", _grade(warn=F.col("oot_bads") < min_oot_bads), "warning"),
        ],
    )
