"""Points-based scorecard from weight-of-evidence bins and logistic coefficients."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureauflow.operators.binning import _bins_by_feature

c = F.col


def _scale(pdo: float, base_score: float, base_odds: float) -> tuple[float, float]:
    factor = pdo / math.log(2)
    return factor, base_score - factor * math.log(base_odds)


def build_scorecard(
    bins: DataFrame,
    coefficients: dict[str, float],
    intercept: float,
    pdo: float = 20,
    base_score: float = 600,
    base_odds: float = 50,
) -> DataFrame:
    """bins with coefficient and points; the intercept is shared equally by the features."""
    factor, offset = _scale(pdo, base_score, base_odds)
    base = (offset - factor * intercept) / len(coefficients)
    return _with_points(bins, coefficients, F.lit(base) - factor * c("coefficient") * c("woe"))


def build_scaled_scorecard(
    bins: DataFrame,
    coefficients: dict[str, float],
    means: dict[str, float],
    scales: dict[str, float],
    intercept: float,
    target_score: float = 600,
    target_odds: float = 20,
    pdo: float = 50,
) -> DataFrame:
    """Points for coefficients fitted on standardised WoE values."""
    factor, offset = _scale(pdo, target_score, target_odds)
    k = len(coefficients)
    slope = {f: b / scales[f] for f, b in coefficients.items()}
    share = {f: intercept / k - b * means[f] / scales[f] for f, b in coefficients.items()}
    points = -(c("coefficient") * c("woe") + _lookup(share)) * factor + offset / k
    return _with_points(bins, slope, points)


def _lookup(values: dict[str, float]) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for f, v in values.items():
        out = out.when(c("feature") == f, F.lit(float(v)))
    return out


def _with_points(bins: DataFrame, coefficients: dict[str, float], points: Column) -> DataFrame:
    rated = bins.where(c("feature").isin(list(coefficients))).withColumn(
        "coefficient", _lookup(coefficients)
    )
    return rated.withColumn("points", F.bround(points, 0).cast("int"))


def feature_points(value: Column, rows: list) -> Column:
    """Points of one feature: closed numeric bounds, missing bin, 0 outside every bin."""
    regular = [r for r in rows if r["bin_id"] >= 0]
    missing = next((r["points"] for r in rows if r["bin_id"] < 0), 0)
    out = F.when(value.isNull(), F.lit(missing))
    for r in reversed(regular):
        out = out.when((value >= r["lower"]) & (value <= r["upper"]), F.lit(r["points"]))
    return out.otherwise(F.lit(0))


def score_rows(
    df: DataFrame, scorecard: DataFrame, low: int | None = 300, high: int | None = 850
) -> DataFrame:
    """df with `scorecard_score`, the clipped sum of points; a projection without a join."""
    total = F.lit(0)
    for f, rows in _bins_by_feature(scorecard).items():
        if f in df.columns:
            total = total + feature_points(c(f), rows)
    if low is not None:
        total = F.greatest(total, F.lit(low))
    if high is not None:
        total = F.least(total, F.lit(high))
    return df.withColumn("scorecard_score", total.cast("int"))


def score_range(scorecard: DataFrame) -> DataFrame:
    """Smallest and largest attainable total."""
    per = scorecard.groupBy("feature").agg(F.min("points").alias("lo"), F.max("points").alias("hi"))
    return per.agg(F.sum("lo").alias("min_score"), F.sum("hi").alias("max_score"))


def joint_scores(
    df: DataFrame,
    score: str,
    primary_weight: float = 0.7,
    co_weight: float = 0.3,
) -> DataFrame:
    """Score of a joint application: minimum, average and weighted average of its applicants."""
    weight = F.when(c("applicant_type") == "PRIMARY", primary_weight).otherwise(co_weight)
    return df.groupBy("application_id").agg(
        F.min(score).cast("double").alias("min_score"),
        F.avg(score).alias("avg_score"),
        (F.sum(weight * c(score)) / F.sum(weight)).alias("weighted_score"),
        F.count("*").alias("applicants"),
    )
