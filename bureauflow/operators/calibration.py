"""Probability calibration and its quality measures."""

from __future__ import annotations

import math

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bureauflow.functions import ranking
from bureauflow.operators import metrics
from bureauflow.operators.binning import bin_of

c = F.col
EPS = 1e-7


def _vector(df: DataFrame, score: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=[score], outputCol="_x").transform(df)


def platt(df: DataFrame, score: str, target: str) -> DataFrame:
    """df with `calibrated`: logistic regression on the probability."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    data = _vector(df, score)
    n = df.count()
    model = LogisticRegression(
        featuresCol="_x", labelCol=target, regParam=1.0 / max(n, 1), standardization=False
    ).fit(data)
    out = model.transform(data).withColumn("calibrated", vector_to_array("probability")[1])
    return out.select(*df.columns, "calibrated")


# Rows of a score range that is pooled alone, ranges put together at a time, and how often.
RANGE_ROWS = 4_096
FAN_IN = 256
ROUNDS = 3
BLOCKS = "part bigint, start bigint, n bigint, bad bigint"


def _pool(group: pa.Table) -> pa.Table:
    """Neighbouring blocks of one group, pooled until their bad rates rise from each to the next."""
    part = group.column("part")[0].as_py()
    rows = sorted(zip(*(group.column(k).to_pylist() for k in ("start", "n", "bad"))))
    kept: list[tuple[int, int, int]] = []
    for start, n, bad in rows:
        # a rate that is no higher than the one before: whole numbers, so the comparison is exact
        while kept and kept[-1][2] * n >= bad * kept[-1][1]:
            start, before, b = kept.pop()
            n, bad = n + before, bad + b
        kept.append((start, n, bad))
    columns = zip(*kept)
    return pa.table([pa.array([part] * len(kept), pa.int64()), *(pa.array(x, pa.int64()) for x in columns)],
                    ["part", "start", "n", "bad"])


def isotonic_steps(df: DataFrame, score: str, target: str) -> DataFrame:
    """score, n, bad, calibrated: the monotone step fit at every distinct score (pool adjacent violators).

    Ranges of about RANGE_ROWS rows by the rank of the score pool their own scores into blocks of
    rising bad rate; FAN_IN neighbouring ranges then pool each other's blocks, ROUNDS times, and what is
    left is pooled together. Pooling is associative, so the result is that of one pass over all scores.
    Blocks of n rows in all have distinct bad rates, hence there are at most about n ** (2 / 3) of them.
    """
    rows = metrics.curve(df, score, target).select(
        c(score).alias("score"), c("n_before").cast("bigint").alias("start"), "n", "bad"
    )
    rows = rows.withColumn("part", F.floor(c("start") / RANGE_ROWS))
    blocks = rows.select("part", "start", "n", "bad")
    for turn in range(1 + ROUNDS):
        blocks = blocks.groupBy("part").applyInArrow(_pool, BLOCKS)
        wider = F.floor(c("part") / FAN_IN) if turn < ROUNDS - 1 else F.lit(0).cast("bigint")
        blocks = blocks.withColumn("part", wider)
    # a block stands at its start and at the start of every further range it reaches into
    first, last = F.floor(c("start") / RANGE_ROWS), F.floor((c("start") + c("n") - 1) / RANGE_ROWS)
    marks = blocks.select(
        "start", (c("bad") / c("n")).alias("rate"), F.explode(F.sequence(first, last)).alias("part")
    ).select("part", F.greatest("start", c("part") * RANGE_ROWS).alias("start"), "rate")
    both = rows.select("*", F.lit(None).cast("double").alias("rate"), F.lit(1).alias("kind")).unionByName(
        marks.withColumn("kind", F.lit(0)), allowMissingColumns=True
    )
    so_far = Window.partitionBy("part").orderBy("start", "kind")  # a range's rows
    value = F.last("rate", ignorenulls=True).over(so_far)
    return both.withColumn("calibrated", value).where(c("kind") == 1).select("score", "n", "bad", "calibrated")


def isotonic(df: DataFrame, score: str, target: str) -> DataFrame:
    """df with `calibrated`: the monotone step fit at the row's score; NULL for a missing score."""
    steps = isotonic_steps(df, score, target).select(c("score").alias("_score"), "calibrated")
    return df.join(steps, c(score) == c("_score"), "left").drop("_score")


def _logit(score: str) -> Column:
    p = F.least(F.greatest(c(score), F.lit(EPS)), F.lit(1 - EPS))
    return F.ln(p / (1 - p))


def _loss(score: str, target: str, temperature: float) -> Column:
    p = 1 / (1 + F.exp(-_logit(score) / temperature))
    y = c(target)
    return F.avg(-(y * F.ln(p + EPS) + (1 - y) * F.ln(1 - p + EPS)))


def fit_temperature(
    df: DataFrame, score: str, target: str, low: float = 0.1, high: float = 10.0,
    points: int = 25, rounds: int = 3,
) -> float:
    """Temperature with the smallest log loss: one aggregate per grid refinement."""
    for _ in range(rounds):
        grid = [low * (high / low) ** (i / (points - 1)) for i in range(points)]
        row = df.agg(*[_loss(score, target, t).alias(f"t{i}") for i, t in enumerate(grid)]).first()
        best = min(range(points), key=lambda i: row[i])
        low, high = grid[max(best - 1, 0)], grid[min(best + 1, points - 1)]
    return grid[best]


def temperature(df: DataFrame, score: str, target: str) -> DataFrame:
    t = fit_temperature(df, score, target)
    return df.withColumn("calibrated", 1 / (1 + F.exp(-_logit(score) / F.lit(t))))


METHODS = {"platt": platt, "isotonic": isotonic, "temperature": temperature}


def brier(df: DataFrame, score: str, target: str, by: list[str] | None = None) -> DataFrame:
    gap = c(score) - c(target)
    return df.groupBy(*(by or [])).agg(F.avg(gap * gap).alias("brier"))


def calibration_curve(df: DataFrame, score: str, target: str, n_bins: int = 10) -> DataFrame:
    """Equal-width, left-closed bins: bin, n, mean_predicted, fraction_positive."""
    edges = [i / n_bins for i in range(1, n_bins)]
    slot = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= c(score)))
    return df.groupBy(slot.alias("bin")).agg(
        F.count("*").alias("n"),
        F.avg(score).alias("mean_predicted"),
        F.avg(target).alias("fraction_positive"),
    )


def expected_calibration_error(
    df: DataFrame, score: str, target: str, n_bins: int = 10
) -> DataFrame:
    bins = calibration_curve(df, score, target, n_bins)
    gap = F.abs(c("fraction_positive") - c("mean_predicted"))
    return bins.agg((F.sum(c("n") * gap) / F.sum("n")).alias("ece"))


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of the chi-squared distribution for whole degrees of freedom."""
    half = x / 2
    if df % 2 == 0:
        term = total = math.exp(-half)
        for i in range(1, df // 2):
            term *= half / i
            total += term
        return total
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) * 2 / math.sqrt(math.pi)
    for i in range(1, (df - 1) // 2 + 1):
        total += term
        term *= half / (i + 0.5)
    return total


@F.pandas_udf(T.DoubleType())
def _tail(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(float(a), int(b)) for a, b in zip(x, df)])


def hosmer_lemeshow(df: DataFrame, score: str, target: str, n_bins: int = 10) -> DataFrame:
    """chi2, dof, p_value over quantile bins of the score."""
    edges = ranking.quantiles(df, [], score, [i / n_bins for i in range(n_bins + 1)])
    edges = F.broadcast(edges.select(F.array_distinct("q").alias("edges")))
    bins = (
        df.join(edges)
        .groupBy(bin_of(c(score), c("edges")).alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.sum(c(target).cast("double")).alias("o"),
            F.sum(score).alias("e"),
        )
        .where(c("bin").isNotNull())
    )
    good_e = c("n") - c("e")
    gap = (c("o") - c("e")) * (c("o") - c("e"))
    term = F.when(c("e") > 0, gap / c("e")).otherwise(0.0) + F.when(
        good_e > 0, gap / good_e
    ).otherwise(0.0)
    out = bins.agg(
        F.sum(term).alias("chi2"), F.greatest(F.count("*") - 2, F.lit(1)).cast("int").alias("dof")
    )
    return out.withColumn("p_value", _tail("chi2", "dof"))


def calibration_result(df: DataFrame, score: str, target: str, method: str) -> DataFrame:
    """Brier and ECE before and after, Hosmer-Lemeshow after."""
    fitted = METHODS[method](df, score, target)
    name = lambda d, a, b: d.withColumnRenamed(a, b)
    return (
        name(brier(fitted, score, target), "brier", "brier_before")
        .join(name(brier(fitted, "calibrated", target), "brier", "brier_after"))
        .join(name(expected_calibration_error(fitted, score, target), "ece", "ece_before"))
        .join(name(expected_calibration_error(fitted, "calibrated", target), "ece", "ece_after"))
        .join(hosmer_lemeshow(fitted, "calibrated", target))
        .select(F.lit(method).alias("method"), "*")
    )
