"""Approval cut-offs on scores where a higher score means lower risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bureauflow.functions import ranking
from bureauflow.functions.expressions import ratio0
from bureauflow.operators.metrics import curve

c = F.col


def ks_cutoff(df: DataFrame, score: str, target: str) -> DataFrame:
    """cutoff, ks: the threshold with the largest tpr - fpr (equals Youden's J)."""
    good_before, goods = c("n_before") - c("bad_before"), c("n_total") - c("bad_total")
    # share of bads at or above the score minus share of goods at or above it
    j = good_before / goods - c("bad_before") / c("bad_total")
    return curve(df, score, target).select(c(score).cast("double").alias("v"), j.alias("j")).agg(
        F.max_by("v", F.struct("j", "v")).alias("cutoff"), F.max("j").alias("ks")
    )


def _fetch(df: DataFrame, score: str, probs: list[float]) -> list[float]:
    """Quantiles of the score on the driver: one number per requested probability."""
    return list(ranking.quantiles(df, [], score, probs).first()["q"])


def at_cutoffs(df: DataFrame, score: str, target: str, cutoffs: list[float]) -> DataFrame:
    """cutoff with approval counts, bad rates and confusion counts (approve when score >= cutoff).

    Rows are counted once into the slots between cutoffs, then summed over slots.
    """
    cuts = sorted(set(float(x) for x in cutoffs))
    slot = F.size(F.filter(F.array(*[F.lit(t) for t in cuts]), lambda t: t <= c(score)))
    slots = df.groupBy(slot.alias("slot")).agg(
        F.count("*").alias("n"), F.sum(c(target).cast("bigint")).alias("bad")
    )
    aggs = []
    for i in range(len(cuts)):
        ok = c("slot") > i
        aggs += [
            F.coalesce(F.sum(F.when(ok, c("n"))), F.lit(0)).alias(f"n{i}"),
            F.coalesce(F.sum(F.when(ok, c("bad"))), F.lit(0)).alias(f"b{i}"),
        ]
    wide = slots.agg(F.sum("n").alias("total"), F.sum("bad").alias("bads"), *aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("cutoff"),
                c(f"n{i}").alias("approved"),
                c(f"b{i}").alias("approved_bads"),
            )
            for i, t in enumerate(cuts)
        ]
    )
    return _analysis(wide.select("total", "bads", F.inline(rows)), ["cutoff"])


def _analysis(flat: DataFrame, keys: list[str]) -> DataFrame:
    """Rates of a cut-off from total, bads, approved and approved_bads."""
    rejected = c("total") - c("approved")
    tp = c("bads") - c("approved_bads")
    fp = rejected - tp
    both = (c("approved") > 0) & (rejected > 0)
    precision = F.when(both, ratio0(tp, tp + fp)).otherwise(0.0)
    recall = F.when(both, ratio0(tp, c("bads"))).otherwise(0.0)
    return flat.select(
        *keys,
        (c("approved") / c("total")).alias("approval_rate"),
        (rejected / c("total")).alias("rejection_rate"),
        ratio0(c("approved_bads"), c("approved")).alias("bad_rate_approved"),
        ratio0(tp, rejected).alias("bad_rate_rejected"),
        precision.alias("precision"),
        recall.alias("recall"),
        ratio0(2 * precision * recall, precision + recall).alias("f1"),
        tp.alias("tp"),
        fp.alias("fp"),
        (c("approved") - c("approved_bads")).alias("tn"),
        c("approved_bads").alias("fn"),
    )


def cost_cutoff(
    df: DataFrame, score: str, target: str, cost_fn: float, cost_fp: float
) -> DataFrame:
    """cutoff, cost: the cheapest of the 99 score percentiles, the lowest one on a tie."""
    table = at_cutoffs(df, score, target, _fetch(df, score, [i / 100 for i in range(1, 100)]))
    cost = cost_fn * c("fn") + cost_fp * c("fp")
    return table.select("cutoff", cost.alias("cost")).agg(
        F.min_by("cutoff", F.struct("cost", "cutoff")).alias("cutoff"), F.min("cost").alias("cost")
    )


def approval_cutoff(df: DataFrame, score: str, rate: float) -> DataFrame:
    """cutoff that approves about the given share."""
    if not 0 < rate < 1:
        raise ValueError("rate must be between 0 and 1")
    return ranking.quantiles(df, [], score, [1 - rate]).select(c("q")[0].alias("cutoff"))


def bad_rate_cutoff(df: DataFrame, score: str, target: str, limit: float) -> DataFrame:
    """cutoff: the last score, best first, before the cumulative bad rate exceeds the limit.

    Evaluated at distinct scores; the lowest score when the limit is never exceeded, the best one
    when it is exceeded at once.
    """
    best_first = df.withColumn("_s", -c(score).cast("double"))
    rows = curve(best_first, "_s", target).select(
        (-c("_s")).alias("v"),
        ((c("bad_before") + c("bad")) / (c("n_before") + c("n"))).alias("rate"),
    )
    crossing = rows.agg(
        F.max(F.when(c("rate") > limit, c("v"))).alias("hit"),
        F.max("v").alias("top"),
        F.min("v").alias("low"),
    )
    # smallest score above the crossing one
    above = rows.join(F.broadcast(crossing)).agg(
        F.min(F.when(c("v") > c("hit"), c("v"))).alias("above"),
        F.max("hit").alias("hit"),
        F.max("top").alias("top"),
        F.min("low").alias("low"),
    )
    return above.select(
        F.when(c("hit").isNull(), c("low")).otherwise(F.coalesce("above", "top")).alias("cutoff")
    )


def cutoff_table(df: DataFrame, score: str, target: str, n_points: int = 20) -> DataFrame:
    """Analysis at n_points percentiles from the 5th to the 95th."""
    step = 90 / (n_points - 1)
    return at_cutoffs(
        df, score, target, _fetch(df, score, [(5 + i * step) / 100 for i in range(n_points)])
    )


def several_cutoffs(
    df: DataFrame, score: str, target: str, approvals: list[float] = (0.5, 0.7), bad_rates: list[float] = (0.05,)
) -> DataFrame:
    """Cut-offs by method with their analysis: ks, approval_50, approval_70, bad_rate_5.

    The cut-offs are part of the plan; rows are counted by score and then for every cut-off.
    """
    named = lambda name, found: found.select(F.lit(name).alias("method"), c("cutoff").cast("double").alias("cutoff"))
    found = named("ks", ks_cutoff(df, score, target))
    for rate in approvals:
        found = found.unionByName(named(f"approval_{round(100 * rate)}", approval_cutoff(df, score, rate)))
    for limit in bad_rates:
        found = found.unionByName(named(f"bad_rate_{round(100 * limit)}", bad_rate_cutoff(df, score, target, limit)))
    listed = found.agg(F.collect_list(F.struct("method", "cutoff"))).scalar()
    scores = df.groupBy(c(score).cast("double").alias("s")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(c(target).cast("bigint")), F.lit(0)).alias("bad")
    )
    rows = scores.withColumn("cutoffs", listed).select("s", "n", "bad", F.inline("cutoffs"))
    passed = lambda x: F.coalesce(F.sum(F.when(c("s") >= c("cutoff"), c(x))), F.lit(0))
    flat = rows.groupBy("method", "cutoff").agg(
        F.sum("n").alias("total"), F.sum("bad").alias("bads"), passed("n").alias("approved"), passed("bad").alias("approved_bads")
    )
    return _analysis(flat, ["method", "cutoff"])
