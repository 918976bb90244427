"""Ranking metrics per group: AUC, Gini, KS, lift, confusion, log loss, trends.

Everything starts from the cumulative frequency table of the score (`functions.ranking`), which is
exact, tie-aware and never sorts a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureauflow.functions import ranking
from bureauflow.functions.expressions import quarter_label, ratio, ratio0

c = F.col


def curve(df: DataFrame, score: str, target: str | None, by: list[str] | None = None) -> DataFrame:
    """Counts at, below and over all of every distinct score: n, bad (+ _before, _total).

    Without a target, df holds scores with their numbers `good` and `bad`.
    """
    if target is None:
        return ranking.cumulative(df, by or [], score, {"n": c("good") + c("bad"), "bad": c("bad")})
    sums = {"n": F.lit(1), "bad": c(target).cast("bigint")}
    return ranking.cumulative(df.where(c(target).isNotNull()), by or [], score, sums)


def auc_table(df: DataFrame, score: str, target: str | None, by: list[str] | None = None) -> DataFrame:
    """by, n, n_bads, bad_rate, auc, gini, ks, ks_threshold, ks_signed; NULL for a single class. target: as in `curve`."""
    by = by or []
    good, good_before = c("n") - c("bad"), c("n_before") - c("bad_before")
    goods = c("n_total") - c("bad_total")
    both = (c("bad_total") > 0) & (goods > 0)
    gap = F.when(both, c("bad_before") / c("bad_total") - good_before / goods)
    rows = curve(df, score, target, by).select(
        *by,
        c(score).cast("double").alias("v"),
        c("n_total"),
        c("bad_total"),
        F.when(both, c("bad") * (good_before + good / 2)).alias("area"),
        F.when(both, c("bad_total") * goods).alias("pairs"),
        gap.alias("gap"),
    )
    out = rows.groupBy(*by).agg(
        F.max("n_total").alias("n"),
        F.max("bad_total").alias("n_bads"),
        (F.sum("area") / F.max("pairs")).alias("auc"),
        F.max(F.abs("gap")).alias("ks"),
        F.max_by("v", F.struct(F.abs("gap"), c("v"))).alias("ks_threshold"),
        F.greatest(F.max(-c("gap")), F.lit(0.0)).alias("ks_signed"),
    )
    return out.select(
        *by,
        "n",
        "n_bads",
        (c("n_bads") / c("n")).alias("bad_rate"),
        "auc",
        (2 * c("auc") - 1).alias("gini"),
        "ks",
        F.when(c("ks").isNotNull(), c("ks_threshold")).alias("ks_threshold"),
        F.when(c("ks").isNotNull(), c("ks_signed")).alias("ks_signed"),
    )


def lift_table(
    df: DataFrame,
    score: str,
    target: str,
    by: list[str] | None = None,
    n_deciles: int = 10,
) -> DataFrame:
    """Score-quantile table, riskiest bin first: counts, bad rate, lift, cumulatives, capture.

    Decile 1 holds the highest scores; the number of deciles shrinks when quantile edges coincide.
    """
    from bureauflow.operators.binning import bin_of

    by = by or []
    edges = ranking.quantiles(df, by, score, [i / n_deciles for i in range(n_deciles + 1)])
    edges = edges.select(*by, F.array_distinct("q").alias("edges"))
    binned = _with_edges(df, edges, by).withColumn("bin", bin_of(c(score), c("edges")))
    bins = binned.where(c("bin").isNotNull()).groupBy(*by, "bin").agg(
        F.max(F.size("edges") - 1).alias("n_bins"),
        F.min(score).cast("double").alias("score_min"),
        F.max(score).cast("double").alias("score_max"),
        F.avg(score).alias("score_mean"),
        F.count("*").alias("n"),
        F.sum(c(target).cast("bigint")).alias("bads"),
    )
    bins = bins.withColumn("decile", (c("n_bins") - c("bin")).cast("int"))
    # at most n_deciles rows per group from here on
    w = Window.partitionBy(*(by or [F.lit(0)]))
    run = w.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    overall = F.sum("bads").over(w) / F.sum("n").over(w)
    cum_n, cum_bad = F.sum("n").over(run), F.sum("bads").over(run)
    return bins.select(
        *by,
        "decile",
        "score_min",
        "score_max",
        "score_mean",
        "n",
        "bads",
        (c("bads") / c("n")).alias("bad_rate"),
        ratio0(c("bads") / c("n"), overall).alias("lift"),
        cum_n.alias("cum_n"),
        cum_bad.alias("cum_bads"),
        (cum_bad / cum_n).alias("cum_bad_rate"),
        ratio0(cum_bad / cum_n, overall).alias("cum_lift"),
        ratio0(cum_bad, F.sum("bads").over(w)).alias("capture_rate"),
    )


def _with_edges(df: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """Attach the edge array of the row's group; whether the groups' rows are broadcast is left to their size."""
    if not by:
        return df.join(F.broadcast(edges))  # one row
    on = [F.col(f"d.{b}").eqNullSafe(F.col(f"e.{b}")) for b in by]
    return df.alias("d").join(edges.alias("e"), on).select("d.*", "edges")


def precision_lift_at_k(
    df: DataFrame, score: str, target: str, tie: str, k: float = 0.10, by: list[str] | None = None
) -> DataFrame:
    """by, top_n, precision, lift of the top share k of scores (ties broken by `tie`)."""
    by = by or []
    top = F.greatest(F.lit(1), F.floor(c("n_total") * F.lit(k)))
    flipped = df.withColumn("_desc", -c(score))
    marked = ranking.first_k(flipped, "_desc", tie, top, by)
    agg = marked.groupBy(*by).agg(
        F.count_if("selected").alias("top_n"),
        F.avg(F.when(c("selected"), c(target))).alias("precision"),
        F.avg(target).alias("overall"),
    )
    return agg.select(
        *by, "top_n", "precision", ratio(c("precision"), c("overall")).alias("lift")
    )


def confusion_table(
    df: DataFrame,
    score: str,
    target: str,
    thresholds: list[float] = (0.1, 0.2, 0.3, 0.4, 0.5),
    by: list[str] | None = None,
) -> DataFrame:
    """Confusion counts and rates for score >= threshold.

    Each row is counted once, in the slot between its neighbouring thresholds; the slots (at most
    one more than there are thresholds) are then summed from the top.
    """
    by = by or []
    cuts = sorted(float(t) for t in thresholds)
    slot = F.size(F.filter(F.array(*[F.lit(t) for t in cuts]), lambda t: t <= c(score)))
    counted = df.groupBy(*by, slot.alias("slot")).agg(
        F.count("*").alias("n"), F.sum(c(target).cast("bigint")).alias("bad")
    )
    aggs = []
    for i in range(len(cuts)):
        hit = c("slot") > i
        aggs += [
            F.coalesce(F.sum(F.when(hit, c("bad"))), F.lit(0)).alias(f"tp{i}"),
            F.coalesce(F.sum(F.when(hit, c("n") - c("bad"))), F.lit(0)).alias(f"fp{i}"),
        ]
    wide = counted.groupBy(*by).agg(
        F.sum("bad").alias("P"), (F.sum("n") - F.sum("bad")).alias("N"), *aggs
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("threshold"), c(f"tp{i}").alias("tp"), c(f"fp{i}").alias("fp")
            )
            for i, t in enumerate(cuts)
        ]
    )
    flat = wide.select(*by, "P", "N", F.inline(rows)).select(
        *by,
        "threshold",
        "tp",
        "fp",
        (c("N") - c("fp")).alias("tn"),
        (c("P") - c("tp")).alias("fn"),
    )
    precision = ratio0(c("tp"), c("tp") + c("fp"))
    recall = ratio0(c("tp"), c("tp") + c("fn"))
    return flat.select(
        "*",
        precision.alias("precision"),
        recall.alias("recall"),
        ratio0(2 * precision * recall, precision + recall).alias("f1"),
        ratio0(c("fp"), c("fp") + c("tn")).alias("type_i_error"),
        ratio0(c("fn"), c("fn") + c("tp")).alias("type_ii_error"),
        ratio0(c("tp") + c("tn"), c("tp") + c("fp") + c("tn") + c("fn")).alias("accuracy"),
    )


def log_loss(
    df: DataFrame, score: str, target: str, by: list[str] | None = None, eps: float = 1e-15
) -> DataFrame:
    p = F.least(F.greatest(c(score), F.lit(eps)), F.lit(1 - eps))
    y = c(target)
    loss = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return df.groupBy(*(by or [])).agg(F.avg(loss).alias("log_loss"))


def all_metrics(
    df: DataFrame, score: str, target: str, by: list[str], threshold: float = 0.5
) -> DataFrame:
    """Discrimination, confusion at one threshold and log loss per group."""
    out = auc_table(df, score, target, by)
    confusion = confusion_table(df, score, target, [threshold], by).drop("threshold")
    return out.join(confusion, by).join(log_loss(df, score, target, by), by)


def performance_by_period(
    df: DataFrame,
    score: str,
    target: str,
    tie: str,
    period: str = "period",
    k: float = 0.10,
    min_rows: int = 1,
) -> DataFrame:
    """Metrics and top-k precision per period; periods with one class or too few rows are left out."""
    base = auc_table(df, score, target, [period]).where(
        c("auc").isNotNull() & (c("n") >= min_rows)
    )
    top = precision_lift_at_k(df, score, target, tie, k, [period])
    return base.drop("ks_threshold", "ks_signed").join(top.drop("top_n"), period)


def combine_oot(df: DataFrame, split: str = "split") -> DataFrame:
    """Period label with all out-of-time quarters together."""
    return df.withColumn(
        "period", F.when(c(split).startswith("oot"), "oot").otherwise(c(split))
    )


def variable_quarterly_auc(
    long: DataFrame, target: str = "target", quarter: str = "quarter", min_rows: int = 30
) -> DataFrame:
    """feature, quarter, auc (folded to at least 0.5) where enough rows and both classes exist.

    The row minimum counts all rows of the quarter with a value.
    """
    auc = auc_table(long, "value", target, ["feature", quarter])
    return auc.where(c("auc").isNotNull() & (c("n") >= min_rows)).select(
        "feature", quarter, F.greatest(c("auc"), 1 - c("auc")).alias("auc"), "n"
    )


def quarterly_auc_summary(quarterly: DataFrame, quarter: str = "quarter") -> DataFrame:
    """feature, avg_auc, min_auc, trend_slope over the ordinal number of its quarters."""
    # a feature has one row per quarter
    w = Window.partitionBy("feature").orderBy(quarter)
    ranked = quarterly.withColumn("x", (F.row_number().over(w) - 1).cast("double"))
    return ranked.groupBy("feature").agg(
        F.avg("auc").alias("avg_auc"),
        F.min("auc").alias("min_auc"),
        F.when(F.count("*") >= 2, F.regr_slope("auc", "x")).alias("trend_slope"),
    )


def pivot_quarters(quarterly: DataFrame, quarters: list[str], quarter: str = "quarter"):
    """One AUC column per quarter."""
    return quarterly.groupBy("feature").pivot(quarter, quarters).agg(F.first("auc"))


def quarterly_trend(performance: DataFrame) -> DataFrame:
    """Out-of-time rows with the change from the previous quarter and from train."""
    oot = c("period").startswith("oot_")
    # one row per period: bounded by the number of quarters
    w = Window.partitionBy(F.lit(0))
    step = c("auc") - F.lag("auc").over(w.orderBy("period"))
    train = performance.where(c("period") == "train").select(c("auc").alias("train_auc"))
    return (
        performance.where(oot)
        .withColumn("delta_auc", step)
        .join(train, how="left")
        .select(
            "period",
            "auc",
            "gini",
            "ks",
            "delta_auc",
            (c("train_auc") - c("auc")).alias("auc_vs_train"),
            F.when(c("delta_auc") > 0.01, "Improving")
            .when(c("delta_auc") < -0.01, "Degrading")
            .otherwise("Stable")
            .alias("trend"),
        )
    )


def segment_performance(
    df: DataFrame, score: str, target: str, segment: str, split: str, min_rows: int = 10
) -> DataFrame:
    """Metrics per segment value and period; a single class gives NULL metrics."""
    out = auc_table(df, score, target, [segment, split])
    return out.where(c("n") >= min_rows).drop("ks_threshold", "ks_signed")


def segment_confusion(
    df: DataFrame,
    score: str,
    target: str,
    segment: str,
    split: str,
    thresholds: list[float] = (0.1, 0.2, 0.3, 0.4, 0.5),
    min_rows: int = 10,
) -> DataFrame:
    """Confusion table per segment value and period with enough rows and both classes."""
    out = confusion_table(df, score, target, thresholds, [segment, split])
    bad, good = c("tp") + c("fn"), c("fp") + c("tn")
    return out.where((bad + good >= min_rows) & (bad > 0) & (good > 0))


def compare_models(
    df: DataFrame, scores: list[str], target: str, primary: str = "gini"
) -> DataFrame:
    """Metrics of several score columns, ranked by the primary metric."""
    long = df.select(
        c(target), F.inline(F.array(*[
            F.struct(F.lit(s).alias("model"), c(s).cast("double").alias("value")) for s in scores
        ]))
    )
    out = all_metrics(long, "value", target, ["model"])
    # one row per model
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc(primary), "model")
    return out.withColumn("rank", F.row_number().over(w))


def histogram(df: DataFrame, value: str, by: list[str] | None = None, n_bins: int = 50) -> DataFrame:
    """Equal-width histogram, last bin closed: by, bin, bin_lower, bin_upper, n, density."""
    by = by or []
    span = df.groupBy(*by).agg(
        F.min(value).cast("double").alias("lo"),
        F.max(value).cast("double").alias("hi"),
        F.count(value).alias("total"),
    )
    if by:
        on = [F.col(f"d.{b}").eqNullSafe(F.col(f"s.{b}")) for b in by]
        joined = df.alias("d").join(F.broadcast(span).alias("s"), on).select(
            "d.*", "lo", "hi", "total"
        )
    else:
        joined = df.join(F.broadcast(span))
    width = (c("hi") - c("lo")) / n_bins
    slot = F.when(c("hi") == c("lo"), 0).otherwise(
        F.least(F.floor((c(value) - c("lo")) / width), F.lit(n_bins - 1))
    )
    counts = joined.where(c(value).isNotNull()).groupBy(
        *by, "lo", "hi", "total", slot.cast("int").alias("bin")
    ).agg(F.count("*").alias("n"))
    grid = span.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    on = [F.col(f"g.{b}").eqNullSafe(F.col(f"n.{b}")) for b in [*by, "bin"]]
    full = grid.alias("g").join(
        counts.select(*by, "bin", "n").alias("n"), on, "left"
    ).select("g.*", F.coalesce("n.n", F.lit(0)).alias("n"))
    return full.select(
        *by,
        "bin",
        (c("lo") + width * c("bin")).alias("bin_lower"),
        (c("lo") + width * (c("bin") + 1)).alias("bin_upper"),
        "n",
        ratio0(c("n"), c("total")).alias("density"),
    )


def distribution_summary(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """n, mean, std, min, max, p10, p25, p50, p75, p90."""
    by = by or []
    probs = [0.10, 0.25, 0.50, 0.75, 0.90]
    q = ranking.quantiles(df, by, value, probs).drop("n")
    m = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    joined = m.join(q, by) if by else m.join(q)
    names = ["p10", "p25", "p50", "p75", "p90"]
    return joined.select(
        *m.columns, *[c("q")[i].alias(n) for i, n in enumerate(names)]
    )


def score_bands(df: DataFrame, score: str, target: str, n_bands: int = 10) -> DataFrame:
    """Quantile bands from the lowest score up, with cumulative bads and capture rate."""
    from bureauflow.operators.binning import bin_of

    edges = ranking.quantiles(df, [], score, [i / n_bands for i in range(n_bands + 1)])
    edges = edges.select(F.array_distinct("q").alias("edges"))
    bands = (
        _with_edges(df, edges, [])
        .groupBy(bin_of(c(score), c("edges")).alias("band"))
        .agg(
            F.min(score).cast("double").alias("score_min"),
            F.max(score).cast("double").alias("score_max"),
            F.count("*").alias("n"),
            F.sum(c(target).cast("bigint")).alias("bads"),
        )
        .where(c("band").isNotNull())
    )
    w = Window.partitionBy(F.lit(0))  # at most n_bands rows
    run = w.orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    n, bad = F.sum("n").over(run), F.sum("bads").over(run)
    return bands.select(
        "*",
        (c("bads") / c("n")).alias("bad_rate"),
        n.alias("cum_n"),
        bad.alias("cum_bads"),
        (bad / n).alias("cum_bad_rate"),
        ratio0(bad, F.sum("bads").over(w)).alias("capture_rate"),
    )


def with_quarter(df: DataFrame, date: str = "date", name: str = "quarter") -> DataFrame:
    return df.withColumn(name, quarter_label(F.col(date)))
