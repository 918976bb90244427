"""Quantile binning, weight of evidence, information value and column statistics on the long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureauflow.functions import ranking
from bureauflow.functions.expressions import iv_category

c = F.col
EPSILON = 1e-6


def long_form(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """keep columns, feature, value (double): one row per input row and feature.

    Linear in rows x features; pass at most a few hundred features at a time.
    """
    keep = keep or []
    pairs = [
        F.struct(F.lit(f).alias("feature"), c(f).cast("double").alias("value")) for f in features
    ]
    return df.select(*keep, F.inline(F.array(*pairs)))


def bin_of(value: Column, edges: Column, closed: str = "right") -> Column:
    """0-based bin of a value among distinct ascending edges; the outer edges are open-ended.

    NULL for missing values and for degenerate edges (a constant column has no bin).
    """
    inner = F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 2, F.lit(0)))
    below = (lambda e: e < value) if closed == "right" else (lambda e: e <= value)
    return F.when(value.isNotNull() & (F.size(edges) >= 2), F.size(F.filter(inner, below)))


def qcut_edges(
    long: DataFrame,
    by: list[str] | None = None,
    n_bins: int = 10,
    min_samples: int | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Exact distinct quantile edges per feature: by, edges, n.

    With `min_samples` the number of bins shrinks so that a bin holds about that many rows. weight:
    as in `ranking.quantiles`.
    """
    by = by or ["feature"]
    if min_samples:
        bins = F.least(
            F.lit(n_bins), F.greatest(F.lit(2), F.floor(c("n") / min_samples))
        ).cast("double")
        probs = [F.least(F.lit(float(i)) / bins, F.lit(1.0)) for i in range(n_bins + 1)]
    else:
        probs = [i / n_bins for i in range(n_bins + 1)]
    q = ranking.quantiles(long, by, "value", probs, weight=weight)
    return q.select(*by, F.array_distinct("q").alias("edges"), "n")


def value_counts(long: DataFrame, target: str = "target", by: list[str] | None = None) -> DataFrame:
    """feature, by, value, n, good, bad: the rows of every distinct value; all a feature's bins, edges and IV need."""
    t = c(target)
    return long.groupBy("feature", *(by or []), "value").agg(
        F.count("*").alias("n"), F.count_if(t == 0).alias("good"), F.count_if(t == 1).alias("bad")
    )


def with_bins(
    long: DataFrame,
    edges: DataFrame,
    by: list[str] | None = None,
    closed: str = "right",
    keep: Column | None = None,
) -> DataFrame:
    """long plus `bin`; edges are one row per feature (and base). keep: an expression over edges."""
    by = by or ["feature"]
    on = [F.col(f"l.{b}").eqNullSafe(F.col(f"e.{b}")) for b in by]
    joined = long.alias("l").join(F.broadcast(edges.select(*by, "edges")).alias("e"), on)
    joined = joined.select("l.*", "edges", *([] if keep is None else [keep]))
    return joined.withColumn("bin", bin_of(c("value"), c("edges"), closed)).drop("edges")


def qcut(long: DataFrame, n_bins: int = 10) -> DataFrame:
    """Quantile bins (right-closed, lowest value included) of every feature in the long form."""
    return with_bins(long, qcut_edges(long, n_bins=n_bins))


def woe_columns(
    good: Column, bad: Column, goods: Column, bads: Column, smoothing: float | None = None
) -> tuple[Column, Column]:
    """(weight of evidence, information value) of a bin; shares are floored or smoothed."""
    if smoothing is None:
        pg = F.greatest(good / goods, F.lit(EPSILON))
        pb = F.greatest(bad / bads, F.lit(EPSILON))
    else:
        pg = (good + smoothing) / (goods + smoothing)
        pb = (bad + smoothing) / (bads + smoothing)
    woe = F.ln(pg / pb)
    return woe, (pg - pb) * woe


def woe_table(
    binned: DataFrame,
    target: str = "target",
    smoothing: float | None = None,
    by: str = "bin",
) -> DataFrame:
    """feature, bin, n, good, bad, woe, iv over rows that have a bin."""
    t = c(target)
    counts = (
        binned.where(c(by).isNotNull() & t.isNotNull())
        .groupBy("feature", by)
        .agg(
            F.count("*").alias("n"),
            F.count_if(t == 0).alias("good"),
            F.count_if(t == 1).alias("bad"),
        )
    )
    return _woe_of(counts, by, smoothing)


def _woe_of(counts: DataFrame, by: str = "bin", smoothing: float | None = None) -> DataFrame:
    """woe_table of the counts (n, good, bad) of bins."""
    w = Window.partitionBy("feature")  # a handful of bins per feature
    counts = counts.withColumns({"goods": F.sum("good").over(w), "bads": F.sum("bad").over(w)})
    woe, iv = woe_columns(c("good"), c("bad"), c("goods"), c("bads"), smoothing)
    both = (c("goods") > 0) & (c("bads") > 0)
    return counts.select(
        "feature",
        by,
        "n",
        "good",
        "bad",
        F.when(both, woe).alias("woe"),
        F.when(both, iv).alias("iv"),
    )


def information_value(
    long: DataFrame,
    target: str = "target",
    n_bins: int = 10,
    min_rows: int = 50,
    min_samples: int | None = None,
    values: DataFrame | None = None,
) -> DataFrame:
    """feature, iv, iv_category, n (rows with a value).

    Plain variant: NULL below `min_rows` values; a constant feature has IV 0. With `min_samples`
    the number of bins adapts, and fewer than 2 x min_samples values or 2 bins give NULL. values: the
    `value_counts` of the rows of long with a value and a target, if known.
    """
    if values is None:
        values = value_counts(long.where(c("value").isNotNull() & c(target).isNotNull()), target)
    edges = qcut_edges(values, n_bins=n_bins, min_samples=min_samples, weight=c("n"))
    sums = [F.sum(x).alias(x) for x in ("n", "good", "bad")]
    binned = with_bins(values, edges).groupBy("feature", "bin").agg(*sums)
    bins = _woe_of(binned.where(c("bin").isNotNull()))
    per_feature = bins.groupBy("feature").agg(F.sum("iv").alias("iv"), F.count("*").alias("k"))
    # a constant feature has no bin but a size
    sizes = binned.groupBy("feature").agg(*sums)
    both = (c("good") > 0) & (c("bad") > 0)
    joined = sizes.join(per_feature, "feature", "left")
    if min_samples:
        iv = F.when((c("n") >= 2 * min_samples) & (c("k") >= 2), c("iv"))
    else:
        iv = F.when((c("n") >= min_rows) & both, F.coalesce(c("iv"), F.lit(0.0)))
    return joined.select("feature", iv.alias("iv"), "n").select(
        "feature", "iv", iv_category(c("iv")).alias("iv_category"), "n"
    )


def information_value_by_value(
    df: DataFrame, columns: list[str], target: str = "target"
) -> DataFrame:
    """Smoothed IV of categorical columns: one bin per value. feature, iv, iv_category."""
    pairs = [
        F.struct(F.lit(x).alias("feature"), c(x).cast("string").alias("bin")) for x in columns
    ]
    long = df.select(target, F.inline(F.array(*pairs)))
    bins = woe_table(long, target, smoothing=0.5)
    iv = bins.groupBy("feature").agg(F.sum("iv").alias("iv"))
    return iv.select("feature", "iv", iv_category(c("iv")).alias("iv_category"))


def smoothed_information_value(
    long: DataFrame, target: str = "target", n_bins: int = 10
) -> DataFrame:
    """Smoothed IV of numeric features: feature, iv, iv_category.

    Quantile bins where a feature has more than n_bins distinct values, else one bin per value.
    NULL for a feature of one class.
    """
    clean = long.where(c("value").isNotNull() & c(target).isNotNull())
    values = clean.groupBy("feature", "value").agg(F.count("*").alias("k"))
    distinct = values.groupBy("feature").agg(F.count("*").alias("values"))
    binned = with_bins(clean, qcut_edges(clean, n_bins=n_bins)).join(distinct, "feature")
    group = F.when(c("values") > n_bins, c("bin").cast("double")).otherwise(c("value"))
    bins = woe_table(binned.withColumn("group", group), target, smoothing=0.5, by="group")
    iv = bins.groupBy("feature").agg(F.sum("iv").alias("iv"))
    return iv.select("feature", "iv", iv_category(c("iv")).alias("iv_category"))


def approximate_bins(df: DataFrame, column: str, n_bins: int = 10, k: int = 200) -> DataFrame:
    """df with `{column}_bin`: left-closed quantile buckets from a mergeable sketch; missing values have the last."""
    rows = df.select(F.lit(column).alias("feature"), c(column).cast("double").alias("value"))
    cuts = sketch_cuts(rows, [i / n_bins for i in range(1, n_bins)], k).select(F.array_distinct("cuts")).scalar()
    slot = F.size(F.filter("_cuts", lambda x: x <= c(column)))
    missing = c(column).isNull() | F.isnan(c(column).cast("double"))
    bucket = F.when(missing, F.size("_cuts") + 1).otherwise(slot).cast("double")
    return df.withColumn("_cuts", cuts).withColumn(f"{column}_bin", bucket).drop("_cuts")


def _fifths(clean: DataFrame, cuts: DataFrame, target: str) -> DataFrame:
    """Smoothed IV of the bins between cuts: feature, iv, iv_category."""
    binned = clean.join(F.broadcast(cuts), "feature").withColumn(
        "bin", F.size(F.filter("cuts", lambda e: e < c("value")))
    )
    iv = woe_table(binned, target, smoothing=0.5).groupBy("feature").agg(F.sum("iv").alias("iv"))
    return iv.select("feature", "iv", iv_category(c("iv")).alias("iv_category"))


FIFTHS = [0.2, 0.4, 0.6, 0.8]


def fifths_iv(long: DataFrame, target: str = "target") -> DataFrame:
    """IV over five exact quantile bins with +0.5 smoothing: feature, iv, iv_category."""
    clean = long.where(c("value").isNotNull())
    cuts = ranking.quantiles(clean, ["feature"], "value", FIFTHS).select("feature", c("q").alias("cuts"))
    return _fifths(clean, cuts, target)


def sketch_cuts(long: DataFrame, probs: list[float], k: int = 200, by: str = "feature") -> DataFrame:
    """by, n, cuts, error: quantiles from a mergeable KLL sketch of each group.

    A cut's rank differs from the asked one by `error` times n at most, with 99% confidence for each
    cut, whatever n is and however the sketches of tasks are merged; 1.33% for k = 200. Sketches are
    built on the map side, and a task sends one of a few kilobytes for each group.
    """
    sketch = long.where(c("value").isNotNull()).groupBy(by).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(c("value").cast("double"), F.lit(k)).alias("sketch")
    )
    cuts = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs]))
    return sketch.select(by, "n", cuts.alias("cuts"), F.lit(kll_error(k)).alias("error"))


def kll_error(k: int) -> float:
    """Bound of the normalised rank error of one quantile of a KLL sketch; the numbers are fixed values."""
    return 2.296 / k**0.9723


def approximate_iv(long: DataFrame, target: str = "target", k: int = 200) -> DataFrame:
    """IV over five sketch-quantile bins with +0.5 smoothing: feature, iv, iv_category."""
    clean = long.where(c("value").isNotNull())
    return _fifths(clean, sketch_cuts(clean, FIFTHS, k).select("feature", "cuts"), target)


def rank_errors(long: DataFrame, probs: list[float], k: int = 200) -> DataFrame:
    """feature, prob, cut, n, true_rank, rank_error, bound: what the sketch's cuts are off by.

    The true rank of a cut is the share of values up to it that is nearest to the asked one: values
    equal to the cut may stand on either side.
    """
    cuts = sketch_cuts(long, probs, k)
    wanted = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), c("cuts").alias("cut"))
    rows = long.where(c("value").isNotNull()).join(F.broadcast(cuts), "feature")
    at = lambda op: F.transform("cuts", lambda x: F.when(op(c("value"), x), 1).otherwise(0))
    counted = rows.select("feature", "n", "error", F.posexplode(F.arrays_zip(wanted.alias("w"), at(lambda v, x: v < x).alias("below"), at(lambda v, x: v <= x).alias("upto"))).alias("i", "z"))
    sums = counted.groupBy("feature", "n", "error", c("z.w.prob").alias("prob"), c("z.w.cut").alias("cut")).agg(
        F.sum("z.below").alias("below"), F.sum("z.upto").alias("upto")
    )
    low, high = c("below") / c("n"), c("upto") / c("n")
    true = F.greatest(low, F.least(high, c("prob")))
    return sums.select("feature", "prob", "cut", "n", true.alias("true_rank"), F.abs(true - c("prob")).alias("rank_error"), c("error").alias("bound"))


# --- weight-of-evidence bins ---------------------------------------------------------------------

BINS_SCHEMA = (
    "feature string, bin_id int, lower double, upper double, n bigint, good bigint, bad bigint, "
    "woe double, iv double"
)
BIN_COLUMNS = [x.split()[0] for x in BINS_SCHEMA.split(", ")]


def fit_bins(
    df: DataFrame, features: list[str], target: str = "target", n_bins: int = 10,
    missing_bin: bool = True,
) -> DataFrame:
    """Initial bins with observed bounds; missing values form bin -1. Columns as BIN_COLUMNS."""
    long = long_form(df, features, [target])
    binned = with_bins(long, qcut_edges(long, n_bins=n_bins))
    if missing_bin:
        binned = binned.withColumn(
            "bin", F.when(c("value").isNull(), F.lit(-1)).otherwise(c("bin"))
        )
    t = c(target)
    counts = (
        binned.where(c("bin").isNotNull())
        .groupBy("feature", c("bin").cast("int").alias("bin_id"))
        .agg(
            F.min("value").alias("lower"),
            F.max("value").alias("upper"),
            F.count("*").alias("n"),
            F.count_if(t == 0).alias("good"),
            F.count_if(t == 1).alias("bad"),
        )
    )
    totals = df.agg(F.count_if(t == 0).alias("goods"), F.count_if(t == 1).alias("bads"))
    joined = counts.join(F.broadcast(totals))
    woe, iv = woe_columns(c("good"), c("bad"), c("goods"), c("bads"))
    return joined.select(
        "feature", "bin_id", "lower", "upper", "n", "good", "bad", woe.alias("woe"), iv.alias("iv")
    )


def class_totals(df: DataFrame, target: str = "target") -> tuple[int, int]:
    """(number of goods, number of bads)."""
    row = df.agg(
        F.count_if(c(target) == 0).alias("g"), F.count_if(c(target) == 1).alias("b")
    ).first()
    return row["g"], row["b"]


def _with_woe(counts: DataFrame, totals: tuple[int, int]) -> DataFrame:
    """Bin counts with weight of evidence and information value, columns as BIN_COLUMNS."""
    woe, iv = woe_columns(c("good"), c("bad"), *(F.lit(x) for x in totals))
    return counts.withColumns({"woe": woe, "iv": iv}).select(*BIN_COLUMNS)


def merge_small_bins(
    bins: DataFrame, totals: tuple[int, int], min_bin_size: float = 0.05
) -> DataFrame:
    """Put bins below the minimum share to the bin before them; two bins or fewer stay.

    A bin heads a new one if it is large enough, the first regular one or the missing bin, so the
    number of heads so far tells which bins belong together.
    """
    feature = Window.partitionBy("feature")  # a handful of bins
    regular = c("bin_id") >= 0
    least = F.floor(F.sum(F.when(regular, c("n"))).over(feature) * min_bin_size)
    first = F.min(F.when(regular, c("bin_id"))).over(feature)
    few = F.count("*").over(feature) <= 2
    heads = ~regular | (c("bin_id") == first) | (c("n") >= least) | few
    marked = bins.withColumn("heads", heads.cast("int"))
    marked = marked.withColumn("head", F.sum("heads").over(feature.orderBy("bin_id")))
    counts = marked.groupBy("feature", "head").agg(
        F.min("bin_id").alias("bin_id"),
        F.min("lower").alias("lower"),
        F.max("upper").alias("upper"),
        *[F.sum(k).alias(k) for k in ("n", "good", "bad")],
    )
    return _with_woe(counts, totals)


RUN = "array<struct<bin_id:int,lower:double,upper:double,n:bigint,good:bigint,bad:bigint,woe:double>>"


def make_monotonic(bins: DataFrame, totals: tuple[int, int], rounds: int = 100) -> DataFrame:
    """Join neighbours until the weight of evidence goes one way, from first to last bin.

    A fold over a feature's array of bins: each step joins the first pair that goes against the
    direction of the ends as they are then, and leaves an array of two bins, or without such a
    pair, as it is. Each join takes a bin away, so there are no more steps than bins.
    """

    def joined(a: Column, b: Column) -> Column:
        good, bad = a["good"] + b["good"], a["bad"] + b["bad"]
        woe, _ = woe_columns(good, bad, *(F.lit(x) for x in totals))
        return F.struct(
            a["bin_id"], F.least(a["lower"], b["lower"]), F.greatest(a["upper"], b["upper"]),
            a["n"] + b["n"], good, bad, woe,
        )

    def step(run: Column, _: Column) -> Column:
        ends = F.get(run, F.size(run) - 1)["woe"] - F.get(run, F.lit(0))["woe"]
        way = F.when(ends >= 0, 1).otherwise(-1)
        against = F.transform(
            F.sequence(F.lit(0), F.size(run) - 2),
            lambda i: way * (F.get(run, i + 1)["woe"] - F.get(run, i)["woe"]) < 0,
        )
        at = F.array_position(against, True).cast("int")  # from 1; 0 if there is none
        both = F.array(joined(F.get(run, at - 1), F.get(run, at)))
        shorter = F.concat(F.slice(run, 1, at - 1), both.cast(RUN), F.slice(run, at + 2, F.size(run)))
        return F.when((F.size(run) > 2) & (at > 0), shorter).otherwise(run).cast(RUN)

    fields = ["bin_id", "lower", "upper", "n", "good", "bad", "woe"]
    regular = bins.where(c("bin_id") >= 0).groupBy("feature").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).cast(RUN).alias("run")
    )
    steps = F.sequence(F.lit(1), F.least(F.size("run"), F.lit(rounds)))
    merged = regular.select("feature", F.inline(F.aggregate(steps, c("run"), step)))
    missing = bins.where(c("bin_id") < 0).select("feature", *fields)
    return _with_woe(merged.unionByName(missing), totals)


def fit_woe(
    df: DataFrame,
    features: list[str],
    target: str = "target",
    n_bins: int = 10,
    min_bin_size: float = 0.05,
    monotonic: bool = True,
) -> DataFrame:
    """Quantile bins, small ones merged, optionally made monotonic."""
    totals = class_totals(df, target)
    if 0 in totals:
        raise ValueError("target must have both classes")
    bins = merge_small_bins(fit_bins(df, features, target, n_bins), totals, min_bin_size)
    return make_monotonic(bins, totals) if monotonic else bins


def iv_summary(bins: DataFrame) -> DataFrame:
    """feature, iv, iv_category, n_bins, is_monotonic (over the regular bins)."""
    w = Window.partitionBy("feature").orderBy("bin_id")
    step = F.when(c("bin_id") > 0, c("woe") - F.lag(F.when(c("bin_id") >= 0, c("woe"))).over(w))
    out = bins.withColumn("step", step).groupBy("feature").agg(
        F.sum("iv").alias("iv"),
        F.count_if(c("bin_id") >= 0).alias("n_bins"),
        F.coalesce((F.min("step") >= 0) | (F.max("step") <= 0), F.lit(True)).alias("is_monotonic"),
    )
    return out.select("feature", "iv", iv_category(c("iv")).alias("iv_category"), "n_bins",
                      "is_monotonic")


def _bins_by_feature(bins: DataFrame) -> dict[str, list]:
    """The bin table on the driver: at most about ten rows per feature."""
    out: dict[str, list] = {}
    for r in bins.orderBy("feature", "lower").collect():
        out.setdefault(r["feature"], []).append(r)
    return out


def woe_expression(value: Column, rows: list) -> Column:
    """CASE expression: closed bins, later bin first; outside values take the nearest end bin."""
    regular = [r for r in rows if r["bin_id"] >= 0]
    missing = next((r["woe"] for r in rows if r["bin_id"] < 0), 0.0)
    out = F.when(value.isNull(), F.lit(missing))
    if regular:
        first, last = regular[0], regular[-1]
        out = out.when(value < first["lower"], F.lit(first["woe"]))
        out = out.when(value > last["upper"], F.lit(last["woe"]))
    for r in reversed(regular):
        out = out.when((value >= r["lower"]) & (value <= r["upper"]), F.lit(r["woe"]))
    return out.otherwise(F.lit(0.0))


def woe_encode(df: DataFrame, bins: DataFrame) -> DataFrame:
    """df with a {feature}_woe column per fitted feature; no join, no shuffle."""
    table = _bins_by_feature(bins)
    return df.withColumns(
        {f"{f}_woe": woe_expression(c(f), rows) for f, rows in table.items() if f in df.columns}
    )


def bin_lookup(long: DataFrame, bins: DataFrame) -> DataFrame:
    """Interval join of long-form values with the bin table (broadcast: ten rows per feature)."""
    b = F.broadcast(bins.select("feature", "bin_id", "lower", "upper", "woe")).alias("b")
    inside = c("l.value").between(c("b.lower"), c("b.upper"))
    nothing = c("l.value").isNull() & (c("b.bin_id") == -1)
    return (
        long.alias("l")
        .join(b, (c("l.feature") == c("b.feature")) & (inside | nothing), "left")
        .select("l.*", "b.bin_id", "b.woe")
    )


# --- column statistics -----------------------------------------------------------------------------


def numeric_stats(df: DataFrame, features: list[str], exact: bool = True) -> DataFrame:
    """feature, n, nulls, null_ratio, distinct_n, min, max, mean, std, variance, p25 ... p99."""
    long = long_form(df, features)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.count_if(c("value").isNull()).alias("nulls"),
        F.avg(F.when(c("value").isNull(), 1.0).otherwise(0.0)).alias("null_ratio"),
        (F.count_distinct("value") if exact else F.approx_count_distinct("value")).alias(
            "distinct_n"
        ),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.var_samp("value").alias("variance"),
    )
    probs = [0.25, 0.50, 0.75, 0.95, 0.99]
    if exact:
        q = ranking.quantiles(long, ["feature"], "value", probs).drop("n")
    else:
        q = sketch_cuts(long, probs).select("feature", c("cuts").alias("q"))
    names = ["p25", "p50", "p75", "p95", "p99"]
    return basic.join(q, "feature", "left").select(
        *basic.columns, *[c("q")[i].alias(n) for i, n in enumerate(names)]
    )


def categorical_stats(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values with their counts and the cardinality of the column."""
    counts = df.groupBy(c(column).alias("value")).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc("value")).limit(k)
    cardinality = counts.agg(F.count("*").alias("cardinality"))
    return top.join(F.broadcast(cardinality))
