"""Feature elimination: every step returns one result row per feature with its status."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bureauflow.operators import binning, metrics

c = F.col


def _status(drop):
    return F.when(drop, "Eliminated").otherwise("Kept").alias("status")


def kept(result: DataFrame) -> list[str]:
    """Names of the surviving features (driver state between steps)."""
    return [r["feature"] for r in result.where(c("status") == "Kept").select("feature").collect()]


def keep_columns(df: DataFrame, features: list[str], others: list[str]) -> DataFrame:
    """df reduced to the surviving features that exist in it."""
    return df.select(*others, *[f for f in features if f in df.columns])


def constant_features(
    df: DataFrame, features: list[str], min_unique: int = 2, min_variance: float = 0.0
) -> DataFrame:
    """feature, unique_count, variance, status: too few distinct values or too little variance."""
    stats = binning.long_form(df, features).groupBy("feature").agg(
        F.count_distinct("value").alias("unique_count"),
        F.var_samp("value").alias("variance"),
    )
    drop = c("unique_count") < min_unique
    if min_variance > 0:
        drop = drop | (c("variance") <= min_variance)
    return stats.select("*", _status(drop))


def missing_features(df: DataFrame, features: list[str], max_rate: float = 0.70) -> DataFrame:
    """feature, missing rates of train / test / oot, status by the train rate. Needs `split`."""
    group = F.when(c("split").startswith("oot"), "oot").otherwise(c("split"))
    missing = F.when(c("value").isNull(), 1.0).otherwise(0.0)
    long = binning.long_form(df.withColumn("_g", group), features, ["_g"])
    rates = long.groupBy("feature").agg(
        *[
            F.avg(F.when(c("_g") == g, missing)).alias(f"{g}_missing_rate")
            for g in ("train", "test", "oot")
        ]
    )
    return rates.select("*", _status(c("train_missing_rate") > max_rate))


def iv_filter(
    df: DataFrame,
    features: list[str],
    target: str = "target",
    min_iv: float = 0.02,
    max_iv: float = 0.50,
    n_bins: int = 10,
    min_samples: int | None = None,
    values: DataFrame | None = None,
) -> DataFrame:
    """feature, iv, category, univariate auc / gini / ks, status, reason.

    values: `binning.value_counts` of the rows with a value and a target, if known.
    """
    long = binning.long_form(df, features, [target])
    iv = binning.information_value(long, target, n_bins, min_samples=min_samples, values=values)
    scores = (long, "value", target) if values is None else (values, "value", None)
    uni = metrics.auc_table(*scores, ["feature"]).where(
        (c("n") >= 50) & c("auc").isNotNull()
    )
    joined = iv.drop("n").join(
        uni.select("feature", "auc", "gini", c("ks_signed").alias("ks")), "feature", "left"
    )
    reason = (
        F.when(c("iv").isNull(), "no IV")
        .when(c("iv") < min_iv, "useless")
        .when(c("iv") > max_iv, "suspicious")
    )
    return joined.select("*", _status(reason.isNotNull()), reason.alias("reason"))


def psi_filter(psi: DataFrame, features: list[str], threshold: float = 0.25) -> DataFrame:
    """feature, max_psi, mean_psi, status over all comparisons; no comparison keeps everything."""
    names = psi.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    out = names.join(psi, "feature", "left").groupBy("feature").agg(
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.coalesce(F.avg("psi"), F.lit(0.0)).alias("mean_psi"),
    )
    return out.select("*", _status(c("max_psi") >= threshold))


def period_counts(df: DataFrame, features: list[str], target: str = "target") -> DataFrame:
    """feature, split, quarter, value, n, good, bad of train and out-of-time rows with a value and a target."""
    rows = df.where((c("split") == "train") | c("split").startswith("oot"))
    long = binning.long_form(rows, features, [target, "split", "quarter"])
    known = long.where(c("value").isNotNull() & c(target).isNotNull())
    return binning.value_counts(known, target, ["split", "quarter"])


def temporal_filter(
    df: DataFrame,
    features: list[str],
    target: str = "target",
    min_slope: float = -0.02,
    max_degradation: float = 0.05,
    min_rows: int = 30,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Univariate AUC by quarter on train and out-of-time rows: trend slope and degradation.

    Needs `split` and `quarter`. AUCs are folded to at least 0.5 and rounded to four digits. counts: their
    `period_counts`, if known.
    """
    oot = c("split").startswith("oot")
    if counts is None:
        rows = df.where((c("split") == "train") | oot)
        scores = (binning.long_form(rows, features, [target, "split", "quarter"]), "value", target)
    else:
        scores = (counts.where(c("feature").isin(features)), "value", None)
    auc = metrics.auc_table(*scores, ["feature", "split", "quarter"]).where(
        (c("n") >= min_rows) & c("auc").isNotNull()
    )
    auc = auc.select(
        "feature",
        oot.alias("is_oot"),
        "quarter",
        F.round(F.greatest(c("auc"), 1 - c("auc")), 4).alias("auc"),
    )
    w = Window.partitionBy("feature", "is_oot").orderBy("quarter")  # one row per quarter
    auc = auc.withColumn("x", (F.row_number().over(w) - 1).cast("double"))
    train = ~c("is_oot")
    out = auc.groupBy("feature").agg(
        F.coalesce(F.avg(F.when(train, c("auc"))), F.lit(0.5)).alias("train_auc"),
        F.avg(F.when(~train, c("auc"))).alias("oot"),
        F.coalesce(
            F.regr_slope(F.when(train, c("auc")), F.when(train, c("x"))), F.lit(0.0)
        ).alias("slope"),
    )
    out = out.withColumn("oot_auc", F.coalesce("oot", "train_auc")).withColumn(
        "degradation", c("train_auc") - c("oot_auc")
    )
    drop = (c("slope") < min_slope) | (c("degradation") > max_degradation)
    return out.select("feature", "train_auc", "oot_auc", "degradation", "slope", _status(drop))


# --- correlation -----------------------------------------------------------------------------------


def correlation_pairs(df: DataFrame, features: list[str], method: str = "pearson") -> DataFrame:
    """feature_a, feature_b, correlation of all pairs (pairwise complete).

    Spearman takes average ranks, with missing values as 0.
    """
    return (_rank_pairs if method == "spearman" else _pearson_pairs)(df, features)


def _pearson_pairs(df: DataFrame, features: list[str]) -> DataFrame:
    """Moments of all pairs from one pass: each task adds up matrix products of its batches.

    The plan grows with the number of features, not of pairs. Values are taken relative to their
    mean, so that no digits are lost when the moments are combined.
    """
    k = len(features)
    # NaN is missing as well
    number = {f: F.nanvl(c(f).cast("double"), F.lit(None).cast("double")) for f in features}
    center = df.agg(*[F.avg(number[f]).alias(f) for f in features]).first()
    shift = np.array([center[f] or 0.0 for f in features])
    first, second = np.triu_indices(k, 1)

    def moments(batches):
        total = None
        for batch in batches:
            x = np.column_stack([v.to_numpy(zero_copy_only=False) for v in batch.columns]) - shift
            known = ~np.isnan(x)
            x, m = np.where(known, x, 0.0), known.astype(float)
            sums = [m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x]
            part = np.stack([s[first, second] for s in sums])
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(first))), *map(pa.array, total)],
                ["pair", "n", "sa", "sb", "saa", "sbb", "sab"],
            )

    kinds = "pair bigint, n double, sa double, sb double, saa double, sbb double, sab double"
    rows = df.select(*[number[f].alias(f) for f in features]).mapInArrow(moments, kinds)
    sums = rows.groupBy("pair").agg(*[F.sum(x).alias(x) for x in ("n", "sa", "sb", "saa", "sbb", "sab")])
    va = c("saa") - c("sa") * c("sa") / c("n")
    vb = c("sbb") - c("sb") * c("sb") / c("n")
    r = (c("sab") - c("sa") * c("sb") / c("n")) / F.sqrt(va * vb)
    # what rounding leaves of the variance of a constant isn't one
    steady = (va > 1e-12 * c("saa")) & (vb > 1e-12 * c("sbb"))
    schema = "pair bigint, feature_a string, feature_b string"
    names = [(p, a, b) for p, (a, b) in enumerate(combinations(features, 2))]
    pairs = df.sparkSession.createDataFrame(names, schema)
    return pairs.join(sums, "pair", "left").select(
        "feature_a", "feature_b", F.when((c("n") > 1) & steady, r).alias("correlation")
    )


# Rows that are held as a matrix at a time.
BLOCK = 1_024
# Blocks of rows for each feature; with as many, a block's size doesn't depend on the number of features.
BLOCKS = 32
# Ranges of a feature's values, and the values of one block that a range has at least.
RANGES = 64
LEAST_IN_RANGE = 64


def _weighted(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different values in ascending order, their weights, and where each of the values is among them."""
    found, at = np.unique(values, return_inverse=True)
    return found, np.bincount(at, weights, len(found)), at


def _matrix_of(table: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and values (rows x k) of a block of rows."""
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return table.column("w").to_numpy().astype(float), flat.reshape(-1, k).copy()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.empty(0), *arrays])))


def _rank_pairs(df: DataFrame, features: list[str]) -> DataFrame:
    """Spearman's correlation of all pairs, by blocks of rows and ranges of values: the plan doesn't grow with the features.

    Equal rows are one row with a weight, and a hash deals rows to blocks. A block sends the different values of a feature as one array for
    each range of values and gets their ranks back as an array in the same order, which it puts to its rows. Rows of a block may come in any
    order, as only sorted values are sent. Ranks are taken relative to that of 0, so zeros take part in sums without being sent.
    """
    k, spark = len(features), df.sparkSession
    values = F.array(*[F.coalesce(c(f).cast("double"), F.lit(0.0)) for f in features])
    blocks = max(BLOCKS * k, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.groupBy(values.alias("v")).agg(F.count("*").alias("w"))
    rows = rows.select(F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int").alias("block"), "w", "v")
    total = rows.agg(F.sum("w")).scalar()

    def sent(block: pa.Table) -> pa.Table:
        w, x = _matrix_of(block, k)
        found = [_weighted(v[v != 0], w[v != 0])[:2] for v in x.T]
        some = [f for f in range(k) if len(found[f][0])]
        columns = [pa.array([block.column("block")[0].as_py()] * len(some), pa.int32()), pa.array(some, pa.int32())]
        return pa.table([*columns, *(_lists([found[f][i] for f in some]) for i in (0, 1))], ["block", "f", "values", "weights"])

    arrays = "values array<double>, weights array<double>"
    one = F.when(c("w") > 0, c("block")) == 0  # w keeps the choice behind the exchange, which both then read
    dealt, first_block = (x.groupBy("block").applyInArrow(sent, f"block int, f int, {arrays}") for x in (rows, rows.where(one)))
    # a block is a sample of the rows: the values of the first one cut those of all into ranges
    step = F.greatest(F.lit(LEAST_IN_RANGE), F.ceil(F.size("values") / RANGES))
    cuts = first_block.select("f", F.filter("values", lambda _, i: (i % step == 0) & (i > 0)).alias("cuts"))

    def ranged(batches):
        for batch in batches:
            out = []
            for block, f, v, w, cuts in zip(*batch.columns):
                v, w = v.values.to_numpy(), w.values.to_numpy()
                cut = cuts.values.to_numpy() if cuts.is_valid else np.empty(0)
                at = np.r_[0, np.searchsorted(v, cut), len(v)]
                out += [
                    (block.as_py(), f.as_py(), r, w[i:j].sum(), w[i:j][v[i:j] < 0].sum(), v[i:j], w[i:j])
                    for r, (i, j) in enumerate(zip(at[:-1], at[1:])) if i < j
                ]
            if out:
                *plain, v, w = zip(*out)
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
                columns = [pa.array(x, kind) for x, kind in zip(plain, kinds)]
                yield pa.RecordBatch.from_arrays([*columns, _lists(v), _lists(w)], ["block", "f", "part", "n", "low", "values", "weights"])

    columns = f"block int, f int, part int, n double, low double, {arrays}"
    parts = dealt.join(F.broadcast(cuts), "f", "left").select("block", "f", "values", "weights", "cuts").mapInArrow(ranged, columns)

    def ranked(part: pa.Table) -> pa.Table:
        flat = [part.column(x).combine_chunks().flatten().to_numpy() for x in ("values", "weights")]
        _, w, at = _weighted(*flat)
        rank = (np.cumsum(w) - w / 2)[at]
        sizes = pa.compute.list_value_length(part.column("values")).to_numpy()
        return pa.table([*(part.column(x) for x in ("block", "f", "part")), _lists(np.split(rank, np.cumsum(sizes)[:-1]))], ["block", "f", "part", "ranks"])

    each = Window.partitionBy("f")  # a row for each range
    before = F.coalesce(F.sum("n").over(each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    # half the zeros stand between 0's rank and the first above it, and as many below
    zeros = (total - F.sum("n").over(each)) / 2
    ranges = parts.groupBy("f", "part").agg(F.sum("n").alias("n"), F.sum("low").alias("low"))
    offsets = ranges.select("f", "part", (before - F.sum("low").over(each)).alias("offset"), zeros.alias("zeros"))
    local = parts.groupBy("f", "part").applyInArrow(ranked, "block int, f int, part int, ranks array<double>")
    ranks = local.join(F.broadcast(offsets), ["f", "part"])
    first, second = np.triu_indices(k)

    def moments(block: pa.Table, found: pa.Table) -> pa.Table:
        w, x = _matrix_of(block, k)
        found = found.sort_by([("f", "ascending"), ("part", "ascending")])
        of, lists = found.column("f").to_numpy(), found.column("ranks").combine_chunks()
        moved = np.repeat(found.column("offset").to_numpy(), lists.value_lengths().to_numpy()) + lists.flatten().to_numpy()
        feature = np.repeat(of, lists.value_lengths().to_numpy())
        zeros = dict(zip(of.tolist(), found.column("zeros").to_pylist()))
        for f in range(k):
            some = x[:, f] != 0
            v = x[some, f]
            if len(v):
                x[some, f] = moved[feature == f][np.unique(v, return_inverse=True)[1]] + np.where(v < 0, -zeros[f], zeros[f])
        sums, products = w @ x, np.zeros((k, k))
        for at in range(0, len(w), BLOCK):
            part = x[at : at + BLOCK]
            products += (part * w[at : at + BLOCK, None]).T @ part
        a, b = np.append(first, np.arange(k)), np.append(second, np.full(k, -1))
        return pa.table([pa.array(a), pa.array(b), pa.array(np.append(products[first, second], sums))], ["a", "b", "s"])

    made = rows.groupBy("block").cogroup(ranks.groupBy("block")).applyInArrow(moments, "a bigint, b bigint, s double")
    sums = made.groupBy("a", "b").agg(F.sum("s").alias("s"))
    # a's sum and square stand beside it, and b's beside b, so that all is made once
    of_a, of_b = Window.partitionBy("a"), Window.partitionBy("b")
    sum_a, square_a = (F.max(F.when(c("b") == x, c("s"))).over(of_a) for x in (F.lit(-1), c("a")))
    sums = sums.select("a", "b", "s", sum_a.alias("sum_a"), (square_a - sum_a * sum_a / total).alias("spread_a"))
    beside = lambda x: F.max(F.when(c("a") == c("b"), c(f"{x}_a"))).over(of_b).alias(f"{x}_b")
    sums = sums.select("*", beside("sum"), beside("spread")).where((c("b") >= 0) & (c("a") < c("b")))
    product = c("s") - c("sum_a") * c("sum_b") / total
    r = F.when((c("spread_a") > 0) & (c("spread_b") > 0), product / F.sqrt(c("spread_a") * c("spread_b")))
    a, b = np.triu_indices(k, 1)
    names = np.array(features, object)
    pairs = spark.createDataFrame(pa.table([pa.array(a), pa.array(b), pa.array(names[a], pa.string()), pa.array(names[b], pa.string())], ["a", "b", "feature_a", "feature_b"]))
    return pairs.join(sums.select("a", "b", r.alias("correlation")), ["a", "b"], "left").select("feature_a", "feature_b", "correlation")


def correlation_matrix(df: DataFrame, features: list[str], method: str = "pearson") -> DataFrame:
    """Full matrix in long form with missing values as 0, by Spark ML."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    clean = df.select(*[c(f).cast("double").alias(f) for f in features]).fillna(0)
    vectors = VectorAssembler(inputCols=features, outputCol="v").transform(clean)
    m = Correlation.corr(vectors, "v", method).first()[0].toArray()
    rows = [
        (a, b, float(m[i, j])) for i, a in enumerate(features) for j, b in enumerate(features)
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature_a string, feature_b string, correlation double"
    )


def high_correlations(pairs: DataFrame, threshold: float = 0.90) -> DataFrame:
    """Pairs at or above the threshold, strongest first."""
    return pairs.where(F.abs("correlation") >= threshold).orderBy(
        F.desc(F.abs("correlation")), "feature_a", "feature_b"
    )


def _matrix(pairs: DataFrame, features: list[str]) -> np.ndarray:
    """k x k matrix on the driver; k is the number of features."""
    index = {f: i for i, f in enumerate(features)}
    m = np.eye(len(features))
    for r in pairs.collect():
        i, j = index.get(r["feature_a"]), index.get(r["feature_b"])
        if i is not None and j is not None:
            m[i, j] = m[j, i] = np.nan if r["correlation"] is None else r["correlation"]
    return m


def correlation_filter(
    pairs: DataFrame, features: list[str], iv: dict[str, float], threshold: float = 0.90
) -> DataFrame:
    """Greedy by IV: a kept feature drops everything correlated above the threshold with it.

    One masked pass over the matrix: `free` are the features that nobody has dropped yet.
    """
    strength = np.array([iv.get(f) or 0.0 for f in features])
    order = np.argsort(-strength, kind="stable")
    names = [features[k] for k in order]
    close = np.abs(_matrix(pairs, names))
    np.fill_diagonal(close, 0.0)
    free, by = np.ones(len(names), bool), np.full(len(names), -1)
    for k in range(len(names)):
        if by[k] < 0:
            taken = free & (close[k] > threshold)
            by[taken], free = k, free & ~taken
    rows = [
        (
            f,
            float(strength[order[k]]),
            names[by[k]] if by[k] >= 0 else None,
            float(close[by[k], k]) if by[k] >= 0 else None,
            "Kept" if by[k] < 0 else "Eliminated",
        )
        for k, f in enumerate(names)
    ]
    return pairs.sparkSession.createDataFrame(
        rows,
        "feature string, iv double, eliminated_by string, abs_correlation double, status string",
    )


def correlation_filter_pairwise(
    pairs: DataFrame, iv: DataFrame, threshold: float = 0.80
) -> DataFrame:
    """Every pair at or above the threshold drops its lower-IV member: feature, iv, status."""
    score = F.coalesce("iv", F.lit(0.0))
    a = iv.select(c("feature").alias("feature_a"), score.alias("iv_a"))
    b = iv.select(c("feature").alias("feature_b"), score.alias("iv_b"))
    losers = (
        pairs.where(F.abs("correlation") >= threshold)
        .join(a, "feature_a")
        .join(b, "feature_b")
        .select(
            F.when(c("iv_a") >= c("iv_b"), c("feature_b")).otherwise(c("feature_a")).alias(
                "feature"
            )
        )
        .distinct()
        .withColumn("lost", F.lit(True))
    )
    return iv.join(losers, "feature", "left").select("feature", "iv", _status(c("lost")))


def _without(inverse: np.ndarray, k: int) -> np.ndarray:
    """Inverse of the matrix without row and column k, from the whole one's inverse."""
    rest = np.delete(np.arange(len(inverse)), k)
    column = inverse[rest, k]
    return inverse[np.ix_(rest, rest)] - np.outer(column, column) / inverse[k, k]


def vif_filter(
    pairs: DataFrame, features: list[str], iv: dict[str, float] | None = None,
    threshold: float = 5.0,
) -> DataFrame:
    """Variance inflation, the diagonal of the inverse correlation matrix; one feature a round goes.

    With IVs it is the weakest feature above the threshold, otherwise the one with the largest
    inflation. The matrix is inverted once; each round sweeps its feature out of the inverse.
    """
    matrix = _matrix(pairs, features)
    singular = np.linalg.matrix_rank(matrix) < len(features)
    weight = np.array([(iv or {}).get(f) or 0.0 for f in features])
    left, rounds = np.arange(len(features)), np.zeros(len(features), int)
    initial, final = np.full(len(features), np.nan), np.full(len(features), np.nan)
    if len(features) > 2:
        inverse = np.linalg.pinv(matrix)
        initial[:] = np.diag(inverse)
        for step in range(1, len(features)):
            inflation = np.diag(inverse)
            over = np.flatnonzero(inflation > threshold)
            if not len(over):
                break
            k = over[np.argmin(weight[left[over]])] if iv else int(np.argmax(inflation))
            rounds[left[k]] = step
            left = np.delete(left, k)
            # a pseudo-inverse can't be swept
            inverse = np.linalg.pinv(matrix[np.ix_(left, left)]) if singular else _without(inverse, k)
        if len(left) > 2:
            final[left] = np.diag(inverse)
    number = lambda x: None if np.isnan(x) else float(x)
    rows = [
        (
            f,
            number(initial[k]),
            number(final[k]),
            float(weight[k]),
            int(rounds[k]) or None,
            "Eliminated" if rounds[k] else "Kept",
        )
        for k, f in enumerate(features)
    ]
    return pairs.sparkSession.createDataFrame(
        rows,
        "feature string, vif_initial double, vif_final double, iv double, round int, status string",
    )


def univariate_report(
    df: DataFrame,
    features: list[str],
    target: str = "target",
    max_missing: float = 0.70,
    min_iv: float = 0.02,
    max_iv: float = 0.50,
    min_variance: float = 0.001,
) -> DataFrame:
    """Statistics, IV, Gini and KS per feature with rejection reasons."""
    stats = binning.numeric_stats(df, features)
    iv = iv_filter(df, features, target, min_iv, max_iv).drop("status", "reason")
    joined = stats.join(iv, "feature", "left")
    why = F.array_compact(
        F.array(
            F.when(c("null_ratio") > max_missing, "missing"),
            F.when(c("iv") < min_iv, "useless").when(c("iv") > max_iv, "suspicious"),
            F.when(F.coalesce("variance", F.lit(0.0)) < min_variance, "near_constant"),
            F.when(c("distinct_n") <= 1, "constant"),
        )
    )
    return joined.select("*", F.array_join(why, ";").alias("reasons")).withColumn(
        "recommended", c("reasons") == ""
    )


def feature_quality(df: DataFrame, features: list[str], target: str = "target") -> DataFrame:
    """feature, null_ratio, distinct_n, variance, iv (smoothed), iv_category."""
    stats = binning.numeric_stats(df, features).select(
        "feature", "null_ratio", "distinct_n", "variance"
    )
    iv = binning.smoothed_information_value(binning.long_form(df, features, [target]), target)
    return stats.join(iv, "feature", "left")
