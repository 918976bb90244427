"""Model development and scorecard development from end to end.

Only feature names and small result tables travel through the driver; the data stay in DataFrames
with a `split` column. Result tables are returned by name and can be saved with
`sources.tables.save_artefact`.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauflow.operators import binning, cutoffs, elimination, metrics, models, psi, scorecard
from bureauflow.operators import splitting

c = F.col


@dataclass
class Development:
    """What a run leaves. Its frames read cached ones until release() lets them go; they then compute anew."""

    features: list[str]
    model: object
    scored: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)
    held: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        for frame in self.held:
            frame.unpersist()


@contextmanager
def _holding(held: list[DataFrame]):
    """Lets go of the frames held so far if the run fails."""
    try:
        yield
    except BaseException:
        for frame in held:
            frame.unpersist()
        raise


def prepare(
    df: DataFrame, train_end: str, date: str = "date", target: str = "target", uid: str = "uid",
    stratify: bool = True,
) -> DataFrame:
    """df with `split` and `quarter`."""
    splitting.validate_target(df.where(c(date) <= F.lit(train_end).cast("date")), target)
    split = splitting.stratified_split if stratify else splitting.temporal_split
    options = {"date": date, "uid": uid}
    if stratify:
        options["target"] = target
    return metrics.with_quarter(split(df, train_end, **options), date)


def _iv(result: DataFrame) -> dict[str, float]:
    return {r["feature"]: r["iv"] for r in result.select("feature", "iv").collect()}


def train_psi(train: DataFrame, features: list[str], date: str) -> DataFrame:
    """PSI of every training quarter against the whole training period."""
    return psi.plan_psi(psi.by_period(train, date), features)


def evaluate(
    scored: DataFrame, score: str, target: str, uid: str, segments: list[str] = ()
) -> dict[str, DataFrame]:
    """Performance by period and overall, trend, confusion, score PSI, lift, segments."""
    by_period = scored.withColumn("period", c("split"))
    performance = metrics.performance_by_period(by_period, score, target, uid)
    out = {
        "performance": performance,
        "summary": metrics.performance_by_period(metrics.combine_oot(scored), score, target, uid),
        "trend": metrics.quarterly_trend(performance),
        "confusion": metrics.confusion_table(scored, score, target, by=["split"]),
        "score_psi": psi.score_psi(by_period, score),
        "lift": metrics.lift_table(scored, score, target, ["split"]),
    }
    for s in segments:
        out[f"segment_{s}"] = metrics.segment_performance(scored, score, target, s, "split")
    return out


def develop_model(
    df: DataFrame,
    features: list[str],
    train_end: str,
    date: str = "date",
    target: str = "target",
    uid: str = "uid",
    segments: list[str] = (),
    max_features: int = 20,
    fit=models.fit_boosted,
    iv_range: tuple[float, float] = (0.02, 0.50),
    max_psi: float = 0.25,
    max_correlation: float = 0.90,
    folds: int = 5,
    cache: bool = True,
) -> Development:
    """Split, eliminate step by step, select by cross-validation, fit and evaluate."""
    data = prepare(df, train_end, date, target, uid)
    held = [data.persist()] if cache else []  # every step below reads it
    with _holding(held):
        found = _developed(data, features, date, target, uid, segments, max_features, fit, iv_range, max_psi, max_correlation, folds)
    found.held = held
    return found


def _developed(
    data, features, date, target, uid, segments, max_features, fit, iv_range, max_psi, max_correlation, folds
) -> Development:
    train = data.where("split = 'train'")
    tables: dict[str, DataFrame] = {}

    def step(name: str, result: DataFrame, current: list[str]) -> list[str]:
        # a row per feature, worked out once
        result = tables[name] = data.sparkSession.createDataFrame(result.toArrow(), result.schema)
        survivors = set(elimination.kept(result))
        if not survivors.intersection(current):
            raise ValueError(f"no feature survives the step {name}")
        return [f for f in current if f in survivors]

    kept = step("constant", elimination.constant_features(train, features), list(features))
    kept = step("missing", elimination.missing_features(data, kept), kept)
    # IVs and AUCs read the distinct values several times: they are counted once
    counts = elimination.period_counts(data, kept, target).persist()
    sums = [F.sum(x).alias(x) for x in ("n", "good", "bad")]
    values = counts.where("split = 'train'").groupBy("feature", "value").agg(*sums).persist()
    try:
        kept = step("iv", elimination.iv_filter(train, kept, target, *iv_range, values=values), kept)
        values.unpersist()
        iv = _iv(tables["iv"])
        kept = step("psi", elimination.psi_filter(train_psi(train, kept, date), kept, max_psi), kept)
        kept = step("temporal", elimination.temporal_filter(data, kept, target, counts=counts), kept)
    finally:
        values.unpersist()
        counts.unpersist()
    if len(kept) > 1:
        pairs = elimination.correlation_pairs(train, kept)
        kept = step(
            "correlation", elimination.correlation_filter(pairs, kept, iv, max_correlation), kept
        )
    if not kept:
        raise ValueError("no feature survives the elimination steps")
    filled = data.fillna(0, subset=kept)
    kept, tables["selection"] = models.sequential_selection(
        filled.where("split = 'train'"), kept, target, folds=folds, max_features=max_features,
        fit=fit,
    )
    if len(kept) > 2:
        pairs = elimination.correlation_pairs(train, kept)
        kept = step("vif", elimination.vif_filter(pairs, kept, iv), kept)
    model = fit(filled.where("split = 'train'"), kept, target)
    scored = models.predict(model, filled)
    tables.update(evaluate(scored, "probability_bad", target, uid, segments))
    return Development(kept, model, scored, tables)


def develop_scorecard(
    df: DataFrame,
    features: list[str],
    train_end: str,
    date: str = "date",
    target: str = "target",
    uid: str = "uid",
    iv_range: tuple[float, float] = (0.02, 0.50),
    max_psi: float = 0.25,
    max_correlation: float = 0.80,
    cache: bool = True,
    **scale,
) -> Development:
    """WoE bins on train, IV range, half-split PSI and pairwise correlation on the encoded values,
    standardised logistic regression, points, scored rows and evaluation."""
    data = prepare(df, train_end, date, target, uid)
    held = [data.persist()] if cache else []  # every step below reads it
    with _holding(held):
        bins = binning.fit_woe(data.where("split = 'train'"), features, target).persist()
        held.append(bins)
        found = _developed_scorecard(data, bins, date, target, uid, iv_range, max_psi, max_correlation, scale)
    found.held = held
    return found


def _developed_scorecard(
    data, bins, date, target, uid, iv_range, max_psi, max_correlation, scale
) -> Development:
    spark = data.sparkSession
    train = data.where("split = 'train'")
    ivs = binning.iv_summary(bins)
    tables = {"bins": bins, "iv": ivs}
    low, high = iv_range
    rows = ivs.where(c("iv").between(low, high)).orderBy(F.desc("iv"), "feature").collect()
    kept = [r["feature"] for r in rows]
    if not kept:
        raise ValueError("no feature has an information value in the range")
    encoded = binning.woe_encode(data, bins.where(c("feature").isin(kept)))
    train = encoded.where("split = 'train'")
    names = [f"{f}_woe" for f in kept]
    stability = psi.plan_psi(psi.by_halves(train, date), names)
    tables["psi"] = elimination.psi_filter(stability, names, max_psi)
    stable = set(elimination.kept(tables["psi"]))
    names = [n for n in names if n in stable]
    if len(names) > 1:
        pairs = elimination.correlation_pairs(train, names)
        weights = ivs.select(F.concat("feature", F.lit("_woe")).alias("feature"), "iv").where(
            c("feature").isin(names)
        )
        tables["correlation"] = elimination.correlation_filter_pairwise(
            pairs, weights, max_correlation
        )
        left = set(elimination.kept(tables["correlation"]))
        names = [n for n in names if n in left]
    model = models.fit_logistic(train, names, target)
    coef = {r["feature"]: r for r in models.coefficient_table(model, spark, names).collect()}
    plain = {n: n.removesuffix("_woe") for n in names}
    card = scorecard.build_scaled_scorecard(
        bins,
        {plain[n]: coef[n]["coefficient"] for n in names},
        {plain[n]: coef[n]["mean"] for n in names},
        {plain[n]: coef[n]["scale"] for n in names},
        coef["(intercept)"]["coefficient"],
        **scale,
    )
    tables["scorecard"] = card
    tables["importance"] = models.coefficient_importance(model, spark, names)
    scored = scorecard.score_rows(models.predict(model, encoded), card, None, None)
    tables.update(evaluate(scored, "probability_bad", target, uid))
    tables["cutoffs"] = cutoffs.cutoff_table(
        scored.where("split = 'test'"), "scorecard_score", target
    )
    return Development(list(plain.values()), model, scored, tables)
