"""Population stability: comparison plans, PSI of many features and periods in one pass, monitoring.

A comparison plan marks the rows of a frame: `base_id` (which baseline they belong to), `base`
(whether they count towards it) and `label` (the comparison they are the current side of, if any).
Everything else follows from one additive cube of counts by feature, baseline, label and bin: sizes,
expected and actual shares are sums over it, so the frame is read once for the edges of the bins and
once for the cube, and no job runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bureauflow.functions import ranking
from bureauflow.functions.expressions import quarter_label
from bureauflow.operators.binning import long_form, qcut_edges, with_bins

c = F.col
MIN_SIDE = 10
# The customary limits of a moderate and of a significant shift.
MODERATE, SIGNIFICANT = 0.10, 0.25
MARKS = ["base_id", "label", "base"]
CELL = ["feature", *MARKS]


def _period(date: str, period: str) -> Column:
    return quarter_label(c(date)) if period == "quarter" else F.year(date).cast("string")


def by_period(df: DataFrame, date: str = "date", period: str = "quarter") -> DataFrame:
    """Every quarter (or year) against the whole frame; labels Q_2024Q1_vs_All / Y_2024_vs_All."""
    label = F.concat(F.lit("Q_" if period == "quarter" else "Y_"), _period(date, period), F.lit("_vs_All"))
    return df.withColumns({"base_id": F.lit("all"), "label": label, "base": F.lit(True)})


def by_consecutive_quarters(df: DataFrame, date: str = "date") -> DataFrame:
    """Every quarter against the one before it that has rows; labels 2024Q1_vs_2024Q2."""
    key = quarter_label(c(date))
    present = df.select(key.alias("k")).where(c("k").isNotNull()).distinct()  # as many rows as quarters
    in_order = F.sort_array(F.collect_list("k"))
    pairs = F.zip_with(F.slice("ks", 2, F.size("ks")), F.slice("ks", 1, F.size("ks") - 1), lambda k, before: F.struct(k, before))
    before = present.agg(in_order.alias("ks")).select(F.map_from_entries(pairs)).scalar()
    sides = F.array(
        F.struct(key.alias("base_id"), F.lit(None).cast("string").alias("label"), F.lit(True).alias("base")),
        F.struct(c("_before").alias("base_id"), F.concat("_before", F.lit("_vs_"), key).alias("label"), F.lit(False).alias("base")),
    )
    marked = df.withColumn("_before", F.try_element_at(before, key))
    return marked.select(*df.columns, F.inline(sides)).where(c("base_id").isNotNull())


def by_split(df: DataFrame, first: Column, label: str) -> DataFrame:
    """Rows of the first side against the others; rows of neither are left out."""
    marked = df.withColumns({"base_id": F.lit(label), "base": first})
    marked = marked.where(c("base").isNotNull())
    return marked.withColumn("label", F.when(~c("base"), F.lit(label)))


def by_halves(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows up to the median date against later rows."""
    days = df.select(F.unix_date(c(date)).alias("day"))
    median = ranking.quantiles(days, [], "day", [0.5]).select(c("q")[0]).scalar()
    return by_split(df, F.unix_date(c(date)) <= median, "first_half_vs_second_half")


def by_date(df: DataFrame, date: str, split: str, label: str | None = None) -> DataFrame:
    """Rows up to a date against rows after it."""
    return by_split(df, c(date) <= F.lit(split).cast("date"), label or f"before_vs_after_{split}")


def date_split(df: DataFrame, date: str, split: str, label: str | None = None) -> tuple:
    """by_date as two frames: base rows with base_id, current rows with base_id and label."""
    marked = by_date(df, date, split, label)
    return marked.where("base").drop("label", "base"), marked.where(c("label").isNotNull()).drop("base")


def _cells(long: DataFrame, n_bins: int, min_rows: int) -> DataFrame:
    """Full grid of bins of every comparison: feature, base_id, label, bin, e, a, e_total, a_total.

    long: feature, value and the marks of a plan. Comparisons with fewer than min_rows rows on a
    side, missing values included, are left out.
    """
    keys = ["feature", "base_id"]
    edges = qcut_edges(long.where("base"), by=keys, n_bins=n_bins)
    # a constant baseline has one open-ended bin
    one = edges.withColumn(
        "edges",
        F.when(F.size("edges") >= 2, c("edges")).otherwise(F.concat("edges", "edges")),
    )
    bins = F.size("edges") - 1
    cube = with_bins(long, one, keys, keep=bins.alias("bins")).groupBy(*CELL, "bins", "bin").agg(
        F.count("*").alias("k")
    )
    # from here on: features x labels x at most n_bins rows
    counts = F.map_from_entries(F.collect_list(F.when(c("bin").isNotNull(), F.struct("bin", "k"))))
    sides = cube.groupBy(*CELL, "bins").agg(counts.alias("k"), F.sum("k").alias("rows"))
    every = F.sequence(F.lit(0), c("bins") - 1)
    grid = sides.select(*CELL, "rows", "k", F.explode(every).alias("bin"))
    grid = grid.withColumn("a", F.coalesce(F.try_element_at("k", "bin"), F.lit(0)))
    whole = Window.partitionBy(*keys, "bin")
    grid = grid.withColumns({
        "e": F.coalesce(F.sum(F.when(c("base"), c("a"))).over(whole), F.lit(0)),
        "base_rows": F.sum(F.when(c("base"), c("rows"))).over(whole),
    })
    kept = grid.where(c("label").isNotNull() & (c("rows") >= min_rows) & (c("base_rows") >= min_rows))
    side = Window.partitionBy(*keys, "label")
    kept = kept.withColumns({"e_total": F.sum("e").over(side), "a_total": F.sum("a").over(side)})
    return kept.select(*keys, "label", "bin", "e", "a", "e_total", "a_total")


def _shares(floor: float) -> tuple[Column, Column, Column]:
    """Expected and actual share of a bin, floored, and their part of the index."""
    e = F.greatest(c("e") / c("e_total"), F.lit(floor))
    a = F.greatest(c("a") / c("a_total"), F.lit(floor))
    return e, a, (a - e) * F.ln(a / e)


def _summed(cells: DataFrame, floor: float, min_rows: int) -> DataFrame:
    enough = (c("e_total") >= min_rows) & (c("a_total") >= min_rows)
    part = F.when(enough, _shares(floor)[2])
    return cells.groupBy("feature", "base_id", "label").agg(F.sum(part).alias("psi"))


def _broken_down(cells: DataFrame, floor: float) -> DataFrame:
    e, a, part = _shares(floor)
    return cells.select(
        "feature", "label", "bin", e.alias("expected_share"), a.alias("actual_share"), part.alias("psi")
    )


def plan_psi(
    plan: DataFrame, features: list[str], n_bins: int = 10, floor: float = 1e-4, min_rows: int = MIN_SIDE
) -> DataFrame:
    """PSI per feature and comparison of a plan's rows: feature, base_id, label, psi.

    Bins are right-closed quantile bins of the baseline with open ends; shares are floored, not
    renormalised; NULL below min_rows values.
    """
    return _summed(_cells(long_form(plan, features, MARKS), n_bins, min_rows), floor, min_rows)


def plan_psi_bins(
    plan: DataFrame, features: list[str], n_bins: int = 10, floor: float = 1e-4, min_rows: int = MIN_SIDE
) -> DataFrame:
    """Breakdown per bin: expected share, actual share and contribution."""
    return _broken_down(_cells(long_form(plan, features, MARKS), n_bins, min_rows), floor)


def _both(base: DataFrame, cmp: DataFrame) -> DataFrame:
    """Two long frames, the second with labels, as one with marks."""
    old = base.withColumns({"label": F.lit(None).cast("string"), "base": F.lit(True)})
    new = cmp.withColumn("base", F.lit(False))
    columns = ["feature", "value", *MARKS]
    return old.select(*columns).unionByName(new.select(*columns))


def psi(
    base: DataFrame,
    cmp: DataFrame,
    n_bins: int = 10,
    floor: float = 1e-4,
    min_rows: int = MIN_SIDE,
) -> DataFrame:
    """plan_psi of two frames. base: feature, value, base_id; cmp: the same plus label."""
    return _summed(_cells(_both(base, cmp), n_bins, 0), floor, min_rows)


def psi_bins(base: DataFrame, cmp: DataFrame, n_bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """plan_psi_bins of two frames."""
    return _broken_down(_cells(_both(base, cmp), n_bins, 0), floor)


def score_psi(df: DataFrame, score: str, period: str = "period", base: str = "train",
              n_bins: int = 10) -> DataFrame:
    """Score PSI of every other period against train: period, psi, status."""
    rows = df.select(
        F.lit("score").alias("feature"),
        c(score).cast("double").alias("value"),
        F.lit(base).alias("base_id"),
        F.when(c(period) != base, c(period)).alias("label"),
        (c(period) == base).alias("base"),
    ).where(c("base").isNotNull())
    out = _summed(_cells(rows, n_bins, 0), 1e-4, MIN_SIDE)
    status = (
        F.when(c("psi").isNull(), "N/A")
        .when(c("psi") < MODERATE, "Stable")
        .when(c("psi") < SIGNIFICANT, "Moderate")
        .otherwise("Significant")
    )
    return out.select(c("label").alias(period), "psi", status.alias("status"))


# --- monitoring against a stored baseline ----------------------------------------------------------


def fit_baseline(long: DataFrame, n_bins: int = 10, min_rows: int = 50) -> DataFrame:
    """feature, edges, shares, n: left-closed quantile bins of the baseline."""
    edges = qcut_edges(long, n_bins=n_bins).where(c("n") >= min_rows)
    counts = (
        with_bins(long, edges, closed="left")
        .where(c("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(F.count("*").alias("k"))
    )
    per = counts.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "k"))).alias("k")
    )
    last = F.size("edges") - 2
    share = F.transform(
        F.sequence(F.lit(0), last), lambda b: F.coalesce(c("k")[b], F.lit(0)) / c("n")
    )
    return edges.where(F.size("edges") >= 2).join(per, "feature").select(
        "feature", "edges", share.alias("shares"), "n"
    )


def monitor_bins(baseline: DataFrame, current: DataFrame, floor: float = 1e-6) -> DataFrame:
    """Every bin of a baseline: feature, bin, expected, actual, psi (its part of the index).

    Shares are floored and renormalised on both sides; a feature without any current value has empty
    bins, and stays.
    """
    counts = (
        with_bins(current, baseline, closed="left")
        .where(c("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(F.count("*").alias("k"))
    )
    grid = baseline.select("feature", F.posexplode("shares").alias("bin", "e"))
    rows = grid.join(counts, ["feature", "bin"], "left")
    feature = Window.partitionBy("feature")  # a row per bin
    actual = F.coalesce(c("k") / F.sum("k").over(feature), F.lit(0.0))
    rows = rows.select(
        "feature", "bin", F.greatest("e", F.lit(floor)).alias("e"), F.greatest(actual, F.lit(floor)).alias("a")
    )
    rows = rows.select("feature", "bin", *[(c(x) / F.sum(x).over(feature)).alias(x) for x in ("e", "a")])
    return rows.select(
        "feature", "bin", c("e").alias("expected"), c("a").alias("actual"), ((c("a") - c("e")) * F.ln(c("a") / c("e"))).alias("psi")
    )


def monitor(baseline: DataFrame, current: DataFrame, floor: float = 1e-6,
            warning: float = MODERATE, critical: float = SIGNIFICANT) -> DataFrame:
    """PSI of current data against a baseline: feature, psi, status."""
    out = monitor_bins(baseline, current, floor).groupBy("feature").agg(F.sum("psi").alias("psi"))
    status = (
        F.when(c("psi") >= critical, "critical")
        .when(c("psi") >= warning, "warning")
        .otherwise("stable")
    )
    return out.withColumn("status", status)


def alerts(monitored: DataFrame) -> DataFrame:
    """Features needing attention with a message."""
    text = F.concat(F.upper("status"), F.lit(": "), c("feature"), F.lit(" PSI = "),
                    F.format_number("psi", 4))
    return monitored.where(c("status") != "stable").select("feature", "status", text.alias("message"))


def run_record(monitored: DataFrame, run_date: str) -> DataFrame:
    """One history row: run_date, features, stable, warning, critical."""
    is_ = lambda s: F.count_if(c("status") == s)
    return monitored.agg(
        F.count("*").alias("features"),
        is_("stable").alias("stable"),
        is_("warning").alias("warning"),
        is_("critical").alias("critical"),
    ).select(F.lit(run_date).cast("date").alias("run_date"), "*")


# --- history of runs ------------------------------------------------------------------------------

RUNS = "feature string, psi double, status string, run_date date"


def record_run(monitored: DataFrame, folder: str, run_date: str) -> None:
    """Adds a run to the history in folder, a partition per date; the same date again replaces that run.

    Only the run's own partition is written, and it appears as a whole when the job commits, so a run
    that is repeated after a failure leaves what one run leaves.
    """
    rows = monitored.select("feature", "psi", "status", F.lit(run_date).cast("date").alias("run_date"))
    writer = rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_date").parquet(folder)


def read_runs(spark: SparkSession, folder: str, since: str | None = None) -> DataFrame:
    """The history's rows; `since` reads later partitions only."""
    runs = spark.read.schema(RUNS).parquet(folder)
    return runs if since is None else runs.where(c("run_date") >= F.lit(since).cast("date"))


def run_history(runs: DataFrame) -> DataFrame:
    """A row per run: run_date, features, stable, warning, critical, max_psi, mean_psi."""
    count = lambda s: F.count_if(c("status") == s).alias(s)
    return runs.groupBy("run_date").agg(
        F.count("*").alias("features"),
        count("stable"),
        count("warning"),
        count("critical"),
        F.max("psi").alias("max_psi"),
        F.avg("psi").alias("mean_psi"),
    )


def status_changes(runs: DataFrame) -> DataFrame:
    """Features whose status isn't that of the run before: run_date, feature, psi, status, those of before, change.

    A feature's first run counts as a change unless it is stable.
    """
    level = lambda s: F.array_position(F.array(*[F.lit(x) for x in ("stable", "warning", "critical")]), c(s))
    before = Window.partitionBy("feature").orderBy("run_date")  # a row per run
    rows = runs.withColumns({f"previous_{x}": F.lag(x).over(before) for x in ("psi", "status")})
    step = level("status") - F.coalesce(level("previous_status"), F.lit(1))
    change = F.when(c("previous_status").isNull(), "new").when(step > 0, "worse").otherwise("better")
    return rows.where(step != 0).select(
        "run_date", "feature", "psi", "status", "previous_psi", "previous_status", change.alias("change")
    )
