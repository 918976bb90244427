"""Feature metadata and the data dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bureauflow.operators import binning
from bureauflow.operators.cube import AGGS
from bureauflow.operators.families import FAMILIES
from bureauflow.operators.naming import SKIPPED, cube_cells, cube_name

FUNCTIONS = {"cnt": "count", "sum": "sum", "avg": "mean", "max": "max", "min": "min", "std": "std"}


def _unit(name: str) -> str:
    if name.startswith(("has_", "is_", "ever_", "both_", "either_", "prefers_", "applied_")):
        return "flag"
    if name.endswith(("_flag", "_heavy")):
        return "flag"
    for word, unit in (
        ("_count", "count"), ("_days", "days"), ("_months", "months"), ("_ratio", "ratio"),
        ("_rate", "ratio"), ("_share", "ratio"), ("_concentration", "ratio"), ("_amount", "currency"),
        ("_payment", "currency"), ("_severity", "currency"), ("_burden", "currency"),
        ("_score", "numeric"),
    ):
        if name.endswith(word):
            return unit
    return "numeric"


def definitions() -> list[tuple]:
    """name, category, product, window, status, agg, unit, formula, low, high, risk_direction."""
    rows = []
    for p, w, s in cube_cells():
        for a in AGGS:
            name = cube_name(p, w, s, a)
            if name in SKIPPED:
                continue
            where = [x for x in (
                None if p == "all" else f"product = {p}",
                None if w == "all" else f"opened in last {w}",
                None if s == "all" else s,
            ) if x]
            what = "count(*)" if a == "cnt" else f"{FUNCTIONS[a]}(total_amount)"
            formula = what + (" where " + " and ".join(where) if where else "")
            rows.append((
                name, "count_feature" if a == "cnt" else "amount_feature", p, w, s, FUNCTIONS[a],
                "count" if a == "cnt" else "currency", formula, 0.0, None,
                "higher_is_riskier" if s == "defaulted" else "context_dependent",
            ))
    for family, build in FAMILIES.items():
        for name, column in build().items():
            unit = _unit(name)
            rows.append((
                name, f"{family}_feature", None, None, None, None, unit, _formula(column),
                0.0 if unit in ("flag", "ratio", "count") else None,
                1.0 if unit in ("flag", "ratio") else None,
                "higher_is_riskier" if "default" in name else "context_dependent",
            ))
    return rows


def _formula(column: Column) -> str:
    """The column's own expression over the applicant profile."""
    return str(column).removeprefix("Column<'").removesuffix("'>")


def registry(spark: SparkSession) -> DataFrame:
    """The metadata table: one row per feature, independent of any data."""
    return spark.createDataFrame(
        definitions(),
        "name string, category string, product string, window string, status string, agg string, "
        "unit string, formula string, low double, high double, risk_direction string",
    )


def data_dictionary(
    df: DataFrame, features: list[str], target: str = "target", exact: bool = True
) -> DataFrame:
    """Statistics and IV of the features with their metadata; unknown features keep NULL metadata."""
    stats = binning.numeric_stats(df, features, exact)
    long = binning.long_form(df, features, [target])
    iv = (binning.fifths_iv if exact else binning.approximate_iv)(long, target)
    meta = registry(df.sparkSession).select(
        F.col("name").alias("feature"), "category", "unit", "formula"
    )
    return stats.join(iv, "feature", "left").join(F.broadcast(meta), "feature", "left")
