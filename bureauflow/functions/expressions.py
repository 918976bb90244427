"""Small Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when the denominator is zero or missing."""
    return F.when(den != 0, num / den)


def ratio0(num: Column, den: Column) -> Column:
    """num / den, 0 when the quotient is undefined."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def flag(cond: Column) -> Column:
    """1 / 0 with NULL conditions counted as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def sum_if(cond: Column, value: Column) -> Column:
    """Conditional sum, 0 when nothing qualifies."""
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0.0))


def adjusted_skewness(skew: Column, n: Column) -> Column:
    """Bias-adjusted sample skewness from the population one; NULL below three values."""
    n = n.cast("double")
    return F.when(n > 2, F.coalesce(skew, F.lit(0.0)) * F.sqrt(n * (n - 1)) / (n - 2))


def quarter_label(date: Column) -> Column:
    """Calendar quarter such as 2024Q3."""
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def stable_hash(*cols: Column, seed: int = 42) -> Column:
    """60-bit hash that does not change between runs, engines or partitionings."""
    text = F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def entropy(counts: list[Column], total: Column) -> Column:
    """Shannon entropy (base 2) of a fixed list of counters."""
    terms = [
        F.when(c > 0, -(c / total) * F.log2(c / total)).otherwise(F.lit(0.0)) for c in counts
    ]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def add_all(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def iv_category(iv: Column) -> Column:
    """Predictive-strength label; the cut points are fixed values."""
    return (
        F.when(iv.isNull(), "unknown")
        .when(iv < 0.02, "useless")
        .when(iv < 0.10, "weak")
        .when(iv < 0.30, "medium")
        .when(iv < 0.50, "strong")
        .otherwise("suspicious")
    )
