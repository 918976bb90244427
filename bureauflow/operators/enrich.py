"""Tradeline enrichment and the split of over-full applicants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauflow.schema import (
    CREDIT_PRODUCTS,
    DAYS_PER_MONTH,
    KEY,
    OPTIONAL_TRADELINE,
    PRODUCTS,
    WINDOWS,
)

MAX_ROWS_PER_KEY = 1_000_000


def with_optional_columns(bureau: DataFrame) -> DataFrame:
    """Add the optional tradeline columns a source does not deliver as typed NULLs."""
    missing = {
        name: F.lit(None).cast(dtype)
        for name, dtype in OPTIONAL_TRADELINE.items()
        if name not in bureau.columns
    }
    return bureau.withColumns(missing) if missing else bureau


def credit_only(bureau: DataFrame) -> DataFrame:
    return bureau.where(F.col("product_type").isin(CREDIT_PRODUCTS))


def non_credit_only(bureau: DataFrame) -> DataFrame:
    return bureau.where(~F.col("product_type").isin(CREDIT_PRODUCTS))


def attach_tradelines(apps: DataFrame, bureau: DataFrame) -> DataFrame:
    """Applicants with their tradelines; applicants without any keep one NULL row."""
    return apps.join(bureau, KEY, "left")


def attach_application_date(bureau: DataFrame, apps: DataFrame) -> DataFrame:
    """Tradelines of known applicants with the reference date."""
    return bureau.join(apps.select(*KEY, "application_date"), KEY, "inner")


def enrich(dated: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Row-level measures every family works on.

    Credit measures are NULL (flags false) on overdraft and overlimit rows, so aggregates skip those
    rows without a filter and one pass serves credit and non-credit features alike.
    """
    dated = with_optional_columns(dated)
    credit = F.col("product_type").isin(CREDIT_PRODUCTS)
    code = F.when(F.lit(False), F.lit(None).cast("string"))
    for short, name in PRODUCTS.items():
        code = code.when(F.col("product_type") == name, short)
    on_credit = lambda c: F.when(credit, F.col(c))
    rows = dated.select(
        *keys,
        credit.alias("is_credit"),
        F.col("application_date").alias("ref"),
        F.col("product_type").alias("product"),
        code.alias("p"),
        F.when(~credit, F.col("total_amount")).alias("nc_amt"),
        on_credit("total_amount").alias("amt"),
        on_credit("opening_date").alias("opening"),
        on_credit("default_date").alias("dflt"),
        on_credit("recovery_date").alias("rec"),
        on_credit("closure_date").alias("closure"),
        on_credit("duration_months").alias("duration"),
        on_credit("monthly_payment").alias("payment"),
        F.col("tradeline_id").alias("tid"),
    )
    age = F.datediff("ref", "opening")
    return rows.select(
        "*",
        F.unix_date("opening").alias("day"),
        (F.year("opening") * 12 + F.month("opening")).alias("month"),
        age.alias("age_d"),
        (age / DAYS_PER_MONTH).alias("age_m"),
        F.datediff("dflt", "opening").alias("ttd"),
        F.datediff("rec", "dflt").alias("rec_d"),
        F.col("dflt").isNotNull().alias("d"),
        F.col("rec").isNotNull().alias("r"),
        (F.col("is_credit") & F.col("dflt").isNull()).alias("a"),
        *[
            F.coalesce(F.col("opening") >= F.add_months("ref", -m), F.lit(False)).alias(f"w{m}")
            for m in WINDOWS.values()
            if m
        ],
    )


@dataclass
class HotKeys:
    """Keys with more rows than one task should hold; None when there are none."""

    keys: DataFrame | None


def hot_keys(bureau: DataFrame, keys: list[str] = KEY, limit: int = MAX_ROWS_PER_KEY) -> HotKeys:
    """The over-full keys, from one pre-aggregated counting job.

    They stay a distributed table, however many there are.
    """
    found = bureau.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > limit)
    return HotKeys(None if found.isEmpty() else found.select(*keys))


def split_hot(
    df: DataFrame, hot: DataFrame | None, keys: list[str] = KEY
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys)."""
    if hot is None:
        return df, None
    return df.join(hot, keys, "left_anti"), df.join(hot, keys, "left_semi")
