"""The wide applicant frame and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauflow.operators import enrich as en
from bureauflow.operators.cube import amount_cube, cube_cell_names, cube_columns, cube_pivot
from bureauflow.operators.families import FAMILIES, family_columns, with_application_totals
from bureauflow.operators.profile import applicant_profile, dated_rows
from bureauflow.schema import CORE, KEY


def with_uid(apps: DataFrame) -> DataFrame:
    return apps.withColumn("uid", F.concat_ws("||", *KEY))


def first_per_uid(apps: DataFrame) -> DataFrame:
    """One row per uid; the first in (application_date, applicant_type, target) order."""
    rest = F.struct("application_date", "applicant_type", "target")
    return (
        with_uid(apps)
        .groupBy("uid", *KEY)
        .agg(F.min(rest).alias("first"))
        .select("uid", *KEY, "first.*")
    )


def cube_long(
    apps: DataFrame,
    bureau: DataFrame,
    max_rows_per_key: int = en.MAX_ROWS_PER_KEY,
    found: en.HotKeys | None = None,
) -> DataFrame:
    """Long amount/count cube of all applicants with credit. found: the over-full applicants, if known."""
    found = found or en.hot_keys(bureau, KEY, max_rows_per_key)
    cold, over = en.split_hot(bureau, found.keys)
    out = amount_cube(dated_rows(apps, cold))
    if over is not None:
        hot_apps = apps.join(found.keys, KEY, "left_semi").select(*KEY, "application_date")
        rows = en.enrich(en.with_optional_columns(over).join(hot_apps, KEY))
        out = out.unionByName(amount_cube(rows))
    return out


def feature_names() -> list[str]:
    return cube_columns() + [n for f in FAMILIES for n in family_columns([f])]


def wide_frame(
    apps: DataFrame,
    bureau: DataFrame,
    undefined: str = "null",
    max_rows_per_key: int = en.MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Core columns and every feature (as double), one row per applicant.

    Three reads of the tradelines: for the cube, for the profile of all other families, and of three
    columns for the totals of applications; before them one count finds the over-full applicants.
    """
    people = first_per_uid(apps)
    found = en.hot_keys(bureau, KEY, max_rows_per_key)
    profile = applicant_profile(people, bureau, max_rows_per_key, found)
    cube = cube_pivot(cube_long(people, bureau, max_rows_per_key, found))
    frame = with_application_totals(people, bureau).join(profile, KEY, "left")
    cols = family_columns(list(FAMILIES), undefined)
    other = frame.select(*CORE, *[e.alias(k) for k, e in cols.items()])
    return other.join(cube, KEY, "left").selectExpr(
        *CORE,
        *[f"coalesce(cast({cell} as double), 0D) as {name}" for cell, name in cube_cell_names()],
        *[f"cast({name} as double) as {name}" for name in cols],
    )


def reconcile(features: DataFrame, apps: DataFrame) -> DataFrame:
    """One-row check of a feature frame: row counts, uid uniqueness, missing ids, empty rows."""
    names = [n for n in features.columns if n not in CORE]
    got = features.agg(
        F.count("*").alias("output_rows"),
        F.count_distinct("uid").alias("distinct_uids"),
        F.count_if(F.col("uid").isNull()).alias("null_uids"),
        F.count_if(F.col("application_id").isNull()).alias("null_application_ids"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_ids"),
        F.count_if(F.coalesce(*names).isNull()).alias("all_null_rows"),
    )
    return (
        got.join(apps.agg(F.count("*").alias("input_rows")))
        .withColumn("lost_rows", F.col("input_rows") - F.col("output_rows"))
        .withColumn("unique_uids", F.col("distinct_uids") == F.col("output_rows"))
    )
