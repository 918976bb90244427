"""Amount and count cube over product x window x status.

The long form (one row per applicant and non-empty cell) is the operator; the wide frame is a
projection of it. Each tradeline is exploded to the cells it belongs to (at most 2 x 5 x 3) and
aggregated. When the rows arrive partitioned by applicant nothing is shuffled again; otherwise the
partial aggregation collapses an over-full applicant to 100 rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureauflow.operators.naming import SKIPPED, cube_cells, cube_name
from bureauflow.schema import KEY, WINDOWS

AGGS = ["cnt", "sum", "avg", "max", "min", "std"]


def _members() -> Column:
    """Array of the cells (product, window, status) a credit row belongs to."""
    product = F.array(F.lit("all"), F.col("p"))
    window = F.array_compact(
        F.array(
            F.lit("all"),
            *[F.when(F.col(f"w{m}"), F.lit(w)) for w, m in WINDOWS.items() if m],
        )
    )
    status = F.array_compact(
        F.array(
            F.lit("all"),
            F.when(F.col("a"), F.lit("active")),
            F.when(F.col("d"), F.lit("defaulted")),
            F.when(F.col("r"), F.lit("recovered")),
        )
    )
    return product, window, status


def amount_cube(rows: DataFrame) -> DataFrame:
    """Long cube: KEY, product, window, status, cnt, sum, avg, max, min, std (population)."""
    product, window, status = _members()
    cells = (
        rows.where(F.col("is_credit"))
        .select(*KEY, "amt", window.alias("ws"), status.alias("ss"), product.alias("ps"))
        .select(*KEY, "amt", "ws", "ss", F.explode("ps").alias("cube_product"))
        .select(*KEY, "amt", "ss", "cube_product", F.explode("ws").alias("cube_window"))
        .select(*KEY, "amt", "cube_product", "cube_window", F.explode("ss").alias("cube_status"))
    )
    return cells.groupBy(*KEY, "cube_product", "cube_window", "cube_status").agg(
        F.count("*").alias("cnt"),
        F.sum("amt").alias("sum"),
        F.avg("amt").alias("avg"),
        F.max("amt").alias("max"),
        F.min("amt").alias("min"),
        F.stddev_pop("amt").alias("std"),
    )


def cube_pivot(long: DataFrame) -> DataFrame:
    """One row per applicant with credit and one column per cell and aggregate; empty ones NULL."""
    cell = F.concat_ws("/", "cube_product", "cube_window", "cube_status")
    return (
        long.select(*KEY, cell.alias("cell"), *AGGS)
        .groupBy(*KEY)
        .pivot("cell", ["/".join(c) for c in cube_cells()])
        .agg(*[F.first(a).alias(a) for a in AGGS])
    )


def cube_cell_names() -> list[tuple[str, str]]:
    """(pivot column, readable name) of every kept cell."""
    pairs = [
        (f"`{p}/{w}/{s}_{a}`", cube_name(p, w, s, a)) for p, w, s in cube_cells() for a in AGGS
    ]
    return [(cell, name) for cell, name in pairs if name not in SKIPPED]


def cube_wide(apps: DataFrame, long: DataFrame, kind: str | None = None) -> DataFrame:
    """One row per applicant; readable columns of the cube (or its amounts / counts), empty = 0."""
    keep = set(cube_columns(kind))
    return (
        apps.select(*KEY)
        .join(cube_pivot(long), KEY, "left")
        .selectExpr(
            *KEY,
            *[f"coalesce({cell}, 0) as {name}" for cell, name in cube_cell_names() if name in keep],
        )
    )


def cube_columns(kind: str | None = None) -> list[str]:
    """Names of the wide cube; kind is "amount", "count" or None for both."""
    keep = {"amount": AGGS[1:], "count": ["cnt"], None: AGGS}[kind]
    names = [cube_name(p, w, s, a) for p, w, s in cube_cells() for a in AGGS if a in keep]
    return [n for n in names if n not in SKIPPED]
