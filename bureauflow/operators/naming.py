"""Readable names of the amount and count cube."""

from __future__ import annotations

from bureauflow.schema import PRODUCT_NAMES, STATUSES, WINDOWS

# Name stems of the aggregations.
AGG_STEMS = {
    "sum": "total_amount",
    "avg": "average_amount",
    "max": "max_amount",
    "min": "min_amount",
    "std": "amount_std",
    "cnt": "count",
}

# Cube columns left out because a better named twin exists in another family.
SKIPPED = {
    "total_credit_max_amount",
    "total_credit_min_amount",
    "defaulted_average_amount",
    "defaulted_max_amount",
    "defaulted_count",
    "recovered_count",
}


def cube_name(product: str, window: str, status: str, agg: str) -> str:
    """Name of one cube cell, for example mortgage_active_average_amount_last_12m."""
    stem = AGG_STEMS[agg]
    if product == window == status == "all":
        return "total_credit_" + stem.removeprefix("total_")
    parts = [PRODUCT_NAMES[product], "" if status == "all" else status, stem]
    suffix = "" if window == "all" else f"_last_{window}"
    return "_".join(p for p in parts if p) + suffix


def cube_cells() -> list[tuple[str, str, str]]:
    return [(p, w, s) for p in PRODUCT_NAMES for w in WINDOWS for s in STATUSES]
