"""Order by an id without one task that sees all rows."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shard_bounds(rows: DataFrame, key: str, size: int, most: int) -> list[int]:
    """Ids that cut the rows into ranges of about `size` rows, `most` ranges at most. Reads the key only."""
    count = rows.agg(F.count(key)).first()[0]
    parts = max(1, min(most, -(-count // size)))
    if parts == 1:
        return []
    shares = [k / parts for k in range(1, parts)]
    found = rows.agg(F.percentile_approx(key, shares, 10 * parts)).first()[0]
    return sorted(set(found))


def shard_of(key: str, bounds: list[int]) -> Column:
    """Number of the range that an id is in; null is in the first."""
    if not bounds:
        return F.lit(0)
    # two short searches: for the group of cuts, then inside it
    size = max(1, isqrt(len(bounds)))
    groups = [bounds[k : k + size] for k in range(0, len(bounds), size)]
    passed = lambda cuts: F.size(F.filter(cuts, lambda c: c <= F.col(key)))
    group = F.greatest(passed(F.lit([g[0] for g in groups])) - 1, F.lit(0))
    inside = passed(F.get(F.array(*(F.lit(g) for g in groups)), group))
    return F.coalesce(F.when(F.col(key).isNotNull(), group * size + inside), F.lit(0))


def id_shards(rows: DataFrame, key: str, size: int, most: int) -> DataFrame:
    """rows with `shard`, ascending with the key; how ids are dealt decides the work's split, not its result."""
    return rows.withColumn("shard", shard_of(key, shard_bounds(rows.select(key), key, size, most)).cast("int"))
