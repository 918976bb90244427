"""Exact ranks, cumulative counts and quantiles within groups of any size.

A group may be a whole column (one score, one feature), so it is never sorted in one task. Values
are first collapsed to (group, value) counts. Groups of more than `max_group` distinct values are
cut into value ranges, every range is accumulated on its own, and a table of range totals (at most
CHUNKS rows per group) supplies the offsets. The cuts are part of the plan: no job runs before the
result is asked for. They are the values of least hash in each of SLOTS classes, evened out, so they
depend on the data alone and a recomputed task sees the same ranges; results are exact in any case.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNKS = 256
SLOTS = 4 * CHUNKS
MAX_GROUP = 2_000_000
# Cuts that are tried one by one, after as many that tell which.
STRIDE = 16
# Over-full groups of at least this size have so few cuts (CHUNKS each) that every task can hold all.
FEW_GROUPS_FROM = 100_000


def _cut_points(freq: DataFrame, by: list[str], value: str, max_group: int) -> DataFrame:
    """by, _cuts: CHUNKS - 1 ascending values of an over-full group, NULL where a group fits.

    freq has one row per distinct (group, value). All its columns are used, so that one exchange serves
    the cuts and what is cut.
    """
    # a sum is NULL for a group without any, so all of them are read, and none changes the number
    rest = [F.count(x) for x in freq.columns if x not in (*by, value)]
    drawn = freq.groupBy(*by, F.pmod(F.xxhash64(value), F.lit(SLOTS)).alias("_slot")).agg(
        F.min_by(value, F.xxhash64(value)).alias("_v"), F.greatest(F.count("*"), *rest).alias("_k")
    )
    found = drawn.groupBy(*by).agg(
        F.sum("_k").alias("_size"), F.sort_array(F.collect_list("_v")).alias("_drawn")
    )
    every = SLOTS // CHUNKS
    cuts = F.filter("_drawn", lambda _, i: i % every == every - 1)
    return found.select(*by, F.when(F.col("_size") > max_group, cuts).alias("_cuts"))


def _same(by: list[str], a: str, b: str) -> list[Column]:
    return [F.col(f"{a}.{x}").eqNullSafe(F.col(f"{b}.{x}")) for x in by]


def _below(value: str) -> Column:
    """How many of the ascending `_cuts` are below the value, by way of every STRIDE-th."""
    less = lambda x: x < F.col(value)
    whole = F.size(F.filter("_coarse", less)) * STRIDE
    return whole + F.size(F.filter(F.slice("_cuts", whole + 1, F.lit(STRIDE)), less))


def in_ranges(freq: DataFrame, by: list[str], value: str, max_group: int = MAX_GROUP) -> DataFrame:
    """freq (one row per distinct (group, value)) with `_chunk`, the number of its value range.

    Rows stay where they are: a join by group would lay a few large groups out over as many tasks.
    """
    cuts = _cut_points(freq, by, value, max_group)
    coarse = F.filter("_cuts", lambda _, i: i % STRIDE == STRIDE - 1)
    if by:
        cuts = cuts.where(F.col("_cuts").isNotNull()).withColumn("_coarse", coarse)
        if max_group >= FEW_GROUPS_FROM:
            cuts = F.broadcast(cuts)
        joined = freq.alias("f").join(cuts.alias("c"), _same(by, "f", "c"), "left")
        freq = joined.select("f.*", "_cuts", "_coarse")
    else:
        both = cuts.select(F.struct("_cuts", coarse.alias("_coarse")))
        freq = freq.withColumn("_both", both.scalar()).select("*", "_both._cuts", "_both._coarse").drop("_both")
    chunk = F.when(F.col("_cuts").isNull(), 0).otherwise(_below(value))
    return freq.withColumn("_chunk", chunk).drop("_cuts", "_coarse")


def cumulative(
    df: DataFrame,
    by: list[str],
    value: str,
    sums: dict[str, Column],
    max_group: int = MAX_GROUP,
) -> DataFrame:
    """One row per distinct (group, value) in value order.

    Columns: by, value, and for every entry of `sums` its total at the value (name), below the
    value (name_before) and over the group (name_total). NULL values are left out.
    """
    df = df.where(F.col(value).isNotNull())
    freq = df.groupBy(*by, value).agg(*[F.sum(e).alias(k) for k, e in sums.items()])
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    part = [*by, "_chunk"]
    dealt = in_ranges(freq, by, value, max_group).repartition(*part)
    # the bounds of the ranges keep the value in both uses of `dealt`, which then share its exchange
    totals = dealt.groupBy(*part).agg(
        F.max(value).alias("_last"), *[F.sum(k).alias(k) for k in sums]
    )
    group = [F.col(b) for b in by] or [F.lit(0)]
    w = Window.partitionBy(*group)  # a row per range
    offsets = totals.select(
        *part,
        "_last",
        *[zero(F.sum(k).over(before(w.orderBy("_chunk")))).alias(f"_{k}_off") for k in sums],
        *[F.sum(k).over(w).alias(f"{k}_total") for k in sums],
    )
    local = before(Window.partitionBy(*part).orderBy(value))
    rows = dealt.select("*", *[zero(F.sum(k).over(local)).alias(f"_{k}_loc") for k in sums])
    inside = F.col(f"f.{value}") <= F.col("_last")
    joined = rows.alias("f").join(offsets.alias("o"), [*_same(part, "f", "o"), inside])
    return joined.select(
        *[F.col(f"f.{b}").alias(b) for b in by],
        F.col(f"f.{value}").alias(value),
        *[F.col(f"f.{k}").alias(k) for k in sums],
        *[(F.col(f"_{k}_loc") + F.col(f"_{k}_off")).alias(f"{k}_before") for k in sums],
        *[F.col(f"{k}_total") for k in sums],
    )


def _position(p: float | Column) -> tuple[Column, Column]:
    """How many values lie below the p quantile's place among n, and the part of the way to the next.

    A number such as 0.7 stands for 7/10: whole numbers tell whether the place is a value, which (n - 1) * 0.7 doesn't.
    """
    n = F.col("n")
    if not isinstance(p, Column):
        share = Fraction(p).limit_denominator(1000)
        if float(share) == p:
            rest = (n - 1) * share.numerator % share.denominator
            return ((n - 1) * share.numerator - rest) / share.denominator, rest / share.denominator
        p = F.lit(float(p))
    at = (n - 1) * p
    return F.floor(at), at - F.floor(at)


def quantiles(
    df: DataFrame,
    by: list[str],
    value: str,
    probs: list,
    max_group: int = MAX_GROUP,
    weight: Column | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles: by, q (array in the order of probs), n.

    A prob is a number or a Column over `n`, the number of values of the group. weight: how often a
    row's value counts, if df holds values with their numbers.
    """
    times = F.lit(1) if weight is None else weight
    cum = cumulative(df, by, value, {"k": times}, max_group).withColumn("n", F.col("k_total"))
    pos = [_position(p) for p in probs]
    covers = lambda x: (F.col("k_before") <= x) & (x < F.col("k_before") + F.col("k"))
    v = F.col(value).cast("double")
    agg = cum.groupBy(*by).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(covers(k), v)).alias(f"lo{i}") for i, (k, _) in enumerate(pos)],
        *[F.max(F.when(covers(F.when(d > 0, k + 1).otherwise(k)), v)).alias(f"hi{i}") for i, (k, d) in enumerate(pos)],
    )
    out = []
    for i, (_, part) in enumerate(pos):
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        out.append(lo + (hi - lo) * part)
    return agg.select(*by, F.array(*out).alias("q"), "n")


def first_k(
    df: DataFrame,
    order: str,
    tie: str,
    k: Column,
    by: list[str] | None = None,
    max_group: int = MAX_GROUP,
) -> DataFrame:
    """df with `selected`: is the row among the first k of its group in (order, tie) order?

    `k` is an expression over n_total, the group size; `tie` must be unique within equal `order`
    values. Only the boundary is computed, and sent to every task: groups are classes, periods or
    segments, of which there are few, so rows are neither ranked nor laid out by group.
    """
    by = by or []
    placed = df.where(F.col(order).isNotNull()).select(*by, F.struct(order, tie).alias("_place"))
    cum = cumulative(placed, by, "_place", {"n": F.lit(1)}, max_group)
    last = cum.where((F.col("n_before") < k) & (k <= F.col("n_before") + F.col("n")))
    last = last.select(*by, F.col("_place").alias("_last"))
    if by:
        out = df.alias("d").join(F.broadcast(last).alias("c"), _same(by, "d", "c"), "left")
    else:
        out = df.alias("d").withColumn("_last", last.select("_last").scalar())
    chosen = F.col(f"d.{order}").isNotNull() & (F.struct(f"d.{order}", f"d.{tie}") <= F.col("_last"))
    return out.select("d.*", F.coalesce(chosen, F.lit(False)).alias("selected"))
