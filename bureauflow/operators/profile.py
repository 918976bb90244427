"""Per-applicant profile: every aggregate the feature families are derived from.

Ordinary applicants are co-located once (one exchange by key) and all window columns are computed
inside that partitioning. Applicants with more rows than a task should hold take `_hot_profile`: order
is resolved per calendar day, which bounds the number of chunks, and the days are stitched together
by a small table of day summaries; value distributions go through the chunked frequency tables of
`functions.ranking`. Both paths give the same aggregates.
"""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureauflow.functions import ranking
from bureauflow.functions.expressions import adjusted_skewness, sum_if
from bureauflow.operators import enrich as en
from bureauflow.schema import KEY, PRODUCTS
from bureauflow.sources import tables as src

PART = KEY + ["is_credit"]
SEQ = ["opening", "amt", "product", "tid"]
DEFAULT_SEQ = ["dflt", "amt", "product", "tid"]
UNB = Window.unboundedPreceding
# Of over-full applicants: their number, the chunks of their rows, and the order inside a chunk. Codes of
# products are in the order of their names.
NUM = "_num"
CHUNK = [NUM, "slot", "sub"]
HOT_SEQ = ["amt", "p", "tid"]
NO_DAY = -(2**31)
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Columns that hold a row's place in the order of openings, or a value of the applicant's other rows.
IN_SEQUENCE = [
    "rn", "n", "np", "pay_rn", "prev_day", "prev_p", "gap", "change", "run_start", "c30", "c60", "c90",
    "a30", "a60", "in_month", "r1", "amt_min", "amt_max", "latest", "prev_dp",
]
# Row measures by the tradeline columns that they are made of.
MEASURES = {
    "is_credit": {"product_type"},
    "product": {"product_type"},
    "p": {"product_type"},
    "ref": {"application_date"},
    "nc_amt": {"total_amount"},
    "amt": {"total_amount"},
    "opening": {"opening_date"},
    "dflt": {"default_date"},
    "rec": {"recovery_date"},
    "closure": {"closure_date"},
    "duration": {"duration_months"},
    "payment": {"monthly_payment"},
    "tid": {"tradeline_id"},
    "day": {"opening_date"},
    "month": {"opening_date"},
    "age_d": {"application_date", "opening_date"},
    "age_m": {"application_date", "opening_date"},
    "ttd": {"default_date", "opening_date"},
    "rec_d": {"recovery_date", "default_date"},
    "d": {"default_date"},
    "r": {"recovery_date"},
    "a": {"default_date"},
    **{f"w{m}": {"application_date", "opening_date"} for m in (3, 6, 12, 24)},
}
# Risk score per product used by the amount-weighted product score.
PRODUCT_SCORE = {"is": 3, "cf": 2, "il": 1, "mg": 0}


def _pick(before: str, n: str, value: str, p: float) -> tuple[Column, Column, Column]:
    """(lower order statistic, upper one, interpolation weight) of quantile p as aggregates."""
    pos = (F.col(n) - 1) * F.lit(p)
    at = lambda k: F.max(F.when(F.col(before) == k, F.col(value)))
    return at(F.floor(pos)), at(F.ceil(pos)), pos - F.floor(pos)


def _quantile_over(before: str, n: str, value: str, p: float, w) -> Column:
    low, high, weight = _pick(before, n, value, p)
    return low.over(w) + (high.over(w) - low.over(w)) * weight


def _sequence_steps(df: DataFrame, upto) -> DataFrame:
    """Columns derived from row number, previous product and previous day."""
    df = df.withColumns(
        {
            "gap": F.when(F.col("rn") > 1, F.col("day") - F.col("prev_day")),
            "change": F.col("prev_p").isNull() | (F.col("prev_p") != F.col("p")),
        }
    )
    return df


def _cold_rows(rows: DataFrame) -> DataFrame:
    """Window columns of ordinary applicants; rows must be partitioned by KEY."""
    w = Window.partitionBy(*PART)
    seq = w.orderBy(*SEQ)
    upto = seq.rowsBetween(UNB, 0)
    ahead = lambda days: w.orderBy("day").rangeBetween(0, days)
    rows = rows.withColumns(
        {
            "n": F.count("*").over(w),
            "rn": F.row_number().over(seq),
            "prev_day": F.lag("day").over(seq),
            "prev_p": F.lag("p").over(seq),
            "prev_month": F.lag("month").over(seq),
            "pay_rn": F.count("payment").over(upto),
            "np": F.count("payment").over(w),
            "c30": F.count("*").over(ahead(30)),
            "c60": F.count("*").over(ahead(60)),
            "c90": F.count("*").over(ahead(90)),
            "a30": F.sum("amt").over(ahead(30)),
            "a60": F.sum("amt").over(ahead(60)),
            "r1": F.min("rec").over(w),
            "amt_min": F.min("amt").over(w),
            "amt_max": F.max("amt").over(w),
        }
    )
    rows = _sequence_steps(rows, upto)
    new_month = F.col("prev_month").isNull() | (F.col("prev_month") != F.col("month"))
    rows = rows.withColumns(
        {
            "run_start": F.max(F.when(F.col("change"), F.col("rn"))).over(upto),
            "month_start": F.max(F.when(new_month, F.col("rn"))).over(upto),
            "latest": F.max(F.when(F.col("rn") == F.col("n"), F.col("amt"))).over(w),
        }
    ).withColumn("in_month", F.col("rn") - F.col("month_start") + 1)
    by_amount = w.orderBy(F.asc_nulls_last("amt"), F.col("tid"))
    rows = rows.withColumn("amt_before", F.row_number().over(by_amount) - 1)
    rows = rows.withColumn("n_amt", F.count("amt").over(w))
    rows = rows.withColumns(
        {
            "q1": _quantile_over("amt_before", "n_amt", "amt", 0.25, w),
            "q3": _quantile_over("amt_before", "n_amt", "amt", 0.75, w),
        }
    )
    rows = rows.withColumn(
        "pay_before", F.row_number().over(w.orderBy(F.asc_nulls_last("payment"))) - 1
    )
    rows = rows.withColumn("n_gap", F.count("gap").over(w)).withColumn(
        "gap_before", F.row_number().over(w.orderBy(F.asc_nulls_last("gap"))) - 1
    )
    return rows.withColumn(
        "prev_dp", F.lag("p").over(Window.partitionBy(*PART, "d").orderBy(*DEFAULT_SEQ))
    )


def _used(exprs, names) -> set[str]:
    """Which of the names the expressions mention; a word that only looks like a name does no harm."""
    words = {w for e in exprs for w in re.findall(r"\w+", str(e))}
    return words & set(names)


def _written(rows: DataFrame, made: list[str]) -> DataFrame:
    """rows, written to the shared folder and read again: what follows reads them several times.

    The exchanges behind them are removed at once, as nothing reads them again. made: gets the path.
    """
    spark = rows.sparkSession
    path = src.artefact_folder(spark, f"over-full-{uuid4().hex}")
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        src.save_artefact(rows, path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    made.append(path)
    return spark.read.schema(rows.schema).parquet(path)


def _in_chunks(rows: DataFrame, date: str, limit: int, made: list[str]) -> DataFrame:
    """rows with the chunks that order is resolved in: `slot`, the day of a date, and `sub`.

    A day of more than `limit` rows is cut into ranges of amount, product and tradeline id; where there
    is none, rows aren't touched. Rows without the date have the first slot, so that it is never NULL.
    """
    rows = rows.withColumn("slot", F.coalesce(F.unix_date(date), F.lit(NO_DAY)))
    group = [NUM, "slot"]
    if rows.groupBy(*group).agg(F.count("*").alias("k")).where(F.col("k") > limit).isEmpty():
        return rows.withColumn("sub", F.lit(0))
    placed = rows.withColumn("_place", F.struct(*HOT_SEQ))
    cut = ranking.in_ranges(placed, group, "_place", limit).withColumnRenamed("_chunk", "sub")
    return _written(cut.drop("_place"), made)


def _chunk_table(rows: DataFrame, exprs: list[Column], made: list[str]) -> DataFrame:
    """A row per chunk: what its rows need of the applicant's other chunks, and of the applicant as a whole.

    It has the columns that exprs read, and is written, as several tables come from it.
    """
    have = lambda name, e: e if name in rows.columns else F.lit(None)
    chunks = rows.groupBy(*CHUNK).agg(
        F.count("*").alias("n_d"),
        have("payment", F.count("payment")).alias("pay_d"),
        have("amt", F.sum("amt")).alias("amt_d"),
        have("amt", F.min("amt")).alias("least"),
        have("amt", F.max("amt")).alias("most"),
        have("rec", F.min("rec")).alias("rec_1"),
        (F.max(F.struct(*HOT_SEQ))["amt"] if {*HOT_SEQ} <= {*rows.columns} else F.lit(None)).alias("last_amt"),
    )
    day = F.when(F.col("slot") != NO_DAY, F.col("slot"))
    chunks = chunks.withColumn("day", day)
    chunks = chunks.withColumn("month", F.date_trunc("month", F.date_from_unix_date("day")))
    w = Window.partitionBy(NUM)
    order = w.orderBy("slot", "sub")
    earlier = order.rowsBetween(UNB, -1)
    ahead = lambda d: w.orderBy("day").rangeBetween(0, d)
    zero = lambda c: F.coalesce(c, F.lit(0))
    columns = {
        "n_d": F.col("n_d"),
        "day": F.col("day"),
        "n": F.sum("n_d").over(w),
        "np": F.sum("pay_d").over(w),
        "rn_off": zero(F.sum("n_d").over(earlier)),
        "pay_off": zero(F.sum("pay_d").over(earlier)),
        "day_before": F.lag("day").over(order),
        "c30": F.sum("n_d").over(ahead(30)),
        "c60": F.sum("n_d").over(ahead(60)),
        "c90": F.sum("n_d").over(ahead(90)),
        "a30": F.sum("amt_d").over(ahead(30)),
        "a60": F.sum("amt_d").over(ahead(60)),
        # a row without a month stands alone
        "in_month": F.when(F.col("month").isNull(), 1).otherwise(
            F.sum("n_d").over(Window.partitionBy(NUM, "month"))
        ),
        "r1": F.min("rec_1").over(w),
        "amt_min": F.min("least").over(w),
        "amt_max": F.max("most").over(w),
        "latest": F.last("last_amt").over(order.rowsBetween(UNB, Window.unboundedFollowing)),
    }
    # a chunk's rows share their day, so all of its gaps but one are 0, and those come first
    step = F.when(F.col("rn_off") > 0, F.col("day") - F.col("day_before"))
    no_gap = F.coalesce(F.sum(F.when(F.col("day").isNotNull(), F.col("n_d") - 1)).over(w), F.lit(0))
    gaps = {
        "n_same": no_gap,
        "n_gap": no_gap + F.count(step).over(w),
        "gap_before": no_gap + F.row_number().over(w.orderBy(F.asc_nulls_last(step))) - 1,
    }
    read = _used(exprs, {**columns, **gaps})
    if read & set(gaps):
        read |= {"n_d", "day", "rn_off", "day_before"}
    chunks = chunks.select(*CHUNK, *[e.alias(k) for k, e in columns.items() if k in read])
    return _written(chunks.withColumns({k: e for k, e in gaps.items() if k in read}), made)


def _day_aggregates() -> dict[str, Column]:
    """Aggregates over the chunk table alone."""
    c = F.col
    step = F.when(c("rn_off") > 0, c("day") - c("day_before"))
    none = c("day") - c("day")
    rest = F.when(c("n_d") > 1, none)
    gap = F.coalesce(step, rest)
    half = F.floor((c("n") - 1) / 2)
    middle = (c("n_gap") - 1) / 2
    at = lambda k: F.when(F.max("n_same") > F.max(k), 0).otherwise(F.max(F.when(c("gap_before") == k, step)))
    return {
        **{k: F.max(k) for k in ("c30", "c60", "c90", "a30", "a60")},
        "month_peak": F.max("in_month"),
        "gap_min": F.min(F.least(step, rest)),
        "gap_max": F.max(F.greatest(step, rest)),
        "gap_med": (at(F.floor(middle)) + at(F.ceil(middle))) / 2,
        "gap_sum": F.sum(gap),
        "gap_sq": F.sum(gap.cast("bigint") * gap),
        "n_rapid": F.sum(F.when(step <= 14, 1).otherwise(0) + F.when(c("day").isNotNull(), c("n_d") - 1).otherwise(0)),
        "gap_last": F.max(
            F.when(c("rn_off") + c("n_d") == c("n"), F.when(c("n_d") > 1, none).otherwise(step))
        ),
        "day_half": F.max(F.when((c("rn_off") <= half) & (half < c("rn_off") + c("n_d")), c("day"))),
    }


def _in_sequence(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """rows with their place among the applicant's, and its values of `_chunk_table`; they are exchanged once, by chunk."""
    rows = rows.join(chunks.select(*CHUNK, *[x for x in chunks.columns if x not in rows.columns]), CHUNK)
    local = Window.partitionBy(*CHUNK).orderBy(*HOT_SEQ)
    rows = rows.withColumn("rn", F.col("rn_off") + F.row_number().over(local))
    if "pay_off" in rows.columns:
        upto = local.rowsBetween(UNB, 0)
        rows = rows.withColumn("pay_rn", F.col("pay_off") + F.count("payment").over(upto))
    return rows


def _streaks(rows: DataFrame) -> DataFrame:
    """transitions, streak: from runs of one product inside the chunks, put together at their cuts."""
    c = F.col
    local = Window.partitionBy(*CHUNK).orderBy(*HOT_SEQ)
    rows = rows.select(*CHUNK, "p", F.row_number().over(local).alias("k"), F.lag("p").over(local).alias("before"))
    rows = rows.withColumn("new", c("before").isNull() | (c("before") != c("p")))
    start = F.max(F.when(c("new"), c("k"))).over(Window.partitionBy(*CHUNK).orderBy("k").rowsBetween(UNB, 0))
    rows = rows.withColumn("start", start)
    runs = rows.groupBy(*CHUNK).agg(
        F.count("*").alias("size"),
        F.count_if(c("new")).alias("runs"),
        F.max(F.when(c("k") == 1, c("p"))).alias("first_p"),
        F.max_by("p", "k").alias("last_p"),
        F.min(F.when(c("new") & (c("k") > 1), c("k"))).alias("second"),
        F.max("start").alias("last"),
        F.max(c("k") - c("start") + 1).alias("best"),
    )
    w = Window.partitionBy(NUM)
    order = w.orderBy("slot", "sub")
    earlier = order.rowsBetween(UNB, -1)
    runs = runs.withColumns(
        {
            "off": F.coalesce(F.sum("size").over(earlier), F.lit(0)),
            "p_before": F.lag("last_p").over(order),
            "n": F.sum("size").over(w),
        }
    )
    # the chunk's first run goes on from the chunk before, or it begins one
    goes_on = F.coalesce(c("p_before") == c("first_p"), F.lit(False))
    runs = runs.withColumns(
        {
            "goes_on": goes_on,
            "first_start": c("off") + F.when(~goes_on, 1).otherwise(c("second")),
            "last_start": c("off") + F.when(~goes_on | (c("runs") > 1), c("last")),
        }
    )
    runs = runs.withColumn("open_start", F.max("last_start").over(earlier))
    return runs.groupBy(NUM).agg(
        (F.sum("runs") - F.count_if(c("goes_on")) - 1).alias("transitions"),
        F.greatest(
            F.max("best"), F.max(c("first_start") - c("open_start")), F.max("n") + 1 - F.max("last_start")
        ).alias("streak"),
    )


def _default_changes(rows: DataFrame, limit: int, made: list[str]) -> DataFrame:
    """cf_il, il_cf: products of successive defaults, inside the days of default and at their cuts."""
    c = F.col
    rows = _in_chunks(rows.where("d").select(NUM, "dflt", *HOT_SEQ), "dflt", limit, made)
    local = Window.partitionBy(*CHUNK).orderBy(*HOT_SEQ)
    rows = rows.select(*CHUNK, "p", F.row_number().over(local).alias("k"), F.lag("p").over(local).alias("before"))
    step = lambda before, p, a, b: (c(before) == a) & (c(p) == b)
    days = rows.groupBy(*CHUNK).agg(
        F.max(F.when(c("k") == 1, c("p"))).alias("first_p"),
        F.max_by("p", "k").alias("last_p"),
        F.count_if(step("before", "p", "cf", "il")).alias("cf_il"),
        F.count_if(step("before", "p", "il", "cf")).alias("il_cf"),
    )
    days = days.withColumn("p_before", F.lag("last_p").over(Window.partitionBy(NUM).orderBy("slot", "sub")))
    return days.groupBy(NUM).agg(
        (F.sum("cf_il") + F.count_if(step("p_before", "first_p", "cf", "il"))).alias("cf_il"),
        (F.sum("il_cf") + F.count_if(step("p_before", "first_p", "il", "cf"))).alias("il_cf"),
    )


def _aggregates() -> dict[str, Column]:
    """Aggregates of one pass over the annotated rows."""
    c = F.col
    credit, d, r, a = c("is_credit"), c("d"), c("r"), c("a")
    amt, age = c("amt"), c("age_m")
    last, first = c("rn") == c("n"), c("rn") == 1
    out: dict[str, Column] = {
        "n": F.count_if(credit),
        "nd": F.count_if(d),
        "nr": F.count_if(r),
        "na": F.count_if(a),
        "sum": F.sum("amt"),
        "avg": F.avg("amt"),
        "max": F.max("amt"),
        "min": F.min("amt"),
        "std": F.stddev_samp("amt"),
        "skew": F.skewness("amt"),
        "sumd": sum_if(d, amt),
        "suma": sum_if(a, amt),
        "avgd": F.avg(F.when(d, amt)),
        "maxd": F.max(F.when(d, amt)),
        "od_n": F.count_if(c("product") == "NON_AUTH_OVERDRAFT"),
        "od_amt": sum_if(c("product") == "NON_AUTH_OVERDRAFT", c("nc_amt")),
        "ol_n": F.count_if(c("product") == "OVERLIMIT"),
        "ol_amt": sum_if(c("product") == "OVERLIMIT", c("nc_amt")),
        "age_max": F.max("age_d"),
        "age_min": F.min("age_d"),
        # whole days are added, so the mean doesn't depend on the order of addition
        "age_avg": F.avg("age_d") / en.DAYS_PER_MONTH,
        "since_dflt": F.min(F.datediff("ref", "dflt")),
        "first_dflt": F.max(F.datediff("ref", "dflt")),
        "since_rec": F.min(F.datediff("ref", "rec")),
        "ttd_avg": F.avg("ttd"),
        "ttd_min": F.min("ttd"),
        "ttd_max": F.max("ttd"),
        "ttd_std": F.stddev_samp("ttd"),
        "rec_avg": F.avg("rec_d"),
        "rec_min": F.min("rec_d"),
        "rec_max": F.max("rec_d"),
        "n_mature": F.count_if(age > 24),
        "n_new": F.count_if(age < 6),
        # order of openings
        "transitions": F.count_if(credit & c("change") & (c("rn") > 1)),
        "streak": F.max(F.when(credit, c("rn") - c("run_start") + 1)),
        "mg_position": F.min(F.when(c("p") == "mg", c("rn"))),
        # amounts
        "n_small": F.count_if(amt < 5000),
        "n_large": F.count_if(amt > 50000),
        "n_vlarge": F.count_if(amt > 100000),
        "sum_large": sum_if(amt > 50000, amt),
        # bursts and gaps
        "c30": F.max(F.when(credit, c("c30"))),
        "c60": F.max(F.when(credit, c("c60"))),
        "c90": F.max(F.when(credit, c("c90"))),
        "a30": F.max("a30"),
        "a60": F.max("a60"),
        "month_peak": F.max(F.when(credit, c("in_month"))),
        "gap_min": F.min("gap"),
        "gap_max": F.max("gap"),
        "gap_sum": F.sum("gap"),
        "gap_sq": F.sum(c("gap").cast("bigint") * c("gap")),
        "n_rapid": F.count_if(c("gap") <= 14),
        "gap_last": F.max(F.when(last, c("gap"))),
        "day_first": F.min("day"),
        "day_last": F.max("day"),
        "day_half": F.max(
            F.when(c("rn") - 1 == F.floor((c("n") - 1) / 2), c("day"))
        ),
        # weights
        "age_amt": F.sum(age * amt),
        "age_amt_d": F.sum(F.when(d, age * amt)),
        "score_amt": F.sum(
            amt * F.expr(
                "CASE p " + " ".join(f"WHEN '{p}' THEN {s}" for p, s in PRODUCT_SCORE.items())
                + " END"
            )
        ),
        # relative size
        "amt_first": F.max(F.when(first, amt)),
        "amt_last": F.max(F.when(last, amt)),
        "recent_max": F.max(F.when(c("w6"), amt)),
        "recent_min": F.min(F.when(c("w6"), amt)),
        "sum_half": F.sum(F.when(c("rn") <= F.floor(c("n") / 2), amt)),
        "age_of_max": F.max(F.when(amt == c("amt_max"), c("age_d"))),
        "avg_prev": F.avg(F.when(~last, amt)),
        "std_prev": F.stddev_samp(F.when(~last, amt)),
        # time decay
        "w180_d": F.sum(F.when(d, F.exp(c("age_d") * (-0.693 / 180)))),
        "w180_damt": F.sum(F.when(d, amt * F.exp(c("age_d") * (-0.693 / 180)))),
        "w180": F.sum(F.exp(c("age_d") * (-0.693 / 180))),
        "w180_amt": F.sum(amt * F.exp(c("age_d") * (-0.693 / 180))),
        "n_180": F.count_if(c("age_d") <= 180),
        "w_amt": F.sum(amt / (1 + c("age_d") / 365.0)),
        "exp_damt": F.sum(F.when(d, amt * F.exp(-c("age_d") / 365.0))),
        "hl30": F.sum(amt * F.pow(F.lit(2.0), -c("age_d") / 30.0)),
        "hl90": F.sum(amt * F.pow(F.lit(2.0), -c("age_d") / 90.0)),
        # life cycle
        "after_r1": F.count_if(c("opening") > c("r1")),
        "open_after_r1": F.min(F.when(c("opening") > c("r1"), F.datediff("opening", "r1"))),
        "dflt_after_r1": F.count_if(c("dflt") > c("r1")),
        "dflt_day_min": F.min(F.unix_date("dflt")),
        "n_e90": F.count_if(c("ttd") <= 90),
        "n_e180": F.count_if(c("ttd") <= 180),
        "n_e365": F.count_if(c("ttd") <= 365),
        "sum_e180": sum_if(c("ttd") <= 180, amt),
        "cf_il": F.count_if((c("prev_dp") == "cf") & (c("p") == "il") & d),
        "il_cf": F.count_if((c("prev_dp") == "il") & (c("p") == "cf") & d),
        # around the application
        "n_before": F.count_if(c("age_d").between(1, 30)),
        "n_after": F.count_if(c("age_d").between(-30, -1)),
        "amt_before_app": sum_if(c("age_d").between(1, 30), amt),
        # payments
        "np": F.count("payment"),
        "pay_sum": sum_if(credit, c("payment")),
        "pay_avg": F.avg("payment"),
        "pay_max": F.max("payment"),
        "pay_min": F.min("payment"),
        "pay_std": F.stddev_samp("payment"),
        "pay_skew": F.skewness("payment"),
        "pay_active": sum_if(a & c("closure").isNull(), c("payment")),
        "pay_hi": F.count_if(c("payment") > 2000),
        "pay_lo": F.count_if(c("payment") < 500),
        "pay_tiny": F.count_if(c("payment") < 100),
        "pay_first": F.max(F.when((c("pay_rn") == 1) & c("payment").isNotNull(), c("payment"))),
        "pay_last": F.max(
            F.when((c("pay_rn") == c("np")) & c("payment").isNotNull(), c("payment"))
        ),
        "pay_slope": F.regr_slope(
            c("payment"), F.when(c("payment").isNotNull(), c("pay_rn")).cast("double")
        ),
        # closures
        "nc": F.count_if(c("closure").isNotNull()),
        "sumc": sum_if(c("closure").isNotNull(), amt),
        "nc_clean": F.count_if(c("closure").isNotNull() & c("dflt").isNull()),
        # durations
        "nu": F.count("duration"),
        "dur_avg": F.avg("duration"),
        "dur_max": F.max("duration").cast("double"),
        "dur_min": F.min("duration").cast("double"),
        "dur_sum": F.sum("duration").cast("double"),
        "dur_std": F.stddev_samp("duration"),
        "dur_squares": F.sum(c("duration").cast("bigint") * c("duration")),
        "dur_amt": F.sum(c("duration") * amt),
        "n_gt60": F.count_if(c("duration") > 60),
        "n_lt24": F.count_if(c("duration") < 24),
        "n_lt12": F.count_if(c("duration") < 12),
        "sumu": sum_if(c("duration").isNotNull(), amt),
        "n_long_big": F.count_if((c("duration") > 60) & (amt > 50000)),
    }
    for m in (3, 6, 12, 24):
        out[f"n_w{m}"] = F.count_if(c(f"w{m}"))
        out[f"sum_w{m}"] = sum_if(c(f"w{m}"), amt)
        out[f"nd_w{m}"] = F.count_if(c(f"w{m}") & d)
    for p in PRODUCTS:
        is_p = c("p") == p
        out[f"n_{p}"] = F.count_if(is_p)
        out[f"nd_{p}"] = F.count_if(is_p & d)
        out[f"sum_{p}"] = sum_if(is_p, amt)
        out[f"avg_{p}"] = F.avg(F.when(is_p, amt))
        out[f"ttd_min_{p}"] = F.min(F.when(is_p, c("ttd")))
        out[f"ttd_max_{p}"] = F.max(F.when(is_p, c("ttd")))
        out[f"ttd_avg_{p}"] = F.avg(F.when(is_p, c("ttd")))
        out[f"first_{p}"] = F.count_if(is_p & first)
        out[f"last_{p}"] = F.count_if(is_p & last)
        out[f"day_first_{p}"] = F.min(F.when(is_p, c("day")))
        out[f"day_last_{p}"] = F.max(F.when(is_p, c("day")))
        out[f"pay_{p}"] = sum_if(is_p, c("payment"))
    for m in range(1, 13):
        out[f"m{m}"] = F.count_if(F.month("opening") == m)
    for i, (lo, hi) in enumerate([(None, 1000), (1000, 10000), (10000, 50000), (50000, None)]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (amt >= lo)
        if hi is not None:
            cond = cond & (amt < hi)
        out[f"tier{i}"] = F.count_if(cond & amt.isNotNull())
        out[f"tier{i}_d"] = F.count_if(cond & d)
    span = c("amt_max") - c("amt_min")
    slot = F.when(span > 0, F.greatest(F.ceil((amt - c("amt_min")) / span * 5), F.lit(1)))
    for b in range(1, 6):
        out[f"slot{b}"] = F.count_if(F.coalesce(slot, F.lit(1)).eqNullSafe(b) & amt.isNotNull())
    rem = F.greatest(c("duration") - age, F.lit(0.0))
    term = c("duration").isNotNull()
    live = term & c("closure").isNull() & c("dflt").isNull()
    pay0 = F.coalesce(c("payment"), F.lit(0.0))
    out.update(
        {
            "nt": F.count_if(live),
            "rem_avg": F.avg(F.when(live, rem)),
            "rem_max": F.max(F.when(live, rem)),
            "rem_min": F.min(F.when(live, rem)),
            "rem_sum": F.sum(F.when(live, rem)),
            "rem_amt": F.sum(F.when(live, rem * amt)),
            "sumt": sum_if(live, amt),
            "nt_3": F.count_if(live & (rem <= 3)),
            "nt_6": F.count_if(live & (rem <= 6)),
            "nt_12": F.count_if(live & (rem <= 12)),
            "sumt_3": sum_if(live & (rem <= 3), amt),
            "sumt_6": sum_if(live & (rem <= 6), amt),
            "future_pay": sum_if(term, rem * pay0),
            "past_pay": sum_if(term, age * pay0),
        }
    )
    return out


def _cold_distribution() -> dict[str, Column]:
    """Order statistics as aggregates over the rank columns of `_cold_rows`."""
    c = F.col

    def quantile(before, n, value, p):
        pos = (c(n) - 1) * F.lit(p)
        low = F.max(F.when(c(before) == F.floor(pos), c(value)))
        high = F.max(F.when(c(before) == F.ceil(pos), c(value)))
        return (low + high) / 2

    fence = 1.5 * (c("q3") - c("q1"))
    return {
        "amt_med": quantile("amt_before", "n_amt", "amt", 0.5),
        "pay_med": quantile("pay_before", "np", "payment", 0.5),
        "gap_med": quantile("gap_before", "n_gap", "gap", 0.5),
        "n_iqr_out": F.count_if((c("amt") < c("q1") - fence) | (c("amt") > c("q3") + fence)),
        "n_below_last": F.count_if(c("amt") < c("latest")),
        "top2": F.sum(F.when(c("amt_before") >= c("n_amt") - 2, c("amt"))),
        "top3": F.sum(F.when(c("amt_before") >= c("n_amt") - 3, c("amt"))),
    }


def _whole_distribution(rows: DataFrame, names: list[str]) -> DataFrame:
    """The named columns of `_cold_distribution`, of applicants whose values of a column fit a task."""
    w = Window.partitionBy(NUM)
    rank = lambda x: F.row_number().over(w.orderBy(F.asc_nulls_last(x))) - 1
    columns = {}
    if "amt" in rows.columns:
        columns |= {"amt_before": rank("amt"), "n_amt": F.count("amt").over(w)}
    if "payment" in rows.columns:
        columns |= {"pay_before": rank("payment"), "np": F.count("payment").over(w)}
    rows = rows.withColumns(columns)
    if "n_iqr_out" in names:
        quarter = lambda p: _quantile_over("amt_before", "n_amt", "amt", p, w)
        rows = rows.withColumns({"q1": quarter(0.25), "q3": quarter(0.75)})
    aggs = _cold_distribution()
    return rows.groupBy(NUM).agg(*[aggs[k].alias(k) for k in names])


def _ranged_distribution(rows: DataFrame, names: list[str]) -> DataFrame:
    """The same, of applicants of any size, from frequency tables."""
    c = F.col
    out = rows.select(NUM).distinct()
    if "pay_med" in names:
        q = ranking.quantiles(rows, [NUM], "payment", [0.5])
        out = out.join(q.select(NUM, c("q")[0].alias("pay_med")), NUM, "left")
    if {"amt_med", "n_iqr_out"} & {*names}:
        q = ranking.quantiles(rows, [NUM], "amt", [0.25, 0.5, 0.75])
        q = q.select(NUM, *[c("q")[i].alias(k) for i, k in enumerate(["q1", "amt_med", "q3"])])
        fence = 1.5 * (c("q3") - c("q1"))
        far = (c("amt") < c("q1") - fence) | (c("amt") > c("q3") + fence)
        counts = rows.select(NUM, "amt").join(F.broadcast(q), NUM).groupBy(NUM)
        counts = counts.agg(F.max("amt_med").alias("amt_med"), F.count_if(far).alias("n_iqr_out"))
        out = out.join(counts, NUM, "left")
    if {"top2", "top3"} & {*names}:
        # row_number() <= 3 is limited on the map side before the shuffle
        place = F.row_number().over(Window.partitionBy(NUM).orderBy(F.desc("amt"), F.desc("tid")))
        top = rows.select(NUM, "amt", place.alias("k")).where(c("k") <= 3).groupBy(NUM)
        top = top.agg(F.sum(F.when(c("k") <= 2, c("amt"))).alias("top2"), F.sum("amt").alias("top3"))
        out = out.join(top, NUM, "left")
    return out.select(NUM, *names)


def _hot_distribution(rows: DataFrame, names: list[str], limit: int = ranking.MAX_GROUP) -> DataFrame:
    """The named columns of `_cold_distribution` for over-full applicants.

    A column's values and the numbers of their applicants are narrow, so more of them fit a task.
    """
    sizes = rows.groupBy(NUM).agg(F.count("*").alias("k"))
    larger = sizes.where(F.col("k") > limit).select(NUM)
    if larger.isEmpty():
        return _whole_distribution(rows, names)
    larger = F.broadcast(larger)
    whole = _whole_distribution(rows.join(larger, NUM, "left_anti"), names)
    return whole.unionByName(_ranged_distribution(rows.join(larger, NUM, "left_semi"), names))


def _finish(profile: DataFrame) -> DataFrame:
    skews = {"skew": "n", "pay_skew": "np"}
    return profile.withColumns(
        {k: adjusted_skewness(F.col(k), F.col(n)) for k, n in skews.items() if k in profile.columns}
    )


def dated_rows(apps: DataFrame, bureau: DataFrame) -> DataFrame:
    """Enriched tradelines of known applicants, co-located by applicant in one exchange.

    The partition count is explicit: each input row feeds hundreds of aggregates, so merging
    partitions that look small in bytes would only take away parallelism.
    """
    parts = int(bureau.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bureau = en.with_optional_columns(bureau).repartition(parts, *KEY)
    return en.enrich(en.attach_application_date(bureau, apps))


def applicant_profile(
    apps: DataFrame,
    bureau: DataFrame,
    max_rows_per_key: int = en.MAX_ROWS_PER_KEY,
    found: en.HotKeys | None = None,
    exprs: list[Column] | None = None,
) -> DataFrame:
    """One row per applicant with tradelines: KEY and all base aggregates, or those that exprs read.

    found: the over-full applicants, if known.
    """
    found = found or en.hot_keys(bureau, KEY, max_rows_per_key)
    cold, over = en.split_hot(bureau, found.keys)
    aggs = {**_aggregates(), **_cold_distribution()}
    if exprs is not None:
        need = _used(exprs, aggs)
        need |= {n for k, n in (("skew", "n"), ("pay_skew", "np")) if k in need}
        aggs = {k: e for k, e in aggs.items() if k in need} or {"n": aggs["n"]}
    profile = (
        _cold_rows(dated_rows(apps, cold)).groupBy(*KEY).agg(*[e.alias(k) for k, e in aggs.items()])
    )
    if over is not None:
        profile = profile.unionByName(_hot_profile(apps, bureau, found.keys, set(aggs), max_rows_per_key))
    return _finish(profile)


def _hot_profile(
    apps: DataFrame, bureau: DataFrame, hot: DataFrame, need: set[str], limit: int
) -> DataFrame:
    """The needed aggregates of over-full applicants.

    Their keys are numbered, and their rows are written once with that number and the columns that the
    aggregates read. What knows no order comes from them directly, what knows only days from the chunk
    table, and only the rest from rows that meet their chunk. The result is a row an applicant; once it
    is written, the tables before it are removed.
    """
    c = F.col
    made: list[str] = []
    numbered = hot.join(apps.select(*KEY), KEY, "left_semi")
    numbered = _written(numbered.withColumn(NUM, F.monotonically_increasing_id()), made)
    aggs = {k: e for k, e in _aggregates().items() if k in need}
    aggs |= {"n_below_last": F.count_if(c("amt") < c("latest"))} if "n_below_last" in need else {}
    runs, changes = need & {"transitions", "streak"}, need & {"cf_il", "il_cf"}
    by_day = {k: e for k, e in _day_aggregates().items() if k in need}
    aggs = {k: e for k, e in aggs.items() if k not in {*runs, *changes, *by_day}}
    placed = {k: e for k, e in aggs.items() if _used([e], IN_SEQUENCE)}
    plain = {k: e for k, e in aggs.items() if k not in placed}

    # inputs of the measures that are read, tie-breaks of the order included
    read = _used(aggs.values(), MEASURES) | ({"day"} if by_day else set())
    read |= {"amt"} if need & {"a30", "a60", "amt_med", "n_iqr_out", "top2", "top3"} else set()
    read |= {"payment"} if "pay_med" in need else set()
    read |= {"tid"} if need & {"top2", "top3"} else set()
    read |= {"day", *HOT_SEQ} if placed or runs else set()
    read |= {"dflt", *HOT_SEQ} if changes else set()
    read |= {"rec"} if _used(placed.values(), ["r1"]) else set()
    read |= {"payment"} if _used(placed.values(), ["np", "pay_rn"]) else set()
    inputs = {"product_type"}.union(*(MEASURES[x] for x in read))
    dated = apps.select(*KEY, "application_date").join(numbered, KEY)
    rows = en.with_optional_columns(bureau).join(dated, KEY)
    if not any(k.startswith(("od_", "ol_")) for k in need):
        rows = en.credit_only(rows)  # overdraft rows have no other measures
    rest = {x: F.lit(None).cast(t) for x, t in rows.dtypes if x not in (NUM, *KEY, *inputs)}
    rows = _written(rows.select(NUM, *sorted(inputs)), made).withColumns(rest)
    rows = en.enrich(rows, [NUM])
    # a measure whose inputs weren't written has no column, rather than NULLs
    rows = rows.select(NUM, *[x for x in MEASURES if MEASURES[x] <= inputs])

    parts = [rows.groupBy(NUM).agg(*[e.alias(k) for k, e in plain.items()])] if plain else []
    credit = rows.where("is_credit")
    chunked = credit
    if placed or runs:
        chunked = _in_chunks(credit, "opening", limit, made)
    elif by_day:
        chunked = credit.withColumns({"slot": F.coalesce(c("day"), F.lit(NO_DAY)), "sub": F.lit(0)})
    if placed or by_day:
        place = [c("rn_off")] if placed else []
        place += [c("pay_off")] if _used(placed.values(), ["pay_rn"]) else []
        chunks = _chunk_table(chunked, [*placed.values(), *by_day.values(), *place], made)
    if placed:
        parts.append(_in_sequence(chunked, chunks).groupBy(NUM).agg(*[e.alias(k) for k, e in placed.items()]))
    if by_day:
        parts.append(chunks.groupBy(NUM).agg(*[e.alias(k) for k, e in by_day.items()]))
    if runs:
        parts.append(_streaks(chunked))
    if changes:
        parts.append(_default_changes(credit, limit, made))
    out = numbered
    spread = need & {"amt_med", "pay_med", "n_iqr_out", "top2", "top3"}
    for part in [*parts, *([_hot_distribution(credit, sorted(spread))] if spread else [])]:
        out = out.join(part, NUM, "left")
    nullable = ("gap_sum", "gap_sq", "streak", "c30", "c60", "c90")
    kind = dict(out.dtypes)
    zero = lambda k: F.coalesce(k, F.lit(0)) if kind[k] == "bigint" and k not in nullable else c(k)
    found = _written(out.select(*KEY, *[zero(k).alias(k) for k in sorted(need)]), [])
    src.remove_artefacts(apps.sparkSession, made)
    return found
