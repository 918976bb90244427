"""Train, test and out-of-time assignment as a `split` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauflow.functions import ranking
from bureauflow.functions.expressions import quarter_label, stable_hash

c = F.col


def _oot(date: str):
    return F.concat(F.lit("oot_"), quarter_label(c(date)))


def stratified_split(
    df: DataFrame,
    train_end: str,
    date: str = "date",
    target: str = "target",
    uid: str = "uid",
    test_size: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Rows up to train_end: the test share of every class by hash order, the rest train.

    Later rows are out-of-time by quarter. The hash makes the split repeatable for any partitioning;
    the size of the test set is exact per class.
    """
    cut = F.lit(train_end).cast("date")
    hashed = df.withColumn("_h", stable_hash(c(uid), seed=seed))
    k = F.floor(c("n_total") * test_size + 0.5)
    inside = ranking.first_k(hashed.where(c(date) <= cut), "_h", uid, k, [target])
    split = F.when(c("selected"), "test").otherwise("train")
    train = inside.withColumn("split", split).drop("selected", "_h")
    return train.unionByName(df.where(c(date) > cut).withColumn("split", _oot(date)))


def temporal_split(
    df: DataFrame, train_end: str, date: str = "date", uid: str = "uid", test_size: float = 0.2
) -> DataFrame:
    """As above, but the test set is the latest part of the training period in (date, uid) order."""
    cut = F.lit(train_end).cast("date")
    k = F.floor(c("n_total") * (1 - test_size))
    inside = ranking.first_k(df.where(c(date) <= cut), date, uid, k)
    split = F.when(c("selected"), "train").otherwise("test")
    train = inside.withColumn("split", split).drop("selected")
    return train.unionByName(df.where(c(date) > cut).withColumn("split", _oot(date)))


def random_split(
    df: DataFrame, test_size: float = 0.2, validation_size: float = 0.0, seed: int = 42,
    by: str = "uid",
) -> DataFrame:
    """train / test / validation labels by a hash of the id: the same in every run and partitioning."""
    r = stable_hash(c(by), seed=seed) / F.lit(float(1 << 60))
    split = (
        F.when(r < test_size, "test")
        .when(r < test_size + validation_size, "validation")
        .otherwise("train")
    )
    return df.withColumn("split", split)


def validate_target(df: DataFrame, target: str = "target", min_rows: int = 100) -> None:
    """Raise unless the target is 0/1 with both classes and there are enough rows."""
    row = df.agg(
        F.count("*").alias("n"),
        F.count_if(c(target) == 0).alias("zero"),
        F.count_if(c(target) == 1).alias("one"),
        F.count(target).alias("known"),
    ).first()
    if row["n"] < min_rows:
        raise ValueError(f"training period has only {row['n']} rows, need {min_rows}")
    if row["zero"] + row["one"] != row["known"]:
        raise ValueError("target must be binary (0/1)")
    if not row["zero"] or not row["one"]:
        raise ValueError("target has only one class")


def split_metadata(df: DataFrame, target: str = "target", date: str = "date") -> DataFrame:
    """Rows, bads, bad rate and date range per split."""
    return df.groupBy("split").agg(
        F.count("*").alias("n"),
        F.sum(c(target).cast("bigint")).alias("n_bads"),
        F.avg(target).alias("bad_rate"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def split_index(df: DataFrame, uid: str = "uid") -> DataFrame:
    return df.select(uid, "split")


def feature_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    """Everything that is not an id, a meta column, the target or the date."""
    return [x for x in df.columns if x not in set(exclude)]
