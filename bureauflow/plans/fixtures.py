"""Credit-risk views derived from the TPC-H-style tables (see FIXTURES.md).

Amounts are rounded to whole currency units so that sums do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _app_no(key):
    return F.when(key % 14 == 1, key - 1).otherwise(key)


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    app_no = _app_no(c)
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("APP_"), app_no.cast("string")).alias("application_id"),
        F.concat(F.lit("CUST_"), c.cast("string")).alias("customer_id"),
        F.when(c % 14 == 1, "CO_APPLICANT").otherwise("PRIMARY").alias("applicant_type"),
        F.date_add(F.lit("1999-01-01").cast("date"), ((app_no * 37) % 900).cast("int")).alias(
            "application_date"
        ),
        F.when(F.col("c_acctbal") < 1000, 1).otherwise(0).alias("target"),
    )


def credit_bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tradelines; the application date follows from the customer key, so no join is needed."""
    c, o = F.col("o_custkey"), F.col("o_orderkey")
    app_no = _app_no(c)
    base = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("APP_"), app_no.cast("string")).alias("application_id"),
        F.concat(F.lit("CUST_"), c.cast("string")).alias("customer_id"),
        o.alias("tradeline_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "CASH_FACILITY")
        .when(F.col("o_orderpriority") == "2-HIGH", "INSTALLMENT_LOAN")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "INSTALLMENT_SALE")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "MORTGAGE")
        .when(o % 2 == 0, "NON_AUTH_OVERDRAFT")
        .otherwise("OVERLIMIT")
        .alias("product_type"),
        F.round("o_totalprice").alias("total_amount"),
        F.to_date("o_orderdate").alias("opening_date"),
        F.date_add(F.lit("1999-01-01").cast("date"), ((app_no * 37) % 900).cast("int")).alias(
            "_ref"
        ),
        "o_orderstatus",
        "o_orderpriority",
    ).where(F.col("opening_date") <= F.date_add("_ref", 30))
    dflt = F.when(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW"),
        F.date_add("opening_date", (30 + F.col("tradeline_id") % 335).cast("int")),
    )
    base = base.withColumn("default_date", F.when(dflt <= F.col("_ref"), dflt))
    rec = F.when(
        F.col("default_date").isNotNull() & (F.col("tradeline_id") % 2 == 0),
        F.date_add("default_date", (30 + F.col("tradeline_id") % 200).cast("int")),
    )
    duration = F.when(
        F.col("product_type").isin("INSTALLMENT_LOAN", "INSTALLMENT_SALE", "MORTGAGE"),
        (12 + F.col("tradeline_id") % 100).cast("int"),
    )
    return base.select(
        "application_id",
        "customer_id",
        "tradeline_id",
        "product_type",
        "total_amount",
        "opening_date",
        "default_date",
        F.when(rec <= F.col("_ref"), rec).alias("recovery_date"),
        duration.alias("duration_months"),
        (F.col("total_amount") / duration).alias("monthly_payment"),
        F.when(
            (F.col("o_orderstatus") == "O")
            & (F.col("tradeline_id") % 5 == 0)
            & F.col("default_date").isNull(),
            F.date_sub("_ref", (F.col("tradeline_id") % 90).cast("int")),
        ).alias("closure_date"),
    )


MODEL_FEATURES = [
    "o_totalprice",
    "c_acctbal",
    "n_lines",
    "sum_qty",
    "avg_discount",
    "avg_tax",
    "sum_price",
    "const_1",
    "signal",
]


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: nine numeric features with real missing values, target, date, score."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").cast("double").alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.round(F.avg("l_discount"), 6).alias("avg_discount"),
            F.round(F.avg("l_tax"), 6).alias("avg_tax"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        )
    )
    target = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    signal = (target * (F.col("o_orderkey") % 7) + F.col("o_orderkey") % 11).cast("double")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("uid"),
            F.to_date("o_orderdate").alias("date"),
            target.alias("target"),
            F.col("c_mktsegment").alias("segment"),
            "o_totalprice",
            "c_acctbal",
            "n_lines",
            "sum_qty",
            "avg_discount",
            "avg_tax",
            "sum_price",
            F.lit(1.0).alias("const_1"),
            signal.alias("signal"),
            ((signal + 1) / 20.0).alias("score"),
        )
    )
