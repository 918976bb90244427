"""Reading, renaming, splitting and writing of the two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bureauflow.functions.expressions import stable_hash
from bureauflow.operators.enrich import with_optional_columns
from bureauflow.schema import KEY

APPLICATION_COLUMNS = [*KEY, "application_date", "applicant_type", "target"]
TRADELINE_COLUMNS = [
    *KEY,
    "product_type",
    "total_amount",
    "opening_date",
    "default_date",
    "recovery_date",
    "monthly_payment",
    "remaining_term_months",
    "closure_date",
    "duration_months",
    "tradeline_id",
]
DATE_COLUMNS = ["opening_date", "default_date", "recovery_date", "closure_date"]
MAX_IN_LIST = 1000


def read_files(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Parquet or CSV files; CSV takes a schema so that it is read once, without inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        return reader.csv(path, header=True)
    return reader.format(fmt).load(path)


def read(
    source: DataFrame,
    columns: list[str] | None = None,
    condition: str | None = None,
    sample_fraction: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """Pruned, filtered and optionally sampled scan; both push down to the files."""
    df = source.where(condition) if condition else source
    df = df.select(*columns) if columns else df
    if sample_fraction and 0 < sample_fraction < 1:
        df = df.sample(fraction=sample_fraction, seed=seed)
    return df


def read_with_values(
    source: DataFrame, column: str, values: list | DataFrame, condition: str | None = None
) -> DataFrame:
    """Rows whose column is in a list. Long lists and key tables become a semi join."""
    df = read(source, condition=condition)
    if isinstance(values, list):
        if len(values) <= MAX_IN_LIST:
            return df.where(F.col(column).isin(values))
        values = source.sparkSession.createDataFrame(
            [(v,) for v in values], T.StructType([source.schema[column]])
        )
    return df.join(values.select(column).distinct(), column, "left_semi")


def read_with_dates(
    source: DataFrame, column: str, start: str, end: str, condition: str | None = None
) -> DataFrame:
    """Rows with start <= column <= end."""
    day = lambda s: F.lit(s).cast("date")
    return read(source, condition=condition).where(F.col(column).between(day(start), day(end)))


def read_applications(
    source: DataFrame,
    sample_fraction: float | None = None,
    date_range: tuple[str, str] | None = None,
) -> DataFrame:
    df = read_with_dates(source, "application_date", *date_range) if date_range else source
    return read(df, sample_fraction=sample_fraction)


def read_credit_bureau(
    source: DataFrame,
    application_ids: list | DataFrame | None = None,
    sample_fraction: float | None = None,
) -> DataFrame:
    df = source
    if application_ids is not None:
        df = read_with_values(df, "application_id", application_ids)
    return with_optional_columns(read(df, sample_fraction=sample_fraction))


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename; sources that do not exist are ignored."""
    return df.withColumnsRenamed(mapping)


def split_joined(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A pre-joined table back into distinct applications and their tradelines."""
    have = lambda cols: [c for c in cols if c in joined.columns]
    apps = joined.select(*have(APPLICATION_COLUMNS)).distinct()
    bureau = joined.select(*have(TRADELINE_COLUMNS)).where(F.col("product_type").isNotNull())
    return apps, bureau


def coerce_dates(df: DataFrame, columns: list[str] = DATE_COLUMNS) -> DataFrame:
    """Dates from text or timestamps; what does not parse becomes NULL."""
    casts = {c: F.expr(f"try_cast({c} as date)") for c in columns if c in df.columns}
    return df.withColumns(casts) if casts else df


def write(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Snappy-compressed output, optionally partitioned into directories."""
    out = df.write.mode(mode).format(fmt).option("compression", "snappy")
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.save(path)


def bounded(df: DataFrame, max_rows: int, by: list[str], seed: int = 42) -> DataFrame:
    """At most max_rows rows: the first by a hash of the columns `by`, the same in every run."""
    order = stable_hash(*[F.col(x) for x in by], seed=seed)
    return df.withColumn("_order", order).orderBy("_order", *by).limit(max_rows).drop("_order")


def artefact_folder(spark: SparkSession, name: str) -> str:
    """Folder for bins, baselines and other result tables under spark.checkpoint.dir.

    A local session without that setting gets a temporary one; a cluster must have it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}"


def save_artefact(df: DataFrame, path: str) -> None:
    write(df, path)


def load_artefact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def remove_artefacts(spark: SparkSession, paths: list[str]) -> None:
    """Deletes result tables, by the file system that they are in."""
    for path in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
