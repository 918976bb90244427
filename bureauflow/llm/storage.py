"""Tables that cut lineage, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path under spark.checkpoint.dir. A local session without that setting gets one of its own; a cluster must have it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid4().hex}"


def written(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """rows, written as Parquet to the shared folder and read again: later steps don't depend on what made them."""
    spark = rows.sparkSession
    folder = folder or shared_folder(spark)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def remove(spark: SparkSession, *folders: str) -> None:
    """Deletes folders that written() made, by the file system that they are in."""
    jvm = spark.sparkContext._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
