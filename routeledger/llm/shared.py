"""Where the corpus operators keep intermediate tables, and small column helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir.

    Only a local session may do without the setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def landed(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df written to the shared folder and read back: lineage ends, lost executors cost only their tasks."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, by: str, n: int) -> DataFrame:
    """df written to the shared folder in n buckets by a column: later groupings by it move only what they meet.

    As a landed table it outlives its executors; its name leaves the catalogue at once, its files stay.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{table}"
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, by).saveAsTable(table)
    out = spark.table(table)
    out.schema  # noqa: B018  # resolved before the name goes
    spark.sql(f"DROP TABLE {table}")
    return out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty; other columns, whatever their names, stay outside.

    Rows without an id cannot be referred to and are left out.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where(F.col("doc_id").isNotNull())
