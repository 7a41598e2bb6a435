"""Multiset comparison of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, NULL as '': the form in which CSV and JSON copies must agree."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                       for c in df.columns])


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``side`` and the surplus ``n``.

    Both directions come out of one signed count, so each side is shuffled once and equal rows
    cancel in the map tasks.
    """
    cols = left.columns
    signed = left.withColumn("_s", F.lit(1)).unionByName(right.withColumn("_s", F.lit(-1)))
    return (
        signed.groupBy(*cols).agg(F.sum("_s").alias("_n")).where(F.col("_n") != 0)
        .select(*cols, F.when(F.col("_n") > 0, "left_only").otherwise("right_only").alias("side"),
                F.abs("_n").alias("n"))
    )


def multiset_equal(left: DataFrame, right: DataFrame) -> bool:
    return multiset_diff(left, right).isEmpty()
