"""Running values over ordered groups that stay balanced when one group is huge.

Rows are range partitioned over (group, order), so a group's rows spread evenly whatever its size and
however far apart its keys are. What a partition holds of a group is a segment; counts and carries of
segments are a small table, and only that table is ordered as a whole per group.

Landed rows look small by their compressed files, so the joins name the merge join: broadcast, the wide rows
would all be held by every task, and one task would do what follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from routeledger.session import shared_folder


def segmented(df: DataFrame, by: list[str], order: str, parts: int | None = None) -> DataFrame:
    """df with ``_seg``, its range partition by (by, order), and ``_at``, ascending by order in it.

    The rows are landed, so that a lost executor cannot lead to other partition bounds. Rows with equal
    keys stand in any order, but in one that no later step changes.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_folder(spark, "ordered")
    at = F.monotonically_increasing_id()
    rows = df.repartitionByRange(parts, *by, order).sortWithinPartitions(*by, order).withColumn("_at", at)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path).withColumn("_seg", F.shiftright("_at", 33).cast("int"))


def _before(by: list[str]) -> Window:
    return Window.partitionBy(*by).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)


def running_max(
    df: DataFrame, by: list[str], order: str, value: Column, name: str, parts: int | None = None
) -> DataFrame:
    """Largest non-NULL ``value`` up to and including each row."""
    rows = segmented(df.withColumn("_v", value), by, order, parts)
    carry = (
        rows.groupBy(*by, "_seg").agg(F.max("_v").alias("_m"))
        .withColumn("_carry", F.max("_m").over(_before(by))).drop("_m"))
    inside = Window.partitionBy(*by, "_seg").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn(name, F.max("_v").over(inside)).join(carry.hint("merge"), [*by, "_seg"])
        .withColumn(name, F.coalesce(name, "_carry"))
        .drop("_v", "_seg", "_at", "_carry"))


def numbered(
    df: DataFrame, by: list[str], order: str, name: str, parts: int | None = None
) -> DataFrame:
    """1..n by ``order`` within each group: the place in the segment after what earlier segments hold."""
    rows = segmented(df, by, order, parts)
    offset = (
        rows.groupBy(*by, "_seg").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_off", F.coalesce(F.sum("_n").over(_before(by)), F.lit(0)) - F.col("_low"))
        .drop("_n", "_low"))
    return (
        rows.join(offset.hint("merge"), [*by, "_seg"])
        .withColumn(name, F.col("_at") + F.col("_off") + 1).drop("_seg", "_at", "_off"))


def page_blocks(
    pages: DataFrame, by: str, order: str, anchor: Column, appendix: Column
) -> DataFrame:
    """Group pages into blocks: adds ``block_start`` and ``state``.

    An anchor page opens a block and the pages after it belong to it. An appendix page is dropped
    and closes the block. A page that no open block covers is an error.
    """
    kind = F.when(appendix, "appendix").when(anchor, "anchor")
    marked = pages.withColumn("_kind", kind)
    last = F.when(F.col("_kind").isNotNull(), F.struct(F.col(order), F.col("_kind")))
    out = running_max(marked, [by], order, last, "_last")
    open_block = F.col("_last._kind") == "anchor"
    return (
        out.withColumn("block_start", F.when(open_block, F.col(f"_last.{order}")))
        .withColumn(
            "state",
            F.when(F.col("_kind") == "appendix", "dropped").when(open_block, "block")
            .otherwise("error_continuation_without_start"))
        .drop("_kind", "_last"))
