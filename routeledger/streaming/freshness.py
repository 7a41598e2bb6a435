"""Weekly freshness counts on a stream of fetch observations.

Observations arrive as files. Duplicates of one fetch are dropped inside the watermark, late rows
are dropped by it, and state is bounded by it: one entry per recent fetch and one counter per open
week and status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATENESS = "1 day"
WEEK = "7 days"
# tumbling windows count from the epoch, a Thursday; this shift makes them start on Mondays
MONDAY = "4 days"


def weekly_counts(observations: DataFrame) -> DataFrame:
    """Batch form: (week_start, status, n) over distinct (source_id, checked_at)."""
    once = observations.dropDuplicates(["source_id", "checked_at"])
    return once.groupBy(F.window("checked_at", WEEK, WEEK, MONDAY).alias("w"), "status").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.to_date("w.start").alias("week_start"), "status", "n")


def weekly_counts_stream(observations: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Streaming form over an unbounded ``observations`` frame, for append or update output."""
    once = observations.withWatermark("checked_at", lateness).dropDuplicatesWithinWatermark(
        ["source_id", "checked_at"])
    return once.groupBy(F.window("checked_at", WEEK, WEEK, MONDAY).alias("w"), "status").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.to_date("w.start").alias("week_start"), "status", "n")


def run_available(
    spark: SparkSession, observations: DataFrame, output: str, checkpoint: str,
    lateness: str = LATENESS,
) -> None:
    """Process everything that has arrived; each batch writes the counters that it changed.

    A batch has a folder of its own, so a batch that runs again after a failure replaces what it
    wrote. Output and checkpoint must be on shared storage; ``current`` reads the output.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    query = (
        weekly_counts_stream(observations, lateness).writeStream.outputMode("update")
        .foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()


def current(spark: SparkSession, output: str) -> DataFrame:
    """(week_start, status, n) as of the last batch, open weeks included; counters only grow."""
    rows = spark.read.schema("week_start date, status string, n bigint, batch bigint").parquet(output)
    return rows.groupBy("week_start", "status").agg(F.max("n").alias("n"))
