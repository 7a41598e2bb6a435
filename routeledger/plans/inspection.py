"""Feed inspection report: structural facts of every feed in one long table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.operators import quality


def _long(df: DataFrame, section: str, items: list[str]) -> DataFrame:
    """Turn the item columns of a per-feed table into (feed_id, section, item, value) rows."""
    cells = F.array(*[
        F.struct(F.lit(i).alias("item"), F.col(i).cast("string").alias("value")) for i in items
    ])
    return df.select("feed_id", F.explode(cells).alias("x")).select(
        "feed_id", F.lit(section).alias("section"), "x.item", "x.value")


def feed_inspection(
    core: dict[str, DataFrame], calendar: DataFrame, calendar_dates: DataFrame
) -> DataFrame:
    """Key statistics per core file, value counts, date spans and the service cross-check.

    ``core`` maps a core file name to its table. Facts a feed has no rows for are absent, not 0.
    """
    stats = ["row_count", "blank_count", "unique_count", "duplicate_count"]
    parts = [
        _long(quality.id_stats(df, ["feed_id"], list(V.PRIMARY_KEYS[name])), name, stats)
        for name, df in core.items()
    ]

    def counts(df: DataFrame, section: str, column: str) -> DataFrame:
        return quality.value_counts(df, ["feed_id"], column).select(
            "feed_id", F.lit(section).alias("section"),
            F.concat(F.lit(f"{column}="), "value").alias("item"),
            F.col("n").cast("string").alias("value"))

    span = ["row_count", "service_id_unique_count", "min_start_date", "max_end_date",
            "invalid_date_count"]
    dates = ["row_count", "service_id_unique_count", "added_date_min", "added_date_max",
             "removed_date_min", "removed_date_max", "invalid_date_count"]
    cross = quality.service_crosscheck(core["trips.txt"], calendar, calendar_dates)
    parts += [
        counts(core["stops.txt"], "stops.txt", "location_type"),
        counts(calendar_dates, "calendar_dates.txt", "exception_type"),
        _long(quality.calendar_span(calendar), "calendar.txt", span),
        _long(quality.exception_span(calendar_dates), "calendar_dates.txt", dates),
        cross.groupBy("feed_id", "side").agg(F.count(F.lit(1)).alias("n")).select(
            "feed_id", F.lit("service_ids").alias("section"), F.col("side").alias("item"),
            F.col("n").cast("string").alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts)
