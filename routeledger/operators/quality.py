"""Key statistics, value counts, spans and reference checks over feed tables.

Every statistic first collapses rows to one line per (group, key): partial aggregation absorbs a
hot key before the shuffle, and no distinct aggregate is needed afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from routeledger.functions import gtfs
from routeledger.vocab import WEEKDAYS


def key_counts(df: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """One row per (by, keys) with its row count ``n`` and whether any key part is blank."""
    blank: Column = F.lit(False)
    for k in keys:
        blank = blank | F.coalesce(gtfs.is_blank(F.col(k)), F.lit(True))
    return df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n")).withColumn("blank", blank)


def id_stats(df: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """(by, row_count, blank_count, unique_count, duplicate_count) of a single or composite key.

    A row with any blank part is blank; uniqueness compares raw values; every repeat of a key
    after its first row counts as a duplicate.
    """
    n = F.col("n")
    unique = F.count_if(~F.col("blank"))
    return key_counts(df, by, keys).groupBy(*by).agg(
        F.sum(n).alias("row_count"),
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank_count"),
        unique.alias("unique_count"),
        (F.sum(F.when(F.col("blank"), 0).otherwise(n)) - unique).alias("duplicate_count"),
    )


def duplicate_rows(df: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """Every row whose non-blank key already occurred at a smaller ``row_idx``.

    Keys that repeat are found by aggregation; only then do their rows meet them again in an
    inner join, which AQE can split when one key holds a large share of the rows.
    """
    cols = [*by, *keys]
    nonblank = F.lit(True)
    for k in keys:
        nonblank = nonblank & ~gtfs.is_blank(F.col(k))
    rows = df.where(nonblank).select(*cols, "row_idx")
    repeated = rows.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("n"), F.min("row_idx").alias("first_row_idx")
    ).where(F.col("n") > 1).drop("n")
    return rows.join(repeated, cols).where(F.col("row_idx") > F.col("first_row_idx"))


def second_occurrence(df: DataFrame, cols: list[str]) -> DataFrame:
    """First and second row per key with ``rn`` 1 or 2.

    The filter on row_number lets Spark keep at most two rows per key in each map task, so a key
    holding a third of the table still shuffles only a handful of rows. Put the most selective
    column first: it leads the sort.
    """
    w = Window.partitionBy(*cols).orderBy("row_idx")
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= 2)


def value_counts(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """(by, value, n) with short cells counted as the empty value."""
    return (
        df.select(*by, F.coalesce(F.col(column), F.lit("")).alias("value"))
        .groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))
    )


def weekday_flag_counts(calendar: DataFrame) -> DataFrame:
    """(feed_id, day, value, n, is_valid): raw flag values per weekday, invalid ones included."""
    combos = calendar.groupBy("feed_id", *WEEKDAYS).agg(F.count(F.lit(1)).alias("k"))
    return (
        combos.unpivot(["feed_id", "k"], list(WEEKDAYS), "day", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feed_id", "day", "value").agg(F.sum("k").alias("n"))
        .withColumn("is_valid", F.col("value").isin("0", "1"))
    )


def calendar_span(calendar: DataFrame) -> DataFrame:
    """Rows, services (blank counted as a value), date span and invalid dates per feed."""
    start, end = gtfs.gtfs_date(F.col("start_date")), gtfs.gtfs_date(F.col("end_date"))
    per_service = calendar.groupBy("feed_id", "service_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(start).alias("lo"), F.max(end).alias("hi"),
        F.count_if(start.isNull()).alias("bad_start"), F.count_if(end.isNull()).alias("bad_end"),
    )
    return per_service.groupBy("feed_id").agg(
        F.sum("n").alias("row_count"),
        F.count("service_id").alias("service_id_unique_count"),
        F.min("lo").alias("min_start_date"), F.max("hi").alias("max_end_date"),
        (F.sum("bad_start") + F.sum("bad_end")).alias("invalid_date_count"),
    )


def invalid_calendar_dates(calendar: DataFrame) -> DataFrame:
    """(feed_id, row_idx, column, raw_value) for each malformed calendar date."""
    return calendar.unpivot(
        ["feed_id", "row_idx"], ["start_date", "end_date"], "column", "raw_value"
    ).where(gtfs.gtfs_date(F.col("raw_value")).isNull())


def exception_span(calendar_dates: DataFrame) -> DataFrame:
    """Added and removed date spans kept apart, per feed."""
    d = gtfs.gtfs_date(F.col("date"))
    added, removed = F.col("exception_type") == "1", F.col("exception_type") == "2"
    per_service = calendar_dates.groupBy("feed_id", "service_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(added, d)).alias("a0"), F.max(F.when(added, d)).alias("a1"),
        F.min(F.when(removed, d)).alias("r0"), F.max(F.when(removed, d)).alias("r1"),
        F.count_if(d.isNull()).alias("bad"),
    )
    return per_service.groupBy("feed_id").agg(
        F.sum("n").alias("row_count"), F.count("service_id").alias("service_id_unique_count"),
        F.min("a0").alias("added_date_min"), F.max("a1").alias("added_date_max"),
        F.min("r0").alias("removed_date_min"), F.max("r1").alias("removed_date_max"),
        F.sum("bad").alias("invalid_date_count"),
    )


def feed_info_first_row(feed_info: DataFrame) -> DataFrame:
    """Dates and version of the first data row; a blank date is absent, a bad one an issue."""
    first = feed_info.where(F.col("row_idx") == 0)

    def bad(c: str) -> Column:
        return (F.coalesce(F.col(c), F.lit("")) != "") & gtfs.gtfs_date(F.col(c)).isNull()

    return first.select(
        "feed_id",
        gtfs.gtfs_date(F.col("feed_start_date")).alias("feed_start_date"),
        gtfs.gtfs_date(F.col("feed_end_date")).alias("feed_end_date"),
        "feed_version",
        bad("feed_start_date").alias("bad_start_date"), bad("feed_end_date").alias("bad_end_date"),
    )


def fk_violations(
    routes: DataFrame, calendar: DataFrame, calendar_dates: DataFrame,
    trips: DataFrame, frequencies: DataFrame,
) -> DataFrame:
    """Dangling references: trips -> routes, trips -> calendars, frequencies -> trips.

    (rule_id, feed_id, key_value, row_count, first_row_idx). All references meet in one anti join:
    child rows collapse to one row per key before it, and each child table is read once.
    """
    def child(df: DataFrame, rules: dict[str, str]) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.col(c).alias("key_value"))
                         for r, c in rules.items()])
        return df.select("feed_id", "row_idx", F.explode(keys).alias("k")).select(
            "feed_id", "row_idx", "k.*")

    def parent(df: DataFrame, rule: str, column: str) -> DataFrame:
        return df.select(F.lit(rule).alias("rule_id"), "feed_id", F.col(column).alias("key_value"))

    keys = child(
        trips, {"trips.route_id": "route_id", "trips.service_id": "service_id"}
    ).unionByName(child(frequencies, {"frequencies.trip_id": "trip_id"})).groupBy(
        "key_value", "feed_id", "rule_id"
    ).agg(F.count(F.lit(1)).alias("row_count"), F.min("row_idx").alias("first_row_idx"))
    known = (
        parent(routes, "trips.route_id", "route_id")
        .unionByName(parent(calendar, "trips.service_id", "service_id"))
        .unionByName(parent(calendar_dates, "trips.service_id", "service_id"))
        .unionByName(parent(trips, "frequencies.trip_id", "trip_id")).distinct())
    return keys.join(known, ["key_value", "feed_id", "rule_id"], "left_anti").select(
        "rule_id", "feed_id", "key_value", "row_count", "first_row_idx")


def service_crosscheck(
    trips: DataFrame, calendar: DataFrame, calendar_dates: DataFrame
) -> DataFrame:
    """Service ids on one side only: (feed_id, service_id, side)."""
    ids = trips.select("feed_id", "service_id", F.lit(1).alias("side")).unionByName(
        calendar.select("feed_id", "service_id", F.lit(2).alias("side"))
    ).unionByName(calendar_dates.select("feed_id", "service_id", F.lit(2).alias("side")))
    return (
        ids.groupBy("feed_id", "service_id").agg(F.bit_or("side").alias("sides"))
        .where(F.col("sides") != 3)
        .select(
            "feed_id", "service_id",
            F.when(F.col("sides") == 1, "trips_only").otherwise("calendar_only").alias("side"),
        )
    )


def stops_by_route(trips: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Trips and distinct stops served per (feed, route), stops limited to known ones."""
    served = stop_times.select("feed_id", "trip_id", "stop_id").join(
        trips.select("feed_id", "trip_id", "route_id"), ["feed_id", "trip_id"]
    )
    per_stop = served.groupBy("feed_id", "route_id", "stop_id").agg(
        F.count(F.lit(1)).alias("calls")
    ).join(stops.select("feed_id", "stop_id"), ["feed_id", "stop_id"], "left_semi")
    stop_side = per_stop.groupBy("feed_id", "route_id").agg(
        F.count(F.lit(1)).alias("stop_count"), F.sum("calls").alias("call_count")
    )
    trip_side = trips.groupBy("feed_id", "route_id").agg(F.count(F.lit(1)).alias("trip_count"))
    return trip_side.join(stop_side, ["feed_id", "route_id"], "left").select(
        "feed_id", "route_id", "trip_count",
        F.coalesce("stop_count", F.lit(0)).alias("stop_count"),
        F.coalesce("call_count", F.lit(0)).alias("call_count"),
    )


def stops_by_area(stops: DataFrame, stop_area: DataFrame) -> DataFrame:
    """Stop ids and distinct stop names per municipality, through a given stop -> area table."""
    joined = stops.select("feed_id", "stop_id", "stop_name").join(
        stop_area, ["feed_id", "stop_id"]
    )
    per_name = joined.groupBy("municipality", "stop_name").agg(F.count(F.lit(1)).alias("n"))
    return per_name.groupBy("municipality").agg(
        F.sum("n").alias("stop_id_count"), F.count("stop_name").alias("stop_name_count")
    )


def anchor_check(routes: DataFrame, anchors: DataFrame, file_status: DataFrame | None = None) -> DataFrame:
    """Required (feed, route_id, name) pairs against the route table, compared stripped.

    A feed whose route table has a blank or a repeated id anywhere fails all of its pairs, and, where
    ``file_status`` gives the headers, so does a feed whose routes lack one of the two columns. A route
    without a name is not the required one.
    """
    found = routes.groupBy("feed_id", gtfs.strip(F.col("route_id")).alias("route_id")).agg(
        F.min(gtfs.strip(F.col("route_long_name"))).alias("actual_name"),
        F.count(F.lit(1)).alias("n"),
    )
    no_id = F.coalesce("route_id", F.lit("")) == ""
    whole = found.groupBy("feed_id").agg(
        F.bool_or(no_id).alias("blank"), F.bool_or(~no_id & (F.col("n") > 1)).alias("repeated"))
    if file_status is not None:
        lacks = ~(F.array_contains("header", "route_id") & F.array_contains("header", "route_long_name"))
        headers = file_status.where((F.col("file_name") == "routes.txt") & F.col("present")).select(
            "feed_id", F.coalesce(lacks, F.lit(True)).alias("short"))
        whole = whole.join(headers, "feed_id", "full_outer")
    else:
        whole = whole.withColumn("short", F.lit(False))
    reason = (
        F.when(F.col("short"), "missing_column")
        .when(F.col("blank"), "blank_route_id")
        .when(F.col("repeated"), "duplicate_route")
        .when(F.col("n").isNull(), "missing_route")
        .when(F.col("actual_name").isNull(), "missing_name")
        .when(F.col("actual_name") != F.col("expected_name"), "name_mismatch")
    )
    return anchors.join(found, ["feed_id", "route_id"], "left").join(whole, "feed_id", "left").select(
        "feed_id", "route_id", "expected_name", "actual_name", reason.alias("reason")
    )
