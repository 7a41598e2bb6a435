"""Lenses: projections that turn the given star-schema tables into operator inputs.

The given tables carry no transit data, so every registered query reads one or more of these
projections over whole tables. Each has a twin in SQL (``lens_sql``); both use integer and date
arithmetic only.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.plans.feed_metrics import FeedTables

WEEK = [date(1996, 4, 1) + timedelta(days=i) for i in range(7)]


def _feed(key: str) -> Column:
    return F.concat(F.lit("F"), (F.col(key) % 4).cast("string"))


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _short_id(row: str) -> Column:
    """Order and line number of a row index."""
    return F.concat_ws("-", _text(F.call_function("div", F.col(row), F.lit(8))), _text(F.col(row) % 8))


def _clock(seconds: Column) -> Column:
    """Whole seconds as HH:MM:SS."""
    parts = [F.call_function("div", seconds, F.lit(3600)),
             F.call_function("div", seconds % 3600, F.lit(60)), seconds % 60]
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])


class Lens:
    """Operator inputs over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def spread(self, name: str, key: str, rows: int = 50_000) -> DataFrame:
        """A table whose rows each become many, dealt by key to as many tasks as its rows ask for.

        A file of one row group is read by one task, which would hold all that is made of it.
        """
        table = self.table(name)
        parts = -(-table.count() // rows)
        return table.repartition(parts, key) if parts > 1 else table

    # -- timetable -------------------------------------------------------------------------

    def feeds(self) -> DataFrame:
        return self.table("nation").select(_feed("n_nationkey").alias("feed_id")).distinct()

    def calendar(self) -> DataFrame:
        k = F.col("s_suppkey")
        start = F.date_add(F.lit(date(1995, 1, 1)), ((k * 13) % 700).cast("int"))
        end = F.date_add(F.lit(date(1997, 1, 1)), ((k * 29) % 900).cast("int"))
        return self.table("supplier").select(
            _feed("s_suppkey").alias("feed_id"), k.alias("row_idx"),
            _text(k).alias("service_id"), ((k * 37 + 11) % 128).cast("int").alias("mask"),
            start.alias("start_date"), end.alias("end_date"),
        )

    def calendar_text(self) -> DataFrame:
        """GTFS text form; some services have a flag 2 or a start date in the wrong form."""
        k = F.col("row_idx")
        flags = [
            F.when((k % 97 == 96) & F.lit(i == 0), "2").otherwise(
                _text(F.call_function("shiftright", F.col("mask"), F.lit(i)).bitwiseAND(1))
            ).alias(d)
            for i, d in enumerate(V.WEEKDAYS)
        ]
        start = F.date_format("start_date", "yyyyMMdd")
        bad = F.date_format("start_date", "yyyy-MM-dd")
        return self.calendar().select(
            "feed_id", "row_idx", "service_id", *flags,
            F.when(k % 49 == 48, bad).otherwise(start).alias("start_date"),
            F.date_format("end_date", "yyyyMMdd").alias("end_date"),
        )

    def calendar_dates(self) -> DataFrame:
        """Flag A adds a day, R removes it, N does either by order number."""
        li = self.table("lineitem")
        flag = F.col("l_returnflag")
        kind = F.when(flag == "A", 1).when(flag == "R", 2).otherwise(
            (1 + (F.col("l_orderkey") + F.col("l_suppkey")) % 2).cast("int"))
        d = F.to_date("l_shipdate")
        days = F.datediff(F.col("date"), F.lit(date(1990, 1, 1)))
        return (
            li.groupBy(F.col("l_suppkey"), d.alias("date"))
            .agg(F.min(kind).alias("kind"))
            .select(
                _feed("l_suppkey").alias("feed_id"),
                (F.col("l_suppkey") * 10000 + days).alias("row_idx"),
                _text("l_suppkey").alias("service_id"), "date",
                F.col("kind").alias("exception_type"),
            )
        )

    def calendar_dates_text(self) -> DataFrame:
        return self.calendar_dates().select(
            "feed_id", "row_idx", "service_id",
            F.date_format("date", "yyyyMMdd").alias("date"),
            _text("exception_type").alias("exception_type"),
        )

    def _lineitem_trips(self) -> DataFrame:
        return self.table("lineitem").select(
            _feed("l_suppkey").alias("feed_id"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_idx"),
            _text("l_suppkey").alias("service_id"), "l_suppkey", "l_partkey",
            "l_orderkey", "l_linenumber", "l_quantity",
            F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("short_id"),
        )

    def _by_trip(self, trips: DataFrame, *key: str, rows: int = 100_000) -> DataFrame:
        """Rows dealt by trip to as many tasks as there are lines for: nearly every line is a trip of its own,
        so what a task holds of them follows its rows."""
        parts = -(-self.table("lineitem").count() // rows)
        return trips.repartition(parts, *key) if parts > 1 else trips

    def trips(self) -> DataFrame:
        full = F.concat_ws("-", "short_id", "service_id")
        return (
            self._by_trip(self._lineitem_trips().withColumn("trip_id", full), "trip_id", "feed_id")
            .groupBy("trip_id", "feed_id")
            .agg(F.min("row_idx").alias("row_idx"), F.min("l_suppkey").alias("s"),
                 F.min("l_partkey").alias("p"))
            .select("feed_id", "trip_id", "row_idx", _text("s").alias("service_id"),
                    _text("p").alias("route_id"))
        )

    def trips_dirty(self) -> DataFrame:
        """Feed F1 repeats trip ids, feed F2 names an unknown route; the others are clean.

        One read: the rows of F1 are counted where they are alike and told out again.
        """
        is_short = F.col("l_suppkey") % 4 == 1
        rogue = (F.col("l_suppkey") % 4 == 2) & (F.col("row_idx") % 4000 == 17)
        route = F.when(is_short, F.col("apart")).otherwise(F.col("p"))
        return (
            self._lineitem_trips().withColumn("apart", F.when(is_short, F.col("l_partkey")))
            .groupBy("row_idx", "l_suppkey", "apart")
            .agg(F.min("l_partkey").alias("p"), F.count(F.lit(1)).alias("n"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(is_short, F.col("n")).otherwise(1))))
            .select(
                _feed("l_suppkey").alias("feed_id"),
                F.when(is_short, _short_id("row_idx")).otherwise(F.concat_ws("-", _short_id("row_idx"), _text("l_suppkey")))
                .alias("trip_id"),
                "row_idx", _text("l_suppkey").alias("service_id"),
                F.when(rogue, "X").otherwise(_text(route)).alias("route_id"))
        )

    def routes(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(_feed("l_suppkey").alias("feed_id"), "l_partkey").distinct().select(
            "feed_id", F.col("l_partkey").alias("row_idx"), _text("l_partkey").alias("route_id"),
            # some routes have a short row, without its last column
            F.when(F.col("l_partkey") % 450 != 0, F.concat(F.lit("Line "), _text("l_partkey"))).alias("route_long_name"),
        )

    def stops(self) -> DataFrame:
        kinds = F.array(*map(F.lit, ("", "0", "1", "2", "0")))
        k = F.col("c_custkey")
        return self.table("customer").select(
            _feed("c_nationkey").alias("feed_id"), k.alias("row_idx"), _text(k).alias("stop_id"),
            F.concat(F.lit("Stop "), _text(k % 97)).alias("stop_name"),
            F.element_at(kinds, (k % 5 + 1).cast("int")).alias("location_type"),
        )

    def agency(self) -> DataFrame:
        """Feed F3 has no agency file of its own; its agencies are listed in that of F2."""
        feed = F.concat(F.lit("F"), F.least(F.col("n_nationkey") % 4, F.lit(2)).cast("string"))
        return self.table("nation").select(
            feed.alias("feed_id"),
            F.col("n_nationkey").cast("bigint").alias("row_idx"), F.col("n_name").alias("agency_id"),
        )

    def feed_info(self) -> DataFrame:
        """A row per nation; some dates are in the wrong form or blank."""
        k = F.col("n_nationkey")
        day = F.date_add(F.lit(date(1995, 1, 1)), (k * 10).cast("int"))
        return self.table("nation").select(
            _feed("n_nationkey").alias("feed_id"),
            F.call_function("div", k, F.lit(4)).alias("row_idx"),
            F.when(k % 4 == 1, F.date_format(day, "yyyy-MM-dd"))
            .otherwise(F.date_format(day, "yyyyMMdd")).alias("feed_start_date"),
            F.when(k % 4 == 2, "").otherwise(F.date_format(F.date_add(day, 400), "yyyyMMdd"))
            .alias("feed_end_date"),
            F.concat(F.lit("v"), _text("n_nationkey")).alias("feed_version"))

    def stop_times(self) -> DataFrame:
        """Calls keyed (order-trip, line number): keeps the real duplicates of lineitem."""
        li = self.table("lineitem")
        return li.select(
            _feed("l_suppkey").alias("feed_id"), _text("l_orderkey").alias("trip_id"),
            _text("l_linenumber").alias("stop_sequence"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_idx"),
        )

    def stop_calls(self) -> DataFrame:
        """Calls of the clean trips at customer stops of the same feed or elsewhere."""
        li, orders = self._lineitem_trips(), self.table("orders")
        return li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "feed_id", F.concat_ws("-", "short_id", "service_id").alias("trip_id"),
            _text("o_custkey").alias("stop_id"),
        )

    def stop_area(self) -> DataFrame:
        return self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            _feed("c_nationkey").alias("feed_id"), _text("c_custkey").alias("stop_id"),
            F.col("n_name").alias("municipality"),
        )

    def frequencies(self, short: str | None = None) -> DataFrame:
        """Text windows, one per trip: line-1 trips leave often, others once; F3 is inexact.

        Feed ``short`` has trip ids without their service, as in ``trips_dirty``.
        """
        q = F.max(F.when(F.col("l_linenumber") == 1, F.col("l_quantity").cast("bigint")).otherwise(1))
        end = F.lit(21600) + F.col("q") * 600
        # trips are told apart by numbers, their ids are written once a trip; feed F<i> has the services i modulo 4
        feed = (F.col("l_suppkey") % 4).alias("feed")
        service = F.col("l_suppkey") if short is None else F.when(feed != int(short[1:]), F.col("l_suppkey"))
        return (
            self._by_trip(self._lineitem_trips().select(
                "row_idx", service.alias("service"), feed, "l_linenumber", "l_quantity"), "row_idx", "service", "feed")
            .groupBy("row_idx", "service", "feed").agg(q.alias("q"))
            .select(
                F.concat(F.lit("F"), _text("feed")).alias("feed_id"),
                F.concat_ws("-", _short_id("row_idx"), _text("service")).alias("trip_id"),
                "row_idx", F.lit("06:00:00").alias("start_time"),
                _clock(end).alias("end_time"), F.lit("600").alias("headway_secs"),
                F.when(F.col("feed") == 3, "0").otherwise("1").alias("exact_times"),
            )
        )

    def file_status(self) -> DataFrame:
        """All files present except agency.txt of F3."""
        headers = {
            "agency.txt": ["agency_id"], "routes.txt": ["route_id", "route_long_name"],
            "stops.txt": ["stop_id", "stop_name", "location_type"],
            "calendar.txt": ["service_id", *V.WEEKDAYS, "start_date", "end_date"],
            "calendar_dates.txt": ["service_id", "date", "exception_type"],
            "trips.txt": ["route_id", "service_id", "trip_id"],
            "frequencies.txt": ["trip_id", "start_time", "end_time", "headway_secs", "exact_times"],
        }
        rows = F.array(*[
            F.struct(F.lit(f).alias("file_name"),
                     F.array(*map(F.lit, h)).alias("header"))
            for f, h in headers.items()
        ])
        absent = (F.col("feed_id") == "F3") & (F.col("x.file_name") == "agency.txt")
        return self.feeds().select("feed_id", F.explode(rows).alias("x")).select(
            "feed_id", "x.file_name", (~absent).alias("present"),
            F.lit(None).cast("string").alias("decode_error"),
            F.when(~absent, F.col("x.header")).alias("header"),
        )

    def feed_tables(self) -> FeedTables:
        return FeedTables(
            feeds=self.feeds(), file_status=self.file_status(), agency=self.agency(),
            routes=self.routes(), stops=self.stops(), calendar=self.calendar_text_clean(),
            calendar_dates=self.calendar_dates_text(), trips=self.trips_dirty(),
            frequencies=self.frequencies_for_dirty(),
        )

    def calendar_text_clean(self) -> DataFrame:
        return self.calendar().select(
            "feed_id", "row_idx", "service_id",
            *[_text(F.call_function("shiftright", F.col("mask"), F.lit(i)).bitwiseAND(1)).alias(d)
              for i, d in enumerate(V.WEEKDAYS)],
            F.date_format("start_date", "yyyyMMdd").alias("start_date"),
            F.date_format("end_date", "yyyyMMdd").alias("end_date"),
        )

    def frequencies_for_dirty(self) -> DataFrame:
        """Windows for ``trips_dirty``, those of feed F1 under its short trip ids."""
        return self.frequencies("F1")
