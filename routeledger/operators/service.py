"""Service calendars and scheduled trips per real date.

Target dates are a parameter (a week, or any number), so a service's activity over them is a bit mask
computed row by row: no date join, no row multiplication, and the overlay of exceptions is a
bitwise aggregate that combines map-side.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from routeledger.functions import gtfs
from routeledger.vocab import WEEKDAYS

# a mask is an array of words of this many days each, as many as the dates need
DAYS_PER_WORD = 62


def check_dates(dates: list[date]) -> list[date]:
    if not dates or len(set(dates)) != len(dates):
        raise ValueError("need distinct target dates, one at least")
    return dates


def _bit(i: int) -> Column:
    return F.lit(1 << (i % DAYS_PER_WORD)).cast("bigint")


def day_bit(mask: Column, i: int) -> Column:
    return F.get(mask, F.lit(i // DAYS_PER_WORD)).bitwiseAND(_bit(i)) != 0


def any_day(mask: Column) -> Column:
    return F.exists(mask, lambda word: word != 0)


def typed_calendar(calendar: DataFrame) -> DataFrame:
    """Text calendar rows -> (feed_id, service_id, mask, start_date, end_date)."""
    return calendar.select(
        "feed_id", "service_id",
        gtfs.weekday_mask([F.col(d) for d in WEEKDAYS]).alias("mask"),
        gtfs.gtfs_date(F.col("start_date")).alias("start_date"),
        gtfs.gtfs_date(F.col("end_date")).alias("end_date"),
    )


def typed_calendar_dates(calendar_dates: DataFrame) -> DataFrame:
    """Text exception rows -> (feed_id, service_id, date, exception_type INT)."""
    return calendar_dates.select(
        "feed_id", "service_id",
        gtfs.gtfs_date(F.col("date")).alias("date"),
        F.col("exception_type").try_cast("int").alias("exception_type"),
    )


def base_words(dates: list[date]) -> list[Column]:
    """Mask words of the days on which a typed calendar row runs by range and weekday."""
    zero = F.lit(0).cast("bigint")
    words = [zero for _ in range(-(-len(dates) // DAYS_PER_WORD))]
    for i, d in enumerate(dates):
        runs = (
            (F.col("start_date") <= F.lit(d)) & (F.col("end_date") >= F.lit(d))
            & (F.col("mask").bitwiseAND(1 << d.weekday()) != 0)
        )
        words[i // DAYS_PER_WORD] = words[i // DAYS_PER_WORD] + F.when(runs, _bit(i)).otherwise(zero)
    return words


def hit_words(dates: list[date], names: Callable[[date], Column]) -> list[Column]:
    """Mask words with the bit of the target date that a row names, if any."""
    words = [F.lit(0).cast("bigint") for _ in range(-(-len(dates) // DAYS_PER_WORD))]
    for i, d in enumerate(dates):
        w = i // DAYS_PER_WORD
        words[w] = F.when(names(d), _bit(i)).otherwise(words[w])
    return words


def mask_of(n_words: int) -> Column:
    """Day mask of merged words: base days, then added ones, without removed ones."""
    return F.array(*[
        F.col(f"base{w}").bitwiseOR(F.col(f"added{w}")).bitwiseAND(F.bitwise_not(f"removed{w}"))
        for w in range(n_words)])


def service_days(
    calendar: DataFrame, calendar_dates: DataFrame, dates: list[date]
) -> DataFrame:
    """One row per known service: (feed_id, service_id, day_mask); bit i = active on dates[i].

    Base days come from range and weekday, then exception 1 adds and exception 2 removes.
    """
    check_dates(dates)
    zero = F.lit(0).cast("bigint")
    base = base_words(dates)
    hit = hit_words(dates, lambda d: F.col("date") == F.lit(d))
    words = range(len(base))
    kinds = {1: "added", 2: "removed"}
    parts = calendar.select(
        "feed_id", "service_id", *[base[w].alias(f"base{w}") for w in words],
        *[zero.alias(f"{k}{w}") for k in kinds.values() for w in words],
    ).unionByName(calendar_dates.select(
        "feed_id", "service_id", *[zero.alias(f"base{w}") for w in words],
        *[F.when(F.col("exception_type") == n, hit[w]).otherwise(zero).alias(f"{k}{w}")
          for n, k in kinds.items() for w in words],
    ))
    every = [f"{k}{w}" for k in ("base", *kinds.values()) for w in words]
    return parts.groupBy("feed_id", "service_id").agg(
        *[F.bit_or(c).alias(c) for c in every]
    ).select("feed_id", "service_id", mask_of(len(base)).alias("day_mask"))


def active_services(
    calendar: DataFrame, calendar_dates: DataFrame, dates: list[date]
) -> DataFrame:
    """(feed_id, service_id, service_date) for every target date a service runs on."""
    day = F.array(*[
        F.struct(F.lit(d).alias("d"), F.lit(i // DAYS_PER_WORD).alias("word"), _bit(i).alias("bit"))
        for i, d in enumerate(check_dates(dates))
    ])
    services = service_days(
        calendar, calendar_dates.where(F.col("date").isin(dates)), dates
    ).where(any_day(F.col("day_mask")))
    hits = F.filter(day, lambda x: F.get("day_mask", x["word"]).bitwiseAND(x["bit"]) != 0)
    return services.select("feed_id", "service_id", F.explode(hits).alias("x")).select(
        "feed_id", "service_id", F.col("x.d").alias("service_date")
    )


def explode_dates(per_feed: DataFrame, dates: list[date], value) -> DataFrame:
    """Turn one row per feed into one row per (feed, date); ``value(i)`` gives its struct."""
    rows = F.array(*[
        F.struct(F.lit(d).alias("service_date"), *value(i)) for i, d in enumerate(dates)
    ])
    return per_feed.select("feed_id", F.explode(rows).alias("x")).select("feed_id", "x.*")


def scheduled_trips(
    feeds: DataFrame, calendar: DataFrame, calendar_dates: DataFrame, trips: DataFrame,
    dates: list[date], frequencies: DataFrame | None = None,
) -> DataFrame:
    """Scheduled trips per feed and real date, zero-filled.

    Trips collapse to one count per (feed, service) before they meet the calendar. With
    ``frequencies`` (feed_id, trip_id, departures, inexact) a template trip counts as its exact
    departures, and a day with an active inexact trip has no value.
    """
    if frequencies is None:
        per_service = trips.groupBy("feed_id", "service_id").agg(
            F.count(F.lit(1)).alias("n"), F.lit(False).alias("inexact")
        )
    else:
        joined = trips.select("feed_id", "service_id", "trip_id").join(
            frequencies, ["feed_id", "trip_id"], "left"
        )
        per_service = joined.groupBy("feed_id", "service_id").agg(
            F.sum(F.when(F.col("inexact"), 0).otherwise(F.coalesce("departures", F.lit(1))))
            .alias("n"),
            F.max(F.coalesce("inexact", F.lit(False))).alias("inexact"),
        )
    days = service_days(calendar, calendar_dates.where(F.col("date").isin(dates)), dates)
    sums = []
    for i in range(len(dates)):
        on = day_bit(F.col("day_mask"), i)
        sums.append(F.sum(F.when(on, F.col("n")).otherwise(0)).alias(f"n{i}"))
        sums.append(F.max(on & F.col("inexact")).alias(f"x{i}"))
    per_feed = (
        per_service.join(days.where(any_day(F.col("day_mask"))), ["feed_id", "service_id"])
        .groupBy("feed_id").agg(*sums)
    )
    full = feeds.select("feed_id").join(per_feed, "feed_id", "left")

    def value(i: int) -> list[Column]:
        blocked = F.coalesce(f"x{i}", F.lit(False))
        n = F.when(~blocked, F.coalesce(f"n{i}", F.lit(0))).cast("bigint")
        if frequencies is None:
            return [n.alias("trip_count")]
        return [n.alias("trip_count"), blocked.alias("has_inexact")]

    return explode_dates(full, dates, value)


def frequency_windows(frequencies: DataFrame) -> DataFrame:
    """Text frequency rows with parsed seconds, headway and exact departures per window.

    ``departures`` is (end - start) / headway where that division leaves no remainder.
    """
    start = gtfs.gtfs_seconds(F.col("start_time"))
    end = gtfs.gtfs_seconds(F.col("end_time"))
    headway = gtfs.positive_int(F.col("headway_secs"))
    span = F.col("end_sec") - F.col("start_sec")
    return (
        frequencies.withColumn("start_sec", start).withColumn("end_sec", end)
        .withColumn("headway", headway)
        .withColumn("divides", F.when(F.col("headway") > 0, span % F.col("headway") == 0))
        .withColumn(
            "departures",
            F.when(F.col("divides") & (span > 0), F.call_function("div", span, F.col("headway"))),
        )
    )


def frequency_by_trip(frequencies: DataFrame) -> DataFrame:
    """(feed_id, trip_id, departures, inexact): windows of one trip added up."""
    w = frequency_windows(frequencies)
    exact = F.col("exact_times") == "1"
    return w.groupBy("feed_id", "trip_id").agg(
        F.sum(F.when(exact, F.col("departures"))).alias("departures"),
        F.max(~exact).alias("inexact"),
    )


def weekday_uniform(daily: DataFrame) -> DataFrame:
    """Monday-Friday summary per feed: one number only when all five days are equal."""
    day = F.weekday("service_date")
    n = F.col("trip_count")
    agg = daily.groupBy("feed_id").agg(
        F.count(F.when((day < 5) & n.isNotNull(), 1)).alias("days"),
        F.min(F.when(day < 5, n)).alias("lo"), F.max(F.when(day < 5, n)).alias("hi"),
        *[F.max(F.when(day == i, n)).alias(WEEKDAYS[i]) for i in range(7)],
    )
    uniform = (F.col("days") == 5) & (F.col("lo") == F.col("hi"))
    return agg.select(
        "feed_id", uniform.alias("is_uniform"), F.when(uniform, F.col("lo")).alias("weekday_trips"),
        *[F.when(~uniform, F.col(d)).alias(d) for d in WEEKDAYS[:5]],
        *[F.col(d) for d in WEEKDAYS[5:]],
    )


def comparison_week(bounds: DataFrame) -> DataFrame:
    """First Monday-Sunday week every comparable feed can be evaluated on.

    ``bounds``: feed_id, reference_date, reference_status, info_start, info_end, cal_start,
    cal_end. The base is the latest confirmed reference date; a feed's search limit is its
    info_end, else its calendar end. Feeds without a confirmed date take no part.
    """
    part = bounds.where(
        (F.col("reference_status") == "confirmed") & F.col("reference_date").isNotNull()
    ).select(
        "reference_date",
        F.coalesce("info_end", "cal_end").alias("upper"),
        F.greatest("info_start", "cal_start").alias("lower"),
        F.least("info_end", "cal_end").alias("last_day"),
    )
    # All feeds must cover the week, and each feed covers one interval, so the common interval
    # is [max lower, min last_day]: a global aggregate instead of feed x week rows.
    g = part.agg(
        F.count(F.lit(1)).alias("n_feeds"),
        F.count_if(F.col("upper").isNull()).alias("n_unbounded"),
        F.max("reference_date").alias("base_date"),
        F.max("lower").alias("lower"), F.min("last_day").alias("last_day"),
        F.min("upper").alias("upper"),
    )
    earliest = F.greatest("base_date", "lower")
    monday = F.next_day(F.date_sub(earliest, 1), "MO")
    fits = F.date_add(F.col("monday"), 6) <= F.least("last_day", "upper")
    status = (
        F.when((F.col("n_feeds") == 0) | (F.col("n_unbounded") > 0), "not_calculable")
        .when(fits, "measured").otherwise("not_comparable_no_common_week")
    )
    return (
        g.withColumn("monday", monday).withColumn("metric_status", status)
        .select(
            "n_feeds", "base_date",
            F.when(F.col("metric_status") == "measured", F.col("monday")).alias("week_start"),
            F.when(F.col("metric_status") == "measured", F.date_add("monday", 6)).alias("week_end"),
            "metric_status",
        )
    )


# -- weeks of feeds whose evaluable days have holes --------------------------------------------

def _confirmed(references: DataFrame) -> DataFrame:
    return references.where((F.col("reference_status") == "confirmed") & F.col("reference_date").isNotNull())


def _plateaus(events: DataFrame, by: list[str], level: Column) -> DataFrame:
    """(by, day, last): the days from one event to the next on which the running sum of ``delta`` is at ``level``."""
    order = Window.partitionBy(*by).orderBy("day")
    return (
        events.groupBy(*by, "day").agg(F.sum("delta").alias("delta")).where("delta <> 0")
        .withColumn("_n", F.sum("delta").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("last", F.date_sub(F.lead("day").over(order), 1))
        .where(F.col("_n") == level).drop("_n", "delta"))


def evaluable_days(references: DataFrame, ranges: DataFrame) -> DataFrame:
    """(feed_id, day, last): the maximal runs of days on which a confirmed feed can be evaluated.

    ``references``: feed_id, reference_date, reference_status, info_start, info_end. ``ranges``: feed_id,
    start_date, end_date, any number a feed, overlapping or not. A day outside the feed's info range, where
    it has one, does not count.
    """
    own = ranges.join(_confirmed(references).select("feed_id", "info_start", "info_end"), "feed_id").select(
        "feed_id", F.greatest("start_date", "info_start").alias("first"), F.least("end_date", "info_end").alias("end"))
    events = own.where("first <= end").select("feed_id", F.explode(F.array(
        F.struct(F.col("first").alias("day"), F.lit(1).alias("delta")),
        F.struct(F.date_add("end", 1).alias("day"), F.lit(-1).alias("delta")))).alias("e")).select("feed_id", "e.*")
    # ranges that overlap or touch are one run: an event counts where the number of open ranges leaves or reaches 0
    order = Window.partitionBy("feed_id").orderBy("day")
    open_ = events.groupBy("feed_id", "day").agg(F.sum("delta").alias("delta")).withColumn(
        "n", F.sum("delta").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    edges = open_.select("feed_id", "day", (
        F.when(F.col("n") > 0, 1).otherwise(0) - F.when(F.col("n") - F.col("delta") > 0, 1).otherwise(0)).alias("delta"))
    return _plateaus(edges, ["feed_id"], F.lit(1))


def _limits(references: DataFrame, ranges: DataFrame) -> DataFrame:
    """(feed_id, reference_date, upper): the last day a confirmed feed's week is looked for."""
    last = ranges.groupBy("feed_id").agg(F.max("end_date").alias("cal_end"))
    return _confirmed(references).join(last, "feed_id", "left").select(
        "feed_id", "reference_date", F.coalesce("info_end", "cal_end").alias("upper"))


def _week(first: Column, last: Column) -> Column:
    """The first Monday from a day on, where its Sunday is not after the last day."""
    monday = F.next_day(F.date_sub(first, 1), "MO")
    return F.when(F.date_add(monday, 6) <= last, monday)


def own_weeks(references: DataFrame, ranges: DataFrame) -> DataFrame:
    """(feed_id, week_start, metric_status) of each confirmed feed measured by itself."""
    limits = _limits(references, ranges)
    weeks = evaluable_days(references, ranges).join(limits, "feed_id").groupBy("feed_id").agg(F.min(_week(
        F.greatest("day", "reference_date"), F.least("last", "upper"))).alias("week_start"))
    return limits.join(weeks, "feed_id", "left").select(
        "feed_id", "week_start",
        F.when(F.col("upper").isNull(), "not_calculable").when(F.col("week_start").isNull(), "no_week_in_range")
        .otherwise("measured").alias("metric_status"))


def common_week(references: DataFrame, ranges: DataFrame) -> DataFrame:
    """The first Monday-Sunday week, from the latest reference date on, that all confirmed feeds can be evaluated on.

    Runs of evaluable days become +1 and -1 events, added up per day first; where their running count is the
    number of feeds all feeds are open, and weeks are taken from these plateaus. Only days are ordered as a
    whole, never feeds. Nothing past the smallest search limit counts; a feed without one makes it incalculable.
    """
    n, bounds = F.count(F.lit(1)), {"n_feeds": "bigint", "n_unbounded": "bigint", "base_date": "date", "upper": "date"}
    limits = _limits(references, ranges).agg(
        n.alias("n_feeds"), F.count_if(F.col("upper").isNull()).alias("n_unbounded"),
        F.max("reference_date").alias("base_date"), F.min("upper").alias("upper"))
    events = evaluable_days(references, ranges).select(F.explode(F.array(
        F.struct(F.col("day"), F.lit(1).alias("delta")),
        F.struct(F.date_add("last", 1).alias("day"), F.lit(-1).alias("delta")))).alias("e")).select("e.*")
    # what holds for all feeds is a row among the days, so nothing is multiplied
    daily = events.groupBy("day").agg(F.sum("delta").alias("delta")).select(
        "day", "delta", *[F.lit(None).cast(t).alias(c) for c, t in bounds.items()]).unionByName(
        limits.select(F.lit(None).cast("date").alias("day"), F.lit(0).cast("bigint").alias("delta"), *bounds))
    order, whole = Window.partitionBy("k").orderBy("day"), Window.partitionBy("k")
    open_ = (
        daily.withColumn("k", F.lit(0))
        .withColumn("n_open", F.sum("delta").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("last", F.date_sub(F.lead("day").over(order), 1))
        .withColumns({c: F.max(c).over(whole) for c in bounds}))
    plateau = F.col("day").isNotNull() & (F.col("n_open") == F.col("n_feeds"))
    out = open_.groupBy("k").agg(
        F.min(F.when(plateau, _week(F.greatest("day", "base_date"), F.least("last", "upper")))).alias("week_start"),
        *[F.max(c).alias(c) for c in bounds])
    calculable = (F.col("n_feeds") > 0) & (F.col("n_unbounded") == 0)
    start = F.when(calculable, F.col("week_start"))
    return out.select(
        "n_feeds", "base_date", start.alias("week_start"), F.date_add(start, 6).alias("week_end"),
        F.when(~calculable, "not_calculable").when(start.isNull(), "not_comparable_no_common_week")
        .otherwise("measured").alias("metric_status"))
