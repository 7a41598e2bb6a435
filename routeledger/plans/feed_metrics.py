"""Feed supply metrics: ordered preconditions, structure counts and trips per real date.

One job serves all feeds and reads every table of theirs once (``feed_facts``); what follows runs on
one row per feed. The first broken precondition, in fixed order, names the reason for the feed's
whole week.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions import gtfs
from routeledger.operators import quality, service
from routeledger.plans import feed_facts as facts

# Fixed order of preconditions: rule -> (table rank, check rank). Rules of table 1 and 2 and all
# presence, decoding and column rules speak for a whole file; the others carry a row index.
RULES = {
    "routes:absent": (1, 1), "routes:undecodable": (1, 2), "routes:missing_column": (1, 3),
    "routes:blank_route_id": (1, 4), "routes:duplicate_route_id": (1, 5),
    "calendars:both_absent": (2, 1),
    "calendar:undecodable": (3, 1), "calendar:missing_column": (3, 2),
    "calendar:blank_service_id": (3, 3), "calendar:duplicate_service_id": (3, 4),
    "calendar:invalid_date": (3, 5), "calendar:start_after_end": (3, 6),
    "calendar:invalid_weekday_flag": (3, 7),
    "calendar_dates:undecodable": (4, 1), "calendar_dates:missing_column": (4, 2),
    "calendar_dates:blank_service_id": (4, 3), "calendar_dates:invalid_date": (4, 4),
    "calendar_dates:invalid_exception_type": (4, 5), "calendar_dates:duplicate_key": (4, 6),
    "trips:absent": (5, 1), "trips:undecodable": (5, 2), "trips:missing_column": (5, 3),
    "trips:blank_trip_id": (5, 4), "trips:duplicate_trip_id": (5, 5),
    "trips:blank_service_id": (5, 6), "trips:blank_route_id": (5, 7),
    "trips:unknown_route": (5, 8), "trips:unknown_service": (5, 9),
    "frequencies:undecodable": (6, 1), "frequencies:missing_column": (6, 2),
    "frequencies:unknown_trip": (6, 3), "frequencies:invalid_time": (6, 4),
    "frequencies:invalid_headway": (6, 5), "frequencies:end_not_after_start": (6, 6),
    "frequencies:invalid_exact_times": (6, 7), "frequencies:not_divisible": (6, 8),
    "frequencies:duplicate_key": (6, 9),
}

REQUIRED_COLUMNS = {
    "routes": ("route_id",),
    "calendar": ("service_id", *V.WEEKDAYS, "start_date", "end_date"),
    "calendar_dates": ("service_id", "date", "exception_type"),
    "trips": ("route_id", "service_id", "trip_id"),
    "frequencies": ("trip_id", "start_time", "end_time", "headway_secs"),
}
# what else the facts read, where a feed has it
OPTIONAL_COLUMNS = {
    "frequencies": ("exact_times",), "stops": ("stop_id", "location_type"), "agency": (),
}


@dataclass(frozen=True)
class FeedTables:
    """Tables of many feeds at once, all cells text, keyed by feed_id and row_idx.

    A short row holds '' in the missing cells; a column a feed does not have holds NULL and is
    not in that feed's header. ``file_status``: feed_id, file_name, present, decode_error, header.
    """

    feeds: DataFrame
    file_status: DataFrame
    agency: DataFrame
    routes: DataFrame
    stops: DataFrame
    calendar: DataFrame
    calendar_dates: DataFrame
    trips: DataFrame
    frequencies: DataFrame


def with_columns(df: DataFrame, names) -> DataFrame:
    """Add the columns a table lacks as NULL text."""
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast("string") for n in missing}) if missing else df


def files_wide(feeds: DataFrame, file_status: DataFrame) -> DataFrame:
    """One row per feed: p_/e_/h_ (present, decode error, header) for each input file."""
    cols = []
    for f in V.FEED_FILES:
        name, here = f.removesuffix(".txt"), F.col("file_name") == f
        cols += [
            F.coalesce(F.bool_or(F.when(here, F.col("present"))), F.lit(False)).alias(f"p_{name}"),
            F.max(F.when(here, F.col("decode_error"))).alias(f"e_{name}"),
            F.max(F.when(here, F.col("header"))).alias(f"h_{name}"),
        ]
    wide = file_status.groupBy("feed_id").agg(*cols)
    known = {f"p_{f.removesuffix('.txt')}": False for f in V.FEED_FILES}
    return feeds.select("feed_id").join(wide, "feed_id", "left").na.fill(known)


def _violation(rule: str, cond: str, row) -> str:
    table, check = RULES[rule]
    return (f"CASE WHEN {cond} THEN named_struct('table_rank', {table}, 'row_idx', CAST({row} AS bigint), "
            f"'check_rank', {check}, 'reason', '{rule}') END")


def _file_rules() -> dict[str, str]:
    """Rules that the presence, decoding and header of a file decide."""
    rules = {}
    for t, required in REQUIRED_COLUMNS.items():
        names = ", ".join(f"'{c}'" for c in required)
        rules[f"{t}:undecodable"] = f"p_{t} AND e_{t} IS NOT NULL"
        rules[f"{t}:missing_column"] = (
            f"p_{t} AND e_{t} IS NULL AND size(array_except(array({names}), h_{t})) > 0")
    for t in ("routes", "trips"):
        rules[f"{t}:absent"] = f"NOT p_{t}"
    rules["calendars:both_absent"] = "NOT p_calendar AND NOT p_calendar_dates"
    return rules


def _wide(t: FeedTables, dates: list[date], files: tuple[str, ...]) -> DataFrame:
    """One row per feed: its files and the facts of the tables named."""
    tables = {
        f: with_columns(getattr(t, f), REQUIRED_COLUMNS.get(f, ()) + OPTIONAL_COLUMNS.get(f, ()))
        for f in files}
    return files_wide(t.feeds, t.file_status).join(
        facts.feed_facts(tables, dates), "feed_id", "left")


def feed_checks(
    t: FeedTables, dates: list[date], files: tuple[str, ...] = facts.CHECKED
) -> DataFrame:
    """Every precondition and the daily sums of all feeds, one wide row per feed."""
    return _wide(t, service.check_dates(dates), files)


def _violations() -> Column:
    """The broken rules of a feed, in no order; NULL for each rule that holds."""
    rows = {r: facts.rule_column(r) for r in facts.ROW_RULES}
    return F.expr("array({})".format(", ".join([
        *[_violation(r, c, facts.FILE_LEVEL) for r, c in _file_rules().items()],
        *[_violation(r, f"{c} IS NOT NULL", c) for r, c in rows.items()]])))


def feed_violations(checks: DataFrame) -> DataFrame:
    """(feed_id, reason, table_rank, check_rank, row_idx): first row of every broken rule."""
    return checks.select("feed_id", F.explode(_violations()).alias("v")).where(
        F.col("v").isNotNull()
    ).select("feed_id", "v.reason", "v.table_rank", "v.check_rank", "v.row_idx")


def _judged(checks: DataFrame) -> DataFrame:
    """The wide row of each feed with ``verdict``, its first broken rule or NULL."""
    return checks.withColumn("verdict", F.array_min(F.array_compact(_violations())))


def feed_verdict(checks: DataFrame) -> DataFrame:
    """(feed_id, is_valid, reason, row_idx): the first broken precondition of each feed."""
    return _judged(checks).select(
        "feed_id", F.col("verdict").isNull().alias("is_valid"), "verdict.reason",
        "verdict.row_idx")


def _triple(status: Column, value: Column, reason: Column) -> list[Column]:
    """The metric contract: a value only when measured, a reason only when not."""
    measured = status == V.MEASURED
    return [
        F.when(measured, value).cast("bigint").alias("value"),
        status.alias("metric_status"),
        F.when(~measured, reason).alias("reason"),
    ]


def _structure_rows() -> list[Column]:
    """Agency rows, route ids and boarding locations of a wide row."""

    def ladder(file: str, key: str | None) -> list[Column]:
        status = F.when(~F.col(f"p_{file}"), V.NOT_CALCULABLE).when(
            F.col(f"e_{file}").isNotNull(), V.INVALID_INPUT
        )
        reason = F.when(~F.col(f"p_{file}"), f"{file}:absent").when(
            F.col(f"e_{file}").isNotNull(), f"{file}:undecodable"
        )
        if key:
            lacks = ~F.coalesce(F.array_contains(F.col(f"h_{file}"), key), F.lit(False))
            blank = F.coalesce(f"{file}_blank", F.lit(False))
            dup = F.coalesce(f"{file}_repeated", F.lit(False))
            status = status.when(lacks, V.NOT_CALCULABLE).when(blank | dup, V.INVALID_INPUT)
            reason = reason.when(lacks, f"{file}:missing_column").when(
                blank, f"{file}:blank_{key}"
            ).when(dup, f"{file}:duplicate_{key}")
        status = status.otherwise(V.MEASURED)
        return _triple(status, F.coalesce(f"{file}_value", F.lit(0)), reason)

    specs = (
        (V.AGENCY_COUNT, ladder("agency", None)), (V.ROUTE_COUNT, ladder("routes", "route_id")),
        (V.BOARDING_COUNT, ladder("stops", "stop_id")),
    )
    return [_metric(m, F.lit(None), cols) for m, cols in specs]


def _metric(metric: str, day: Column, triple: list[Column]) -> Column:
    return F.struct(
        F.lit(metric).alias("metric_id"), day.cast("date").alias("service_date"), *triple)


def _daily_rows(dates: list[date]) -> list[Column]:
    """Trips on each date of a judged wide row."""
    bad = F.col("verdict").isNotNull()
    rows = []
    for i, d in enumerate(dates):
        inexact = F.coalesce(f"x{i}", F.lit(False))
        status = F.when(bad, V.INVALID_INPUT).when(inexact, V.NOT_EXACT).otherwise(V.MEASURED)
        reason = F.when(bad, F.col("verdict.reason")).otherwise(F.lit("frequencies:inexact_times"))
        rows.append(_metric(
            V.TRIP_COUNT, F.lit(d), _triple(status, F.coalesce(f"n{i}", F.lit(0)), reason)))
    return rows


def _long(wide: DataFrame, rows: list[Column]) -> DataFrame:
    return wide.select("feed_id", F.explode(F.array(*rows)).alias("m")).select("feed_id", "m.*")


def structure_metrics(t: FeedTables) -> DataFrame:
    """Agency rows, route ids and boarding locations: (feed_id, metric_id, value, status, reason)."""
    return _long(_wide(t, [], facts.COUNTED), _structure_rows()).drop("service_date")


def daily_metrics(checks: DataFrame, dates: list[date]) -> DataFrame:
    """(feed_id, service_date, value, metric_status, reason) for each feed and target date."""
    return _long(_judged(checks), _daily_rows(dates)).drop("metric_id")


def feed_supply_metrics(t: FeedTables, dates: list[date]) -> DataFrame:
    """The long metric table: structure counts (no date) and trips per date for every feed."""
    checks = feed_checks(t, dates, tuple(dict.fromkeys(facts.CHECKED + facts.COUNTED)))
    return _long(_judged(checks), [*_structure_rows(), *_daily_rows(dates)])


def date_basis(
    calendar: DataFrame, calendar_dates: DataFrame, feed_info: DataFrame, feeds: DataFrame
) -> DataFrame:
    """Per feed, the three date sources side by side and never merged into one period."""
    info = quality.feed_info_first_row(feed_info).select(
        "feed_id", F.struct("feed_start_date", "feed_end_date").alias("feed_info")
    )
    cal = quality.calendar_span(calendar).select(
        "feed_id",
        F.struct("min_start_date", "max_end_date", "service_id_unique_count").alias("calendar"),
    )
    exc = quality.exception_span(calendar_dates).select(
        "feed_id",
        F.struct("added_date_min", "added_date_max", "removed_date_min", "removed_date_max",
                 "service_id_unique_count").alias("calendar_dates"),
    )
    out = feeds.select("feed_id")
    for part in (info, cal, exc):
        out = out.join(part, "feed_id", "left")
    return out


def independent_feed_metrics(
    t: FeedTables, dates: list[date], anchors: DataFrame
) -> DataFrame:
    """Whole-feed metrics of feeds measured on their own week, gated by required routes.

    A feed whose anchor routes are missing or renamed gets no numbers at all.
    """
    gate = quality.anchor_check(t.routes, anchors, t.file_status).groupBy("feed_id").agg(
        F.min(F.when(F.col("reason").isNotNull(), F.col("reason"))).alias("anchor_reason"),
        F.count(F.lit(1)).alias("anchor_count"),
    )
    m = feed_supply_metrics(t, dates).join(gate, "feed_id")
    failed = F.col("anchor_reason").isNotNull()
    return m.select(
        "feed_id", "metric_id", "service_date", "anchor_count",
        F.lit("whole_feed").alias("measurement_scope"),
        F.lit("independent_not_comparable").alias("comparison_mode"),
        F.when(~failed, F.col("value")).alias("value"),
        F.when(failed, V.INVALID_INPUT).otherwise(F.col("metric_status")).alias("metric_status"),
        F.when(failed, F.concat(F.lit("anchor:"), "anchor_reason"))
        .otherwise(F.col("reason")).alias("reason"),
    )
