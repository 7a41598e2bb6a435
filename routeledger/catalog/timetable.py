"""Timetable queries: references, services, scheduled trips and feed metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from routeledger.catalog import Registry
from routeledger.lens_sql import with_lenses
from routeledger.lenses import WEEK, Lens
from routeledger.operators import quality, service
from routeledger.plans import feed_metrics as fm

R = Registry()

# -- statistics -------------------------------------------------------------------------------


@R.add("id_stats", """
    SELECT l_returnflag AS group_key, CAST(count(*) AS BIGINT) AS row_count,
           CAST(0 AS BIGINT) AS blank_count, count(DISTINCT l_orderkey) AS unique_count,
           count(*) - count(DISTINCT l_orderkey) AS duplicate_count
    FROM lineitem GROUP BY l_returnflag""")
def id_stats(spark, sf_dir):
    li = Lens(spark, sf_dir).table("lineitem").select(
        F.col("l_returnflag").alias("group_key"), F.col("l_orderkey").cast("string").alias("id")
    )
    return quality.id_stats(li, ["group_key"], ["id"])


@R.add("composite_id_stats", with_lenses("""
    SELECT feed_id, count(*) AS row_count, CAST(0 AS BIGINT) AS blank_count,
           count(DISTINCT trip_id || '+' || stop_sequence) AS unique_count,
           count(*) - count(DISTINCT trip_id || '+' || stop_sequence) AS duplicate_count
    FROM stop_times GROUP BY feed_id"""))
def composite_id_stats(spark, sf_dir):
    st = Lens(spark, sf_dir).stop_times()
    return quality.id_stats(st, ["feed_id"], ["trip_id", "stop_sequence"])


@R.add("duplicate_rows", with_lenses("""
    SELECT feed_id, trip_id, row_idx, first_row_idx FROM (
        SELECT feed_id, trip_id, row_idx,
               min(row_idx) OVER (PARTITION BY feed_id, trip_id) AS first_row_idx
        FROM li_orders) WHERE row_idx > first_row_idx""",
    {"li_orders": """SELECT 'F' || (l_suppkey % 4) AS feed_id,
                            CAST(l_orderkey AS VARCHAR) AS trip_id,
                            l_orderkey * 8 + l_linenumber AS row_idx FROM lineitem"""}))
def duplicate_rows(spark, sf_dir):
    st = Lens(spark, sf_dir).stop_times()
    return quality.duplicate_rows(st, ["feed_id"], ["trip_id"])


@R.add("value_counts", with_lenses("""
    SELECT feed_id, 'location_type' AS column_name, location_type AS value, count(*) AS n
    FROM stops GROUP BY feed_id, location_type
    UNION ALL
    SELECT feed_id, 'exception_type', CAST(exception_type AS VARCHAR), count(*)
    FROM cd GROUP BY feed_id, exception_type"""))
def value_counts(spark, sf_dir):
    lens = Lens(spark, sf_dir)

    def counts(df, column):
        return quality.value_counts(df, ["feed_id"], column).select(
            "feed_id", F.lit(column).alias("column_name"), "value", "n")

    return counts(lens.stops(), "location_type").unionByName(
        counts(lens.calendar_dates_text(), "exception_type"))


@R.add("weekday_flag_counts", with_lenses("""
    SELECT feed_id, day, value, count(*) AS n, value IN ('0', '1') AS is_valid
    FROM (UNPIVOT (SELECT * FROM cal_text) ON monday, tuesday, wednesday, thursday, friday, saturday, sunday
          INTO NAME day VALUE value)
    GROUP BY feed_id, day, value"""))
def weekday_flag_counts(spark, sf_dir):
    return quality.weekday_flag_counts(Lens(spark, sf_dir).calendar_text())


@R.add("calendar_span", with_lenses("""
    SELECT feed_id, count(*) AS row_count, count(DISTINCT service_id) AS service_id_unique_count,
           min(CAST(try_strptime(start_date, '%Y%m%d') AS DATE)) AS min_start_date,
           max(CAST(try_strptime(end_date, '%Y%m%d') AS DATE)) AS max_end_date,
           CAST(sum(CAST(start_date LIKE '%-%' AS INTEGER)) AS BIGINT) AS invalid_date_count
    FROM cal_text GROUP BY feed_id"""))
def calendar_span(spark, sf_dir):
    return quality.calendar_span(Lens(spark, sf_dir).calendar_text())


@R.add("invalid_calendar_dates", with_lenses("""
    SELECT feed_id, row_idx, 'start_date' AS "column", start_date AS raw_value
    FROM cal_text WHERE start_date LIKE '%-%'"""))
def invalid_calendar_dates(spark, sf_dir):
    return quality.invalid_calendar_dates(Lens(spark, sf_dir).calendar_text())


@R.add("exception_span", with_lenses("""
    SELECT feed_id, count(*) AS row_count, count(DISTINCT service_id) AS service_id_unique_count,
           min(date) FILTER (WHERE exception_type = 1) AS added_date_min,
           max(date) FILTER (WHERE exception_type = 1) AS added_date_max,
           min(date) FILTER (WHERE exception_type = 2) AS removed_date_min,
           max(date) FILTER (WHERE exception_type = 2) AS removed_date_max,
           CAST(0 AS BIGINT) AS invalid_date_count
    FROM cd GROUP BY feed_id"""))
def exception_span(spark, sf_dir):
    return quality.exception_span(Lens(spark, sf_dir).calendar_dates_text())


# -- references -------------------------------------------------------------------------------


@R.add("fk_violations", with_lenses("""
    SELECT 'trips.route_id' AS rule_id, feed_id, route_id AS key_value, count(*) AS row_count,
           min(row_idx) AS first_row_idx
    FROM trips_dirty ANTI JOIN routes USING (feed_id, route_id) GROUP BY feed_id, route_id
    UNION ALL
    SELECT 'trips.service_id', feed_id, service_id, count(*), min(row_idx)
    FROM trips_dirty ANTI JOIN known_services USING (feed_id, service_id)
    GROUP BY feed_id, service_id
    UNION ALL
    SELECT 'frequencies.trip_id', feed_id, trip_id, count(*), min(row_idx)
    FROM freq ANTI JOIN trips_dirty USING (feed_id, trip_id) GROUP BY feed_id, trip_id"""))
def fk_violations(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return quality.fk_violations(
        lens.routes(), lens.calendar(), lens.calendar_dates(), lens.trips_dirty(),
        lens.frequencies())


@R.add("service_crosscheck", with_lenses("""
    SELECT coalesce(t.feed_id, s.feed_id) AS feed_id,
           coalesce(t.service_id, s.service_id) AS service_id,
           CASE WHEN s.service_id IS NULL THEN 'trips_only' ELSE 'calendar_only' END AS side
    FROM (SELECT DISTINCT feed_id, service_id FROM odd_trips) t
    FULL JOIN known_services s ON t.feed_id = s.feed_id AND t.service_id = s.service_id
    WHERE t.service_id IS NULL OR s.service_id IS NULL""",
    {"odd_trips": """
        SELECT 'F' || (l_suppkey % 4) AS feed_id,
               CASE WHEN l_suppkey % 10 = 3 THEN 'extra-' || l_suppkey
                    ELSE CAST(l_suppkey AS VARCHAR) END AS service_id FROM lineitem"""}))
def service_crosscheck(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    odd = F.when(F.col("service_id").cast("bigint") % 10 == 3,
                 F.concat(F.lit("extra-"), "service_id")).otherwise(F.col("service_id"))
    trips = lens._lineitem_trips().select("feed_id", odd.alias("service_id"))
    return quality.service_crosscheck(trips, lens.calendar(), lens.calendar_dates())


@R.add("stops_by_route", with_lenses("""
    SELECT t.feed_id, t.route_id, max(t.trip_count) AS trip_count,
           count(DISTINCT s.stop_id) AS stop_count, count(s.stop_id) AS call_count
    FROM (SELECT feed_id, route_id, count(*) AS trip_count FROM trips GROUP BY 1, 2) t
    LEFT JOIN (SELECT feed_id, route_id, stop_id FROM stop_calls JOIN trips USING (feed_id, trip_id)
               SEMI JOIN stops USING (feed_id, stop_id)) s
      ON s.feed_id = t.feed_id AND s.route_id = t.route_id
    GROUP BY t.feed_id, t.route_id"""))
def stops_by_route(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return quality.stops_by_route(lens.trips(), lens.stop_calls(), lens.stops())


@R.add("stops_by_area", with_lenses("""
    SELECT municipality, count(stop_id) AS stop_id_count,
           count(DISTINCT stop_name) AS stop_name_count
    FROM stops JOIN stop_area USING (feed_id, stop_id) GROUP BY municipality"""))
def stops_by_area(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return quality.stops_by_area(lens.stops(), lens.stop_area())


@R.add("feed_info_first_row", with_lenses("SELECT * FROM info_first"))
def feed_info_first_row(spark, sf_dir):
    return quality.feed_info_first_row(Lens(spark, sf_dir).feed_info())


@R.add("date_basis", with_lenses("""
    SELECT feed_id, feed_start_date, feed_end_date, c.lo AS calendar_start, c.hi AS calendar_end,
           c.n AS calendar_services, x.a0 AS added_min, x.a1 AS added_max, x.r0 AS removed_min,
           x.r1 AS removed_max, x.n AS exception_services
    FROM feeds LEFT JOIN info_first USING (feed_id)
    LEFT JOIN (SELECT feed_id, min(start_date) AS lo, max(end_date) AS hi,
                      count(DISTINCT service_id) AS n FROM cal GROUP BY feed_id) c USING (feed_id)
    LEFT JOIN (SELECT feed_id, min(date) FILTER (WHERE exception_type = 1) AS a0,
                      max(date) FILTER (WHERE exception_type = 1) AS a1,
                      min(date) FILTER (WHERE exception_type = 2) AS r0,
                      max(date) FILTER (WHERE exception_type = 2) AS r1,
                      count(DISTINCT service_id) AS n FROM cd GROUP BY feed_id) x USING (feed_id)"""))
def date_basis(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return fm.date_basis(
        lens.calendar_text_clean(), lens.calendar_dates_text(), lens.feed_info(), lens.feeds()
    ).selectExpr(
        "feed_id", "feed_info.feed_start_date", "feed_info.feed_end_date",
        "calendar.min_start_date as calendar_start", "calendar.max_end_date as calendar_end",
        "calendar.service_id_unique_count as calendar_services",
        "calendar_dates.added_date_min as added_min", "calendar_dates.added_date_max as added_max",
        "calendar_dates.removed_date_min as removed_min",
        "calendar_dates.removed_date_max as removed_max",
        "calendar_dates.service_id_unique_count as exception_services")


def _anchors(lens):
    """Required routes: one per part, a few of them under another name."""
    k = F.col("p_partkey")
    name = F.when(k % 700 == 0, F.concat(F.lit("Route "), k.cast("string"))).otherwise(
        F.concat(F.lit("Line "), k.cast("string")))
    return lens.table("part").select(
        F.concat(F.lit("F"), (F.call_function("div", k, F.lit(100)) % 4).cast("string"))
        .alias("feed_id"),
        k.cast("string").alias("route_id"), name.alias("expected_name"))


_ANCHORS = {"anchors": """
    SELECT 'F' || ((p_partkey // 100) % 4) AS feed_id, CAST(p_partkey AS VARCHAR) AS route_id,
           CASE WHEN p_partkey % 700 = 0 THEN 'Route ' ELSE 'Line ' END || p_partkey
               AS expected_name
    FROM part""",
    "anchor_result": """
    SELECT feed_id, route_id, expected_name, route_long_name AS actual_name,
           CASE WHEN row_idx IS NULL THEN 'missing_route' WHEN route_long_name IS NULL THEN 'missing_name'
                WHEN route_long_name <> expected_name THEN 'name_mismatch' END AS reason
    FROM anchors LEFT JOIN routes USING (feed_id, route_id)"""}


@R.add("anchor_check", with_lenses("SELECT * FROM anchor_result", _ANCHORS))
def anchor_check(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return quality.anchor_check(lens.routes(), _anchors(lens))


# -- services and trips -----------------------------------------------------------------------


@R.add("active_services", with_lenses("SELECT * FROM active"))
def active_services(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return service.active_services(lens.calendar(), lens.calendar_dates(), WEEK)


_DAILY = {
    "daily": """
        SELECT feed_id, service_date, coalesce(n, 0) AS trip_count
        FROM feeds CROSS JOIN target_dates LEFT JOIN (
            SELECT feed_id, service_date, count(*) AS n
            FROM active JOIN trips USING (feed_id, service_id) GROUP BY feed_id, service_date
        ) USING (feed_id, service_date)""",
    "daily_freq": """
        SELECT feed_id, service_date, coalesce(has_inexact, false) AS has_inexact,
               CASE WHEN coalesce(has_inexact, false) THEN NULL ELSE coalesce(n, 0) END
                   AS trip_count
        FROM feeds CROSS JOIN target_dates LEFT JOIN (
            SELECT feed_id, service_date,
                   CAST(sum(CASE WHEN inexact THEN 0 ELSE coalesce(departures, 1) END) AS BIGINT)
                       AS n,
                   bool_or(coalesce(inexact, false)) AS has_inexact
            FROM active JOIN trips USING (feed_id, service_id)
            LEFT JOIN (SELECT feed_id, trip_id, departures, inexact FROM freq)
                USING (feed_id, trip_id)
            GROUP BY feed_id, service_date
        ) USING (feed_id, service_date)""",
}


@R.add("scheduled_trips", with_lenses("SELECT * FROM daily", _DAILY))
def scheduled_trips(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return service.scheduled_trips(
        lens.feeds(), lens.calendar(), lens.calendar_dates(), lens.trips(), WEEK)


@R.add("freq_departures", with_lenses("""
    SELECT feed_id, trip_id, CASE WHEN inexact THEN NULL ELSE departures END AS departures, inexact
    FROM freq"""))
def freq_departures(spark, sf_dir):
    return service.frequency_by_trip(Lens(spark, sf_dir).frequencies())


@R.add("scheduled_trips_freq", with_lenses("SELECT * FROM daily_freq", _DAILY))
def scheduled_trips_freq(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return service.scheduled_trips(
        lens.feeds(), lens.calendar(), lens.calendar_dates(), lens.trips(), WEEK,
        service.frequency_by_trip(lens.frequencies()))


@R.add("weekday_uniform", with_lenses("""
    SELECT feed_id, is_uniform, CASE WHEN is_uniform THEN d[1] END AS weekday_trips,
           CASE WHEN NOT is_uniform THEN d[1] END AS monday,
           CASE WHEN NOT is_uniform THEN d[2] END AS tuesday,
           CASE WHEN NOT is_uniform THEN d[3] END AS wednesday,
           CASE WHEN NOT is_uniform THEN d[4] END AS thursday,
           CASE WHEN NOT is_uniform THEN d[5] END AS friday, d[6] AS saturday, d[7] AS sunday
    FROM (SELECT feed_id, list(trip_count ORDER BY service_date) AS d,
                 list_min(list(trip_count ORDER BY service_date)[1:5])
                   = list_max(list(trip_count ORDER BY service_date)[1:5]) AS is_uniform
          FROM daily GROUP BY feed_id)""", _DAILY))
def weekday_uniform(spark, sf_dir):
    return service.weekday_uniform(scheduled_trips(spark, sf_dir))


@R.add("comparison_week", with_lenses("""
    SELECT n_feeds, base_date,
           CASE WHEN ok THEN monday END AS week_start,
           CASE WHEN ok THEN CAST(monday + 6 AS DATE) END AS week_end,
           CASE WHEN n_feeds = 0 THEN 'not_calculable' WHEN ok THEN 'measured'
                ELSE 'not_comparable_no_common_week' END AS metric_status
    FROM (SELECT *, monday + 6 <= upper AS ok FROM (
        SELECT *, CAST(earliest + CAST((8 - isodow(earliest)) % 7 AS INTEGER) AS DATE) AS monday FROM (
            SELECT count(*) AS n_feeds, max(reference_date) AS base_date, min(cal_end) AS upper,
                   greatest(max(reference_date), max(cal_start)) AS earliest
            FROM bounds)))""",
    {"bounds": """
        SELECT feed_id, DATE '1995-06-01' + CAST(min(row_idx) * 20 AS INTEGER) AS reference_date,
               least(min(start_date), min(d0)) AS cal_start,
               greatest(max(end_date), max(d1)) AS cal_end
        FROM cal LEFT JOIN (SELECT feed_id, min(date) AS d0, max(date) AS d1 FROM cd GROUP BY 1)
             USING (feed_id)
        GROUP BY feed_id"""}))
def comparison_week(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    exc = lens.calendar_dates().groupBy("feed_id").agg(
        F.min("date").alias("d0"), F.max("date").alias("d1"))
    none = F.lit(None).cast("date")
    bounds = (
        lens.calendar().groupBy("feed_id")
        .agg(F.min("row_idx").alias("k"), F.min("start_date").alias("s"),
             F.max("end_date").alias("e"))
        .join(exc, "feed_id", "left")
        .select(
            "feed_id", F.lit("confirmed").alias("reference_status"),
            F.date_add(F.to_date(F.lit("1995-06-01")), (F.col("k") * 20).cast("int"))
            .alias("reference_date"),
            none.alias("info_start"), none.alias("info_end"),
            F.least("s", "d0").alias("cal_start"), F.greatest("e", "d1").alias("cal_end")))
    return service.comparison_week(bounds)


def _broken_ranges(lens):
    """Suppliers as feeds of six ranges with holes or overlaps, some with an info range, some unconfirmed."""
    k = F.col("s_suppkey")
    start = F.lit(date(1995, 1, 1))
    feeds = lens.table("supplier").select(k.cast("string").alias("feed_id"), k.alias("k"))
    days = lambda first, n: F.date_add(first, n.cast("int"))
    references = feeds.select(
        "feed_id", F.when(F.col("k") % 5 == 4, "unconfirmed").otherwise("confirmed").alias("reference_status"),
        F.when(F.col("k") % 7 != 6, days(start, 120 + (F.col("k") % 13) * 9)).alias("reference_date"),
        F.when(F.col("k") % 3 == 0, days(start, 150 + F.col("k") % 10)).alias("info_start"),
        F.when(F.col("k") % 2 == 0, days(start, 700 - F.col("k") % 30)).alias("info_end"))
    first = days(start, F.col("i") * 120 + (F.col("k") * 7) % 20)
    ranges = feeds.where("k % 11 <> 10").select("feed_id", "k", F.explode(F.array(*map(F.lit, range(6)))).alias("i")).select(
        "feed_id", first.alias("start_date"), days(first, 92 + (F.col("k") * 11) % 40).alias("end_date"))
    return references, ranges


_RANGES = {
    "refs": """
        SELECT CAST(s_suppkey AS VARCHAR) AS feed_id,
               CASE WHEN s_suppkey % 7 <> 6 THEN DATE '1995-01-01' + CAST(120 + (s_suppkey % 13) * 9 AS INTEGER) END AS reference_date,
               CASE WHEN s_suppkey % 3 = 0 THEN DATE '1995-01-01' + CAST(150 + s_suppkey % 10 AS INTEGER) END AS info_start,
               CASE WHEN s_suppkey % 2 = 0 THEN DATE '1995-01-01' + CAST(700 - s_suppkey % 30 AS INTEGER) END AS info_end
        FROM supplier WHERE s_suppkey % 5 <> 4 AND s_suppkey % 7 <> 6""",
    "rng": """
        SELECT CAST(s_suppkey AS VARCHAR) AS feed_id, a AS start_date, a + CAST(92 + (s_suppkey * 11) % 40 AS INTEGER) AS end_date
        FROM (SELECT s_suppkey, DATE '1995-01-01' + CAST(i * 120 + (s_suppkey * 7) % 20 AS INTEGER) AS a
              FROM supplier, (SELECT unnest(range(6)) AS i) WHERE s_suppkey % 11 <> 10)""",
    "lim": """
        SELECT feed_id, reference_date, info_start, coalesce(info_end, e) AS upper, info_end
        FROM refs LEFT JOIN (SELECT feed_id, max(end_date) AS e FROM rng GROUP BY feed_id) USING (feed_id)""",
    "weeks": """
        SELECT feed_id, monday FROM (
            SELECT feed_id, monday, d FROM lim, (SELECT DATE '1995-01-02' + CAST(7 * unnest(range(130)) AS INTEGER) AS monday),
                   (SELECT CAST(unnest(range(7)) AS INTEGER) AS d)
            WHERE (info_start IS NULL OR monday + d >= info_start) AND (info_end IS NULL OR monday + d <= info_end))
        SEMI JOIN rng ON rng.feed_id = feed_id AND monday + d BETWEEN start_date AND end_date
        GROUP BY feed_id, monday HAVING count(*) = 7""".replace("rng.feed_id = feed_id", "rng.feed_id = unnamed_subquery.feed_id"),
}


@R.add("own_weeks", with_lenses("""
    SELECT feed_id, w AS week_start, CASE WHEN upper IS NULL THEN 'not_calculable' WHEN w IS NULL THEN 'no_week_in_range'
           ELSE 'measured' END AS metric_status
    FROM lim LEFT JOIN (SELECT feed_id, CAST(min(monday) AS DATE) AS w FROM weeks JOIN lim USING (feed_id)
                        WHERE monday >= reference_date AND monday + 6 <= upper GROUP BY feed_id) USING (feed_id)""", _RANGES))
def own_weeks(spark, sf_dir):
    return service.own_weeks(*_broken_ranges(Lens(spark, sf_dir)))


@R.add("common_week", with_lenses("""
    SELECT n_feeds, base_date, w AS week_start, CAST(w + 6 AS DATE) AS week_end,
           CASE WHEN w IS NULL THEN 'not_comparable_no_common_week' ELSE 'measured' END AS metric_status
    FROM (SELECT count(*) AS n_feeds, max(reference_date) AS base_date FROM lim SEMI JOIN rng USING (feed_id)),
         (SELECT CAST(min(monday) AS DATE) AS w FROM (
              SELECT monday, count(*) AS n FROM weeks SEMI JOIN (SELECT feed_id FROM lim SEMI JOIN rng USING (feed_id)) USING (feed_id)
              GROUP BY monday)
          WHERE n = (SELECT count(*) FROM lim SEMI JOIN rng USING (feed_id))
            AND monday >= (SELECT max(reference_date) FROM lim SEMI JOIN rng USING (feed_id))
            AND monday + 6 <= (SELECT min(upper) FROM lim SEMI JOIN rng USING (feed_id)))""", _RANGES))
def common_week(spark, sf_dir):
    """Over the feeds that have ranges; one without makes the week incalculable (see the tests)."""
    references, ranges = _broken_ranges(Lens(spark, sf_dir))
    known = ranges.select("feed_id").distinct()
    return service.common_week(references.join(known, "feed_id", "left_semi"), ranges)


# -- feed verdict and metrics -----------------------------------------------------------------

_VERDICT = {
    "violations": """
        SELECT feed_id, 'trips:duplicate_trip_id' AS reason, 5 AS table_rank, 5 AS check_rank,
               min(row_idx) AS row_idx
        FROM (SELECT feed_id, row_idx,
                     row_number() OVER (PARTITION BY feed_id, trip_id ORDER BY row_idx) AS rn
              FROM trips_dirty) WHERE rn = 2 GROUP BY feed_id
        UNION ALL
        SELECT feed_id, 'trips:unknown_route', 5, 8, min(row_idx)
        FROM trips_dirty ANTI JOIN routes USING (feed_id, route_id) GROUP BY feed_id
        UNION ALL
        SELECT feed_id, 'trips:unknown_service', 5, 9, min(row_idx)
        FROM trips_dirty ANTI JOIN known_services USING (feed_id, service_id) GROUP BY feed_id
        UNION ALL
        SELECT feed_id, 'frequencies:unknown_trip', 6, 3, min(row_idx)
        FROM freq_dirty ANTI JOIN trips_dirty USING (feed_id, trip_id) GROUP BY feed_id""",
    "verdict": """
        SELECT feed_id, v IS NULL AS is_valid, v.reason AS reason, v.row_idx AS row_idx
        FROM feeds LEFT JOIN (
            SELECT feed_id, first(struct_pack(reason, row_idx)
                                  ORDER BY table_rank, row_idx, check_rank) AS v
            FROM violations GROUP BY feed_id) USING (feed_id)""",
    "structure": """
        SELECT feed_id, 'gtfs_agency_record_count' AS metric_id,
               CASE WHEN feed_id <> 'F3' THEN n END AS value,
               CASE WHEN feed_id = 'F3' THEN 'not_calculable' ELSE 'measured' END AS metric_status,
               CASE WHEN feed_id = 'F3' THEN 'agency:absent' END AS reason
        FROM feeds LEFT JOIN (SELECT feed_id, count(*) AS n FROM agency GROUP BY 1) USING (feed_id)
        UNION ALL
        SELECT feed_id, 'gtfs_route_id_count', count(route_id), 'measured', NULL
        FROM feeds LEFT JOIN routes USING (feed_id) GROUP BY feed_id
        UNION ALL
        SELECT feed_id, 'gtfs_boarding_location_id_count',
               count(CASE WHEN location_type IN ('', '0') THEN stop_id END), 'measured', NULL
        FROM feeds LEFT JOIN stops USING (feed_id) GROUP BY feed_id""",
    "daily_dirty": """
        SELECT feed_id, service_date, coalesce(has_inexact, false) AS has_inexact,
               coalesce(n, 0) AS n
        FROM feeds CROSS JOIN target_dates LEFT JOIN (
            SELECT feed_id, service_date,
                   CAST(sum(CASE WHEN inexact THEN 0 ELSE coalesce(departures, 1) END) AS BIGINT)
                       AS n,
                   bool_or(coalesce(inexact, false)) AS has_inexact
            FROM active JOIN trips_dirty USING (feed_id, service_id)
            LEFT JOIN (SELECT feed_id, trip_id, departures, inexact FROM freq_dirty)
                USING (feed_id, trip_id)
            GROUP BY feed_id, service_date
        ) USING (feed_id, service_date)""",
    "metrics": """
        SELECT feed_id, metric_id, CAST(NULL AS DATE) AS service_date, value, metric_status, reason
        FROM structure
        UNION ALL
        SELECT feed_id, 'scheduled_trip_count_by_date', service_date,
               CASE WHEN is_valid AND NOT has_inexact THEN n END,
               CASE WHEN NOT is_valid THEN 'invalid_input'
                    WHEN has_inexact THEN 'not_exact_frequency_based' ELSE 'measured' END,
               CASE WHEN NOT is_valid THEN reason
                    WHEN has_inexact THEN 'frequencies:inexact_times' END
        FROM daily_dirty JOIN verdict USING (feed_id)""",
}


@R.add("feed_violations", with_lenses("SELECT * FROM violations", _VERDICT))
def feed_violations(spark, sf_dir):
    return fm.feed_violations(fm.feed_checks(Lens(spark, sf_dir).feed_tables(), WEEK))


@R.add("feed_verdict", with_lenses("SELECT * FROM verdict", _VERDICT))
def feed_verdict(spark, sf_dir):
    return fm.feed_verdict(fm.feed_checks(Lens(spark, sf_dir).feed_tables(), WEEK))


@R.add("structure_metrics", with_lenses("SELECT * FROM structure", _VERDICT))
def structure_metrics(spark, sf_dir):
    return fm.structure_metrics(Lens(spark, sf_dir).feed_tables())


@R.add("feed_supply_metrics", with_lenses("SELECT * FROM metrics", _VERDICT))
def feed_supply_metrics(spark, sf_dir):
    return fm.feed_supply_metrics(Lens(spark, sf_dir).feed_tables(), WEEK)


@R.add("independent_feed_metrics", with_lenses("""
    SELECT feed_id, metric_id, service_date, anchor_count,
           'whole_feed' AS measurement_scope, 'independent_not_comparable' AS comparison_mode,
           CASE WHEN anchor_reason IS NULL THEN value END AS value,
           CASE WHEN anchor_reason IS NULL THEN metric_status ELSE 'invalid_input' END
               AS metric_status,
           CASE WHEN anchor_reason IS NULL THEN reason ELSE 'anchor:' || anchor_reason END AS reason
    FROM metrics JOIN (SELECT feed_id, count(*) AS anchor_count, min(reason) AS anchor_reason
                       FROM anchor_result GROUP BY feed_id) USING (feed_id)""",
    {**_VERDICT, **_ANCHORS}))
def independent_feed_metrics(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return fm.independent_feed_metrics(lens.feed_tables(), WEEK, _anchors(lens))
