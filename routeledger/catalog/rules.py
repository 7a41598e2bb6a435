"""Every precondition of a feed's trip counts, on feeds that break one each.

Feed ``G<k>`` breaks the k-th rule on some of its rows, G0 none, G38 and G39 several. The tables of both sides are
the same expressions; the rules are evaluated apart, here in SQL and by the library.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.catalog import Registry
from routeledger.lens_sql import with_lenses
from routeledger.lenses import WEEK, Lens
from routeledger.plans import feed_metrics as fm

R = Registry()

_FEED = {"feed_id": "'G' || CAST(l_partkey % 40 AS STRING)", "k": "CAST(l_partkey % 40 AS INT)"}
# distinct rows of lineitem that tables are made from
_BASE = {
    "calls": {
        **_FEED, "l_partkey": "l_partkey", "l_suppkey": "l_suppkey", "l_linenumber": "l_linenumber",
        "pos": "l_orderkey * 8 + l_linenumber", "bad": "(l_orderkey * 8 + l_linenumber) % 5 = 3",
        "id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
              "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"},
    "lines": {**_FEED, "pos": "l_partkey", "bad": "l_partkey % 3 = 1"},
    "services": {**_FEED, "pos": "l_suppkey", "bad": "l_suppkey % 3 = 1"},
    "days": {
        **_FEED, "l_suppkey": "l_suppkey",
        "d": "year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)",
        "pos": "l_suppkey * 100000000 + year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)",
        "bad": "day(l_shipdate) % 5 = 3"},
}
# the numbers that all cells of such a row follow from: rows are told apart by these alone
_NUMBERS = {
    "calls": {c: c for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")},
    "lines": {"l_partkey": "l_partkey"},
    "services": {"l_partkey": "l_partkey % 40", "l_suppkey": "l_suppkey"},
    "days": {"l_partkey": "l_partkey % 40", "l_suppkey": "l_suppkey", "l_shipdate": "CAST(l_shipdate AS DATE)"},
}
_AS_POS = "CAST(pos AS STRING)"
_FLAGS = {d: f"CASE WHEN pos % {i + 2} = 0 THEN '0' ELSE '1' END" for i, d in enumerate(V.WEEKDAYS)}
_FLAGS["wednesday"] = "CASE WHEN k = 13 AND bad THEN '2' ELSE '1' END"
_FLAGS["sunday"] = "CASE WHEN k <> 8 THEN '0' END"
# table -> (rows it is made from, columns, rows it has, rows that it holds twice)
_TABLES = {
    "routes": ("lines", {
        "route_id": f"CASE WHEN k = 3 THEN NULL WHEN k = 4 AND bad THEN '' ELSE {_AS_POS} END",
    }, "k NOT IN (1, 2)", "k = 5 AND bad"),
    "calendar": ("services", {
        "service_id": f"CASE WHEN k = 9 AND bad THEN '　' ELSE {_AS_POS} END", **_FLAGS,
        "start_date": "CASE WHEN k IN (11, 39) AND bad THEN '1996-01-01' WHEN k = 12 AND bad THEN '19990101' "
                      "ELSE '19950101' END",
        "end_date": "CASE WHEN k = 11 AND pos % 2 = 0 THEN '19980230' ELSE '19981231' END",
    }, "k NOT IN (6, 7)", "k = 10 AND bad"),
    "calendar_dates": ("days", {
        "service_id": "CASE WHEN k = 16 AND bad THEN '' ELSE CAST(l_suppkey AS STRING) END",
        "date": "CASE WHEN k = 17 AND bad THEN '1996/04/01' ELSE CAST(d AS STRING) END",
        "exception_type": "CASE WHEN k = 15 THEN NULL WHEN k = 18 AND bad THEN '3' WHEN d % 2 = 0 THEN '1' "
                          "ELSE '2' END",
    }, "k NOT IN (6, 14)", "k IN (19, 39) AND bad"),
    "trips": ("calls", {
        "trip_id": "CASE WHEN k = 23 AND bad THEN '　' ELSE id END",
        "service_id": "CASE WHEN k = 25 AND bad THEN '' WHEN k IN (28, 38) AND bad THEN 'none' "
                      "ELSE CAST(l_suppkey AS STRING) END",
        "route_id": "CASE WHEN k = 22 THEN NULL WHEN k = 26 AND bad OR k = 38 AND pos % 7 = 2 THEN ' ' "
                    "WHEN k = 27 AND bad THEN 'none' ELSE CAST(l_partkey AS STRING) END",
    }, "k NOT IN (20, 21)", "k IN (24, 38) AND bad"),
    "frequencies": ("calls", {
        "trip_id": "CASE WHEN k = 31 AND bad THEN 'none-' || id ELSE id END",
        "start_time": "CASE WHEN k = 30 THEN NULL WHEN k = 32 AND bad THEN '6:60:00' ELSE '6:00:00' END",
        "end_time": "CASE WHEN k = 34 AND bad THEN '06:00:00' WHEN k = 36 AND bad THEN '07:05:00' "
                    "ELSE '07:00:00' END",
        "headway_secs": "CASE WHEN k = 33 AND bad THEN '0' ELSE '600' END",
        "exact_times": "CASE WHEN k IN (35, 39) AND bad THEN '2' ELSE '1' END",
    }, "k <> 29 AND l_linenumber <= 3", "k = 37 AND bad"),
}
_COPY = "1000000000000000"
# what files are like: feed -> (files absent), (file not UTF-8), (column not in the header)
_ABSENT = {1: ("routes",), 6: ("calendar", "calendar_dates"), 20: ("trips",)}
_UNDECODABLE = {2: "routes", 7: "calendar", 14: "calendar_dates", 21: "trips", 29: "frequencies"}
_LACKING = {3: ("routes", "route_id"), 8: ("calendar", "sunday"), 15: ("calendar_dates", "exception_type"),
            22: ("trips", "route_id"), 30: ("frequencies", "start_time")}


def rule_feeds(lens: Lens) -> fm.FeedTables:
    """The tables of feeds G0 to G39 over all rows of lineitem."""
    li = lens.table("lineitem")
    base = {n: li.selectExpr(*[f"{e} AS {c}" for c, e in _NUMBERS[n].items()]).distinct().selectExpr("*", *[
        f"{e} AS {c}" for c, e in cols.items() if c not in _NUMBERS[n]]) for n, cols in _BASE.items()}

    def table(name):
        """Rows and their copies from one read."""
        source, cols, kept, twice = _TABLES[name]
        copies = F.expr(f"explode(array(CASE WHEN {kept} THEN 0L END, CASE WHEN {twice} THEN {_COPY} END))")
        return base[source].where(f"{kept} OR {twice}").withColumn("copy", copies).where("copy IS NOT NULL").selectExpr(
            "feed_id", "pos + copy AS row_idx", *[f"{e} AS {c}" for c, e in cols.items()])

    def known(names):
        return F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f"{f}.txt").alias("f")) for k, f in names])

    feeds = li.selectExpr("l_partkey % 40 AS l_partkey").distinct().selectExpr(*[f"{e} AS {c}" for c, e in _FEED.items()])
    rows = F.array(*[
        F.struct(F.lit(f"{t}.txt").alias("file_name"), F.array(*map(F.lit, _TABLES[t][1])).alias("header"))
        for t in _TABLES])
    here = F.struct(F.col("k"), F.col("x.file_name").alias("f"))
    absent = F.array_contains(known([(k, f) for k, names in _ABSENT.items() for f in names]), here)
    broken = F.array_contains(known(_UNDECODABLE.items()), here)
    header = F.col("x.header")
    for k, (name, column) in _LACKING.items():
        header = F.when((F.col("k") == k) & (F.col("x.file_name") == f"{name}.txt"),
                        F.array_remove(F.col("x.header"), column)).otherwise(header)
    status = feeds.select("feed_id", "k", F.explode(rows).alias("x")).select(
        "feed_id", "x.file_name", (~absent).alias("present"), F.when(broken, "not utf-8").alias("decode_error"),
        F.when(~absent & ~broken, header).alias("header"))
    none = feeds.where(F.lit(False))
    return fm.FeedTables(
        feeds=feeds.select("feed_id"), file_status=status, agency=none, stops=none, **{t: table(t) for t in _TABLES})


def _table_sql(name: str) -> str:
    source, cols, kept, twice = _TABLES[name]
    cells = ", ".join(f"{e} AS {c}" for c, e in cols.items())
    return (f"SELECT feed_id, pos AS row_idx, {cells} FROM g_{source} WHERE {kept} "
            f"UNION ALL SELECT feed_id, pos + {_COPY}, {', '.join(cols.values())} FROM g_{source} WHERE {twice}")


_RULE_SQL = {
    **{f"g_{n}": "SELECT DISTINCT " + ", ".join(f"{e} AS {c}" for c, e in cols.items()) + " FROM lineitem"
       for n, cols in _BASE.items()},
    **{f"g_{t}": _table_sql(t) for t in _TABLES},
    "g_feeds": "SELECT DISTINCT feed_id, k FROM g_lines",
    "g_route_ranks": """
        SELECT *, trim(route_id, ' 　') = '' AS blank,
               row_number() OVER (PARTITION BY feed_id, route_id ORDER BY row_idx) AS rn FROM g_routes""",
    "g_calendar_ranks": """
        SELECT *, trim(service_id, ' 　') = '' AS blank, try_strptime(start_date, '%Y%m%d') AS s,
               try_strptime(end_date, '%Y%m%d') AS e,
               row_number() OVER (PARTITION BY feed_id, service_id ORDER BY row_idx) AS rn FROM g_calendar""",
    "g_date_ranks": """
        SELECT *, trim(service_id, ' 　') = '' AS blank,
               row_number() OVER (PARTITION BY feed_id, service_id, date ORDER BY row_idx) AS rn
        FROM g_calendar_dates""",
    "g_trip_ranks": """
        SELECT *, trim(trip_id, ' 　') = '' AS blank,
               row_number() OVER (PARTITION BY feed_id, trip_id ORDER BY row_idx) AS rn FROM g_trips""",
    "g_first_trips": "SELECT * FROM g_trip_ranks WHERE rn = 1 AND NOT blank",
    "g_known": "SELECT feed_id, service_id FROM g_calendar UNION SELECT feed_id, service_id FROM g_calendar_dates",
    "g_windows": """
        SELECT *, CASE WHEN regexp_full_match(start_time, '[0-9]{1,3}:[0-5][0-9]:[0-5][0-9]') THEN
                  CAST(split_part(start_time, ':', 1) AS INT) * 3600 + CAST(split_part(start_time, ':', 2) AS INT) * 60
                  + CAST(split_part(start_time, ':', 3) AS INT) END AS s,
               CASE WHEN regexp_full_match(end_time, '[0-9]{1,3}:[0-5][0-9]:[0-5][0-9]') THEN
                  CAST(split_part(end_time, ':', 1) AS INT) * 3600 + CAST(split_part(end_time, ':', 2) AS INT) * 60
                  + CAST(split_part(end_time, ':', 3) AS INT) END AS e,
               CAST(headway_secs AS BIGINT) AS h,
               row_number() OVER (PARTITION BY feed_id, trip_id, start_time ORDER BY row_idx) AS rn
        FROM g_frequencies""",
    "g_broken": """
        SELECT feed_id, reason, CAST(-1 AS BIGINT) AS row_idx
        FROM g_feeds JOIN (VALUES (1, 'routes:absent'), (2, 'routes:undecodable'), (3, 'routes:missing_column'),
            (6, 'calendars:both_absent'), (7, 'calendar:undecodable'), (8, 'calendar:missing_column'),
            (14, 'calendar_dates:undecodable'), (15, 'calendar_dates:missing_column'), (20, 'trips:absent'),
            (21, 'trips:undecodable'), (22, 'trips:missing_column'), (29, 'frequencies:undecodable'),
            (30, 'frequencies:missing_column')) AS t(k, reason) USING (k)
        UNION ALL SELECT feed_id, 'routes:blank_route_id', -1 FROM g_route_ranks WHERE blank
        UNION ALL SELECT feed_id, 'routes:duplicate_route_id', -1 FROM g_route_ranks WHERE NOT blank AND rn = 2
        UNION ALL SELECT feed_id, 'calendar:blank_service_id', row_idx FROM g_calendar_ranks WHERE blank
        UNION ALL SELECT feed_id, 'calendar:duplicate_service_id', row_idx FROM g_calendar_ranks WHERE NOT blank AND rn = 2
        UNION ALL SELECT feed_id, 'calendar:invalid_date', row_idx FROM g_calendar_ranks
        WHERE NOT blank AND rn = 1 AND (s IS NULL OR e IS NULL)
        UNION ALL SELECT feed_id, 'calendar:start_after_end', row_idx FROM g_calendar_ranks
        WHERE NOT blank AND rn = 1 AND s > e
        UNION ALL SELECT feed_id, 'calendar:invalid_weekday_flag', row_idx FROM g_calendar_ranks
        WHERE NOT blank AND rn = 1 AND regexp_matches(concat(monday, tuesday, wednesday, thursday, friday, saturday, sunday), '[^01]')
        UNION ALL SELECT feed_id, 'calendar_dates:blank_service_id', row_idx FROM g_date_ranks WHERE blank
        UNION ALL SELECT feed_id, 'calendar_dates:invalid_date', row_idx FROM g_date_ranks
        WHERE NOT blank AND try_strptime(date, '%Y%m%d') IS NULL
        UNION ALL SELECT feed_id, 'calendar_dates:invalid_exception_type', row_idx FROM g_date_ranks
        WHERE NOT blank AND exception_type NOT IN ('1', '2')
        UNION ALL SELECT feed_id, 'calendar_dates:duplicate_key', row_idx FROM g_date_ranks WHERE NOT blank AND rn = 2
        UNION ALL SELECT feed_id, 'trips:blank_trip_id', row_idx FROM g_trip_ranks WHERE blank
        UNION ALL SELECT feed_id, 'trips:duplicate_trip_id', row_idx FROM g_trip_ranks WHERE NOT blank AND rn = 2
        UNION ALL SELECT feed_id, 'trips:blank_service_id', row_idx FROM g_first_trips WHERE trim(service_id) = ''
        UNION ALL SELECT feed_id, 'trips:blank_route_id', row_idx FROM g_first_trips WHERE trim(route_id) = ''
        UNION ALL SELECT feed_id, 'trips:unknown_route', row_idx FROM g_first_trips
                         ANTI JOIN g_routes USING (feed_id, route_id) WHERE trim(route_id) <> ''
        UNION ALL SELECT feed_id, 'trips:unknown_service', row_idx FROM g_first_trips
                         ANTI JOIN g_known USING (feed_id, service_id) WHERE trim(service_id) <> ''
        UNION ALL SELECT feed_id, 'frequencies:unknown_trip', row_idx FROM g_windows ANTI JOIN g_trips USING (feed_id, trip_id)
        UNION ALL SELECT feed_id, 'frequencies:invalid_time', row_idx FROM g_windows WHERE s IS NULL OR e IS NULL
        UNION ALL SELECT feed_id, 'frequencies:invalid_headway', row_idx FROM g_windows WHERE h <= 0
        UNION ALL SELECT feed_id, 'frequencies:end_not_after_start', row_idx FROM g_windows WHERE e <= s
        UNION ALL SELECT feed_id, 'frequencies:invalid_exact_times', row_idx FROM g_windows
        WHERE exact_times NOT IN ('', '0', '1')
        UNION ALL SELECT feed_id, 'frequencies:not_divisible', row_idx FROM g_windows
        WHERE exact_times = '1' AND h > 0 AND (e - s) % h <> 0
        UNION ALL SELECT feed_id, 'frequencies:duplicate_key', row_idx FROM g_windows WHERE rn = 2""",
    "g_violations": f"""
        SELECT feed_id, reason, CAST(table_rank AS INT) AS table_rank, CAST(check_rank AS INT) AS check_rank,
               min(row_idx) AS row_idx
        FROM g_broken JOIN (VALUES {', '.join(f"('{r}', {t}, {c})" for r, (t, c) in fm.RULES.items())})
             AS t(reason, table_rank, check_rank) USING (reason) GROUP BY ALL""",
}


@R.add("feed_rules", with_lenses("SELECT * FROM g_violations", _RULE_SQL))
def feed_rules(spark, sf_dir):
    """The first row of every broken rule, each of all rules broken by some feed."""
    return fm.feed_violations(fm.feed_checks(rule_feeds(Lens(spark, sf_dir)), WEEK))


@R.add("feed_rules_verdict", with_lenses("""
    SELECT feed_id, v IS NULL AS is_valid, v.reason AS reason, v.row_idx AS row_idx
    FROM g_feeds LEFT JOIN (
        SELECT feed_id, first(struct_pack(reason, row_idx) ORDER BY table_rank, row_idx, check_rank) AS v
        FROM g_violations GROUP BY feed_id) USING (feed_id)""", _RULE_SQL))
def feed_rules_verdict(spark, sf_dir):
    """The rule that each feed is refused for."""
    return fm.feed_verdict(fm.feed_checks(rule_feeds(Lens(spark, sf_dir)), WEEK))
