"""SQL twins of the lenses, as common table expressions for the comparison queries."""

from __future__ import annotations

import re

WEEK_SQL = ", ".join(f"DATE '1996-04-0{i}'" for i in range(1, 8))
_DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
_FLAGS = ", ".join(
    f"CAST((mask >> {i}) & 1 AS VARCHAR) AS {d}" for i, d in enumerate(_DAYS)
)

CTES = {
    "feeds": "SELECT DISTINCT 'F' || (n_nationkey % 4) AS feed_id FROM nation",
    "target_dates": f"SELECT unnest([{WEEK_SQL}]) AS service_date",
    "cal": """
        SELECT 'F' || (s_suppkey % 4) AS feed_id, s_suppkey AS row_idx,
               CAST(s_suppkey AS VARCHAR) AS service_id,
               CAST((s_suppkey * 37 + 11) % 128 AS INTEGER) AS mask,
               DATE '1995-01-01' + CAST((s_suppkey * 13) % 700 AS INTEGER) AS start_date,
               DATE '1997-01-01' + CAST((s_suppkey * 29) % 900 AS INTEGER) AS end_date
        FROM supplier""",
    "cal_text": f"""
        SELECT feed_id, row_idx, service_id, {_FLAGS},
               CASE WHEN row_idx % 49 = 48 THEN strftime(start_date, '%Y-%m-%d')
                    ELSE strftime(start_date, '%Y%m%d') END AS start_date,
               strftime(end_date, '%Y%m%d') AS end_date
        FROM cal""".replace(
        "CAST((mask >> 0) & 1 AS VARCHAR)",
        "CASE WHEN row_idx % 97 = 96 THEN '2' ELSE CAST(mask & 1 AS VARCHAR) END"),
    "cd": """
        SELECT 'F' || (l_suppkey % 4) AS feed_id,
               l_suppkey * 10000 + date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE))
                   AS row_idx,
               CAST(l_suppkey AS VARCHAR) AS service_id, CAST(l_shipdate AS DATE) AS date,
               min(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2
                   ELSE 1 + (l_orderkey + l_suppkey) % 2 END) AS exception_type
        FROM lineitem
        GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "li": """
        SELECT 'F' || (l_suppkey % 4) AS feed_id, l_orderkey * 8 + l_linenumber AS row_idx,
               CAST(l_suppkey AS VARCHAR) AS service_id, l_partkey, l_orderkey, l_linenumber,
               l_quantity, l_orderkey || '-' || l_linenumber AS short_id
        FROM lineitem""",
    "trips": """
        SELECT feed_id, short_id || '-' || service_id AS trip_id, min(row_idx) AS row_idx,
               min(service_id) AS service_id, CAST(min(l_partkey) AS VARCHAR) AS route_id
        FROM li GROUP BY feed_id, short_id || '-' || service_id""",
    "trips_dirty": """
        SELECT feed_id, trip_id, row_idx, service_id,
               CASE WHEN feed_id = 'F2' AND row_idx % 4000 = 17 THEN 'X' ELSE route_id END
                   AS route_id
        FROM trips WHERE feed_id <> 'F1'
        UNION ALL
        SELECT feed_id, short_id, row_idx, service_id, CAST(l_partkey AS VARCHAR)
        FROM li WHERE feed_id = 'F1'""",
    "routes": """
        SELECT DISTINCT 'F' || (l_suppkey % 4) AS feed_id, l_partkey AS row_idx,
               CAST(l_partkey AS VARCHAR) AS route_id,
               CASE WHEN l_partkey % 450 <> 0 THEN 'Line ' || l_partkey END AS route_long_name
        FROM lineitem""",
    "stops": """
        SELECT 'F' || (c_nationkey % 4) AS feed_id, c_custkey AS row_idx,
               CAST(c_custkey AS VARCHAR) AS stop_id, 'Stop ' || (c_custkey % 97) AS stop_name,
               ['', '0', '1', '2', '0'][CAST(c_custkey % 5 + 1 AS INTEGER)] AS location_type
        FROM customer""",
    "agency": """
        SELECT 'F' || least(n_nationkey % 4, 2) AS feed_id, n_name AS agency_id
        FROM nation""",
    "info": """
        SELECT 'F' || (n_nationkey % 4) AS feed_id, n_nationkey // 4 AS row_idx, n_nationkey AS k,
               DATE '1995-01-01' + CAST(n_nationkey * 10 AS INTEGER) AS day FROM nation""",
    "info_first": """
        SELECT feed_id, CASE WHEN k % 4 <> 1 THEN day END AS feed_start_date,
               CASE WHEN k % 4 <> 2 THEN day + 400 END AS feed_end_date,
               'v' || k AS feed_version, k % 4 = 1 AS bad_start_date, false AS bad_end_date
        FROM info WHERE row_idx = 0""",
    "stop_times": """
        SELECT 'F' || (l_suppkey % 4) AS feed_id, CAST(l_orderkey AS VARCHAR) AS trip_id,
               CAST(l_linenumber AS VARCHAR) AS stop_sequence,
               l_orderkey * 8 + l_linenumber AS row_idx
        FROM lineitem""",
    "stop_calls": """
        SELECT feed_id, short_id || '-' || service_id AS trip_id,
               CAST(o_custkey AS VARCHAR) AS stop_id
        FROM li JOIN orders ON l_orderkey = o_orderkey""",
    "stop_area": """
        SELECT 'F' || (c_nationkey % 4) AS feed_id, CAST(c_custkey AS VARCHAR) AS stop_id,
               n_name AS municipality
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "freq": """
        SELECT feed_id, short_id || '-' || service_id AS trip_id,
               max(CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) ELSE 1 END)
                   AS departures, min(row_idx) AS row_idx, feed_id = 'F3' AS inexact
        FROM li GROUP BY feed_id, short_id || '-' || service_id""",
    "freq_dirty": """
        SELECT feed_id, CASE WHEN feed_id = 'F1' THEN short_id ELSE short_id || '-' || service_id END AS trip_id,
               max(CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) ELSE 1 END)
                   AS departures, min(row_idx) AS row_idx, feed_id = 'F3' AS inexact
        FROM li GROUP BY ALL""",
    "known_services": """
        SELECT feed_id, service_id FROM cal UNION SELECT feed_id, service_id FROM cd""",
    "active": """
        SELECT feed_id, service_id, service_date FROM cal, target_dates
        WHERE service_date BETWEEN start_date AND end_date
          AND (mask >> (isodow(service_date) - 1)) & 1 = 1
        UNION
        SELECT feed_id, service_id, date FROM cd
        WHERE exception_type = 1 AND date IN (SELECT service_date FROM target_dates)
        EXCEPT
        SELECT feed_id, service_id, date FROM cd WHERE exception_type = 2""",
}


def with_lenses(query: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix a query with the lens expressions it names, directly or through other lenses."""
    pool = {**CTES, **(ctes or {})}
    wanted: list[str] = []

    def visit(sql: str) -> None:
        for name in pool:
            if re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", sql) and name not in wanted:
                visit(pool[name])
                if name not in wanted:
                    wanted.append(name)

    visit(query)
    if not wanted:
        return query
    parts = ",\n".join(f"{n} AS ({pool[n].strip()})" for n in wanted)
    return f"WITH {parts}\n{query.strip()}"
