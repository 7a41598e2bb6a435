"""Facts of many feeds with every table read once: rows become lines of one shape, merged in four steps.

1. Of each key of each file the first two rows are kept; every map task drops the rest by itself.
2. One row per key: a trip with its windows, a service with its calendar rows and exceptions, a route, a stop.
3. One row per service and route of a feed: trips counted, days it runs on, known or not. Rules that
   broke and the counts of a feed are keys of this step too, so that they combine in the map tasks.
4. One row per feed.

A trip, service, route or feed with a third of all rows costs partial aggregates only. Nothing is joined.
Lines are copied in every step, so they are narrow: files and kinds are numbers, what is yes or no is a bit.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger.functions import gtfs
from routeledger.operators import quality, service
from routeledger.vocab import WEEKDAYS

FILE_LEVEL = -1

# rules decided on single rows of a key, by what the key names; the place in the list is the rule's slot
SLOTS = {
    "trip": (
        "trips:blank_trip_id", "trips:duplicate_trip_id", "frequencies:invalid_time",
        "frequencies:invalid_headway", "frequencies:end_not_after_start",
        "frequencies:invalid_exact_times", "frequencies:not_divisible", "frequencies:duplicate_key"),
    "service": (
        "calendar:blank_service_id", "calendar:duplicate_service_id", "calendar:invalid_date",
        "calendar:start_after_end", "calendar:invalid_weekday_flag",
        "calendar_dates:blank_service_id", "calendar_dates:invalid_date",
        "calendar_dates:invalid_exception_type", "calendar_dates:duplicate_key"),
    "route": ("routes:blank_route_id", "routes:duplicate_route_id"),
}
KINDS = {"trips": "trip", "frequencies": "trip", "calendar": "service", "calendar_dates": "service",
         "routes": "route", "stops": "stop", "agency": "agency"}
N_SLOTS = max(map(len, SLOTS.values()))
# what a line says besides its slots: a blank key, an inexact window, an exception that removes its day
BLANK, INEXACT, REMOVED = (1 << (N_SLOTS + i) for i in range(3))
FILE_NO = {f: i for i, f in enumerate(KINDS)}
KIND_NO = {k: i for i, k in enumerate(dict.fromkeys(KINDS.values()))}
# rules decided once trips have met their windows, services and routes
MERGED_RULES = ("trips:blank_service_id", "trips:blank_route_id", "trips:unknown_route",
                "trips:unknown_service", "frequencies:unknown_trip")
ROW_RULES = (*[r for rules in SLOTS.values() for r in rules], *MERGED_RULES)
COUNTED = ("agency", "routes", "stops")
CHECKED = ("routes", "calendar", "calendar_dates", "trips", "frequencies")


def rule_column(rule: str) -> str:
    return "v_" + rule.replace(":", "_")


def _lines(df: DataFrame, file: str, key: Column, broken: dict[str, Column] | None = None,
           flags: dict[int, Column] | None = None, **payload: Column) -> DataFrame:
    """Rows of a file as lines; the rules that a row alone decides (``broken``), ``flags`` and whether
    its key is blank are kept as bits, found once, before anything is sorted."""
    bits = F.when(gtfs.is_blank(key), BLANK).otherwise(0)
    for rule, cond in (broken or {}).items():
        slot = SLOTS[KINDS[file]].index(f"{file}:{rule}")
        bits = bits + F.when(cond, 1 << slot).otherwise(0)
    for bit, cond in (flags or {}).items():
        bits = bits + F.when(cond, bit).otherwise(0)
    return df.select(
        key.alias("key"), "feed_id", F.lit(KIND_NO[KINDS[file]]).alias("kind"), F.lit(FILE_NO[file]).alias("file"),
        "row_idx", bits.alias("bits"), *[c.alias(name) for name, c in payload.items()])


def _agency(df: DataFrame, dates: list[date]) -> DataFrame:
    return _lines(df, "agency", F.col("row_idx").cast("string"), n=F.lit(1).cast("bigint"))


def _routes(df: DataFrame, dates: list[date]) -> DataFrame:
    return _lines(df, "routes", F.col("route_id"))


def _stops(df: DataFrame, dates: list[date]) -> DataFrame:
    boarding = gtfs.strip(F.coalesce("location_type", F.lit(""))).isin("", "0")
    return _lines(df, "stops", F.col("stop_id"), n=boarding.cast("bigint"))


def _calendar(df: DataFrame, dates: list[date]) -> DataFrame:
    typed = df.select(
        "feed_id", "row_idx", "service_id", gtfs.weekday_mask([F.col(d) for d in WEEKDAYS]).alias("mask"),
        gtfs.gtfs_date(F.col("start_date")).alias("start_date"),
        gtfs.gtfs_date(F.col("end_date")).alias("end_date"),
        F.forall(F.array(*WEEKDAYS), lambda x: x.isin("0", "1")).alias("ok"))
    start, end = F.col("start_date"), F.col("end_date")
    return _lines(
        typed, "calendar", F.col("service_id"), {
            "invalid_date": start.isNull() | end.isNull(), "start_after_end": start > end,
            "invalid_weekday_flag": ~F.col("ok")},
        **{f"days{w}": c for w, c in enumerate(service.base_words(dates))})


def _calendar_dates(df: DataFrame, dates: list[date]) -> DataFrame:
    text, kind = F.col("date"), F.col("exception_type")
    hits = service.hit_words(dates, lambda d: text == d.strftime("%Y%m%d"))
    zero, number = F.lit(0).cast("bigint"), kind.try_cast("int")
    return _lines(
        df, "calendar_dates", F.col("service_id"),
        {"invalid_date": gtfs.gtfs_date(text).isNull(), "invalid_exception_type": ~kind.isin("1", "2")},
        {REMOVED: number == 2}, sub=text,
        **{f"days{w}": F.when(number.isin(1, 2), hit).otherwise(zero) for w, hit in enumerate(hits)})


def _trips(df: DataFrame, dates: list[date]) -> DataFrame:
    return _lines(df, "trips", F.col("trip_id"), service_id=F.col("service_id"), route_id=F.col("route_id"))


def _frequencies(df: DataFrame, dates: list[date]) -> DataFrame:
    w = service.frequency_windows(df).withColumn("exact", F.coalesce("exact_times", F.lit("")))
    timed = F.col("start_sec").isNotNull() & F.col("end_sec").isNotNull()
    exact = F.col("exact") == "1"
    return _lines(
        w, "frequencies", F.col("trip_id"), {
            "invalid_time": ~timed, "invalid_headway": F.col("headway").isNull(),
            "end_not_after_start": timed & (F.col("end_sec") <= F.col("start_sec")),
            "invalid_exact_times": ~F.col("exact").isin("", "0", "1"),
            "not_divisible": exact & ~F.col("divides")},
        {INEXACT: F.col("exact").isin("", "0")},
        sub=F.col("start_time"), n=F.when(exact, F.col("departures")).cast("bigint"))


_READERS = {"agency": _agency, "routes": _routes, "stops": _stops, "calendar": _calendar,
            "calendar_dates": _calendar_dates, "trips": _trips, "frequencies": _frequencies}


def _broken() -> str:
    """SQL of the slots whose rules a ranked line breaks, as bits."""
    cases = []
    for rules in SLOTS.values():
        for i, rule in enumerate(rules):
            file, check = rule.split(":")
            # checks that come before the key's also hold on a row that repeats a key
            if check.startswith("blank"):
                broken = "is_first AND blank"
            elif check.startswith("duplicate"):
                broken = "NOT is_first" if file == "frequencies" else "NOT is_first AND NOT blank"
            else:
                gate = {"frequencies": "", "calendar_dates": "NOT blank AND "}
                broken = gate.get(file, "is_first AND NOT blank AND ") + f"bits & {1 << i} != 0"
            cases.append(f"CASE WHEN file = {FILE_NO[file]} AND {broken} THEN {1 << i} ELSE 0 END")
    # nearly every line is the first of its key and breaks nothing
    return f"CASE WHEN is_first AND bits & {2 * BLANK - 1} = 0 THEN 0 ELSE {' | '.join(cases)} END"


def _item(kind: str, key: str, words: list[str], **cols: str) -> str:
    """SQL of a line of step 3; what a kind does not carry is NULL."""
    types = {"n": "bigint", "inexact": "boolean", "first_row": "bigint", "known": "boolean",
             "blank": "boolean", "repeated": "boolean", **{w: "bigint" for w in words}}
    cells = ", ".join(f"'{c}', CAST({cols.get(c, 'NULL')} AS {t})" for c, t in types.items())
    return f"named_struct('kind', '{kind}', 'key', {key}, {cells})"


def feed_facts(tables: dict[str, DataFrame], dates: list[date]) -> DataFrame:
    """One row per feed with rows in ``tables`` (file name without ending -> text table).

    Columns: v_<rule>, the first row that breaks each row rule; n<i> and x<i>, trips and whether
    an inexact one runs on dates[i]; <file>_value, <file>_blank, <file>_repeated of the counted files.
    """
    n_words = -(-len(dates) // service.DAYS_PER_WORD)
    words = [f"{k}{w}" for k in ("base", "added", "removed") for w in range(n_words)]
    blanks = {"sub": "string", "n": "bigint", "service_id": "string", "route_id": "string",
              **{f"days{w}": "bigint" for w in range(n_words)}}
    parts = []
    for file, df in tables.items():
        part = _READERS[file](df, dates)
        parts.append(part.withColumns({
            c: F.lit(None).cast(t) for c, t in blanks.items() if c not in part.columns}))
    lines = reduce(DataFrame.unionByName, parts)

    ranked = quality.second_occurrence(lines, ["key", "feed_id", "kind", "file", "sub"]).withColumns({
        "row_idx": F.col("row_idx").cast("bigint"), "is_first": F.col("rn") == 1,
        "blank": F.when(F.col("key").isNotNull(), F.col("bits").bitwiseAND(BLANK) != 0)}).withColumns({
        "broken": F.expr(_broken()),
        "broken_row": F.when(F.col("file") == FILE_NO["routes"], FILE_LEVEL).otherwise(F.col("row_idx"))})
    trips, windows = f"file = {FILE_NO['trips']}", f"file = {FILE_NO['frequencies']}"
    days = {"base": f"file = {FILE_NO['calendar']}",
            "added": f"file = {FILE_NO['calendar_dates']} AND bits & {REMOVED} = 0",
            "removed": f"file = {FILE_NO['calendar_dates']} AND bits & {REMOVED} != 0"}
    keys = ranked.groupBy("key", "feed_id", "kind").agg(*map(F.expr, (
        f"min(row_idx) FILTER (WHERE {trips}) AS trip_row",
        f"min(row_idx) FILTER (WHERE {windows}) AS freq_row",
        f"max(service_id) FILTER (WHERE {trips} AND is_first) AS service_id",
        f"max(route_id) FILTER (WHERE {trips} AND is_first) AS route_id",
        f"sum(n) FILTER (WHERE NOT {windows} OR is_first) AS n",
        f"max(is_first AND bits & {INEXACT} != 0) AS inexact", "max(NOT is_first) AS repeated",
        "max(blank) AS blank",
        *[f"bit_or(days{w}) FILTER (WHERE {c}) AS {k}{w}" for k, c in days.items() for w in range(n_words)],
        *[f"min(broken_row) FILTER (WHERE broken & {1 << i} != 0) AS slot{i}" for i in range(N_SLOTS)])))
    lines = keys.select("feed_id", F.explode(_items(words)).alias("x")).where(F.col("x").isNotNull())
    merged = lines.groupBy("x.key", "feed_id", "x.kind").agg(*map(F.expr, (
        "sum(x.n) AS n", "min(x.first_row) AS first_row",
        *[f"max(x.{c}) AS {c}" for c in ("inexact", "known", "blank", "repeated")],
        *[f"bit_or(x.{w}) AS {w}" for w in words])))
    return _per_feed(merged.na.fill(0, words), dates, n_words)


def _items(words: list[str]) -> Column:
    """Lines of step 3 from a row per key: its service and route, or itself, its count, its broken rules."""
    trip_row = "CASE WHEN NOT blank THEN trip_row END"
    no_key = "coalesce(blank, true)"
    problems = {"blank": no_key, "repeated": f"NOT {no_key} AND repeated"}
    own = {w: w for w in words}
    trip_service = _item(
        "service", "service_id", words, inexact="coalesce(inexact, false)", first_row=trip_row,
        n="CASE WHEN NOT coalesce(inexact, false) THEN coalesce(n, 1) END")
    stop = _item("count", "'stops'", words, n=f"CASE WHEN {no_key} THEN 0 ELSE n END", **problems)
    items = [
        f"""CASE WHEN kind = {KIND_NO['trip']} AND trip_row IS NOT NULL THEN {trip_service}
            WHEN kind = {KIND_NO['service']} THEN {_item("service", "key", words, known="true", **own)}
            WHEN kind = {KIND_NO['route']} THEN {_item("count", "'routes'", words, n=f"NOT {no_key}", **problems)}
            WHEN kind = {KIND_NO['stop']} THEN {stop}
            WHEN kind = {KIND_NO['agency']} THEN {_item("count", "'agency'", words, n="n")} END""",
        f"""CASE WHEN kind = {KIND_NO['trip']} AND trip_row IS NOT NULL
            THEN {_item("route", "route_id", words, first_row=trip_row)}
            WHEN kind = {KIND_NO['route']} THEN {_item("route", "key", words, known="true")} END""",
    ]
    for i in range(N_SLOTS):
        names = " ".join(f"WHEN {KIND_NO[k]} THEN '{r[i]}'" for k, r in SLOTS.items() if i < len(r))
        rule = _item("rule", f"CASE kind {names} END", words, first_row=f"slot{i}")
        items.append(f"CASE WHEN slot{i} IS NOT NULL THEN {rule} END")
    alone = _item("rule", "'frequencies:unknown_trip'", words, first_row="freq_row")
    items.append(f"CASE WHEN freq_row IS NOT NULL AND (trip_row IS NULL OR key IS NULL) THEN {alone} END")
    # exploding a plain array and dropping NULLs keeps the planner from evaluating it twice
    return F.expr(f"array({', '.join(items)})")


def _per_feed(merged: DataFrame, dates: list[date], n_words: int) -> DataFrame:
    conditions = {
        **{r: f"kind = 'rule' AND key = '{r}'" for r in ROW_RULES},
        "trips:blank_service_id": "kind = 'service' AND no_key",
        "trips:blank_route_id": "kind = 'route' AND no_key",
        "trips:unknown_service": "kind = 'service' AND NOT no_key AND known IS NULL",
        "trips:unknown_route": "kind = 'route' AND NOT no_key AND known IS NULL",
    }
    cols = [f"min(first_row) FILTER (WHERE {c}) AS {rule_column(r)}" for r, c in conditions.items()]
    for i in range(len(dates)):
        w, bit = i // service.DAYS_PER_WORD, 1 << (i % service.DAYS_PER_WORD)
        on = f"kind = 'service' AND coalesce(day_mask[{w}] & {bit}L != 0, false)"
        cols.append(f"coalesce(sum(n) FILTER (WHERE {on}), 0) AS n{i}")
        cols.append(f"max({on} AND coalesce(inexact, false)) AS x{i}")
    for f in COUNTED:
        here = f"kind = 'count' AND key = '{f}'"
        cols += [f"sum(n) FILTER (WHERE {here}) AS {f}_value",
                 *[f"max({here} AND {c}) AS {f}_{c}" for c in ("blank", "repeated")]]
    return merged.withColumns(
        {"day_mask": service.mask_of(n_words), "no_key": gtfs.is_blank(F.col("key"))}
    ).groupBy("feed_id").agg(*map(F.expr, cols))
