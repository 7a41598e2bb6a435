"""Synthetic archives through the whole path: archive -> lines -> tables -> metrics."""

import copy
import io
import zipfile
from datetime import date, timedelta

import pytest

from routeledger.operators import quality, safety
from routeledger.plans import archive_feeds
from routeledger.plans import feed_metrics as fm
from routeledger.sources import archives, sinks

WEEK = [date(2026, 5, 4) + timedelta(days=i) for i in range(7)]
MON, TUE, SUN = WEEK[0], WEEK[1], WEEK[6]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

BASE = {
    "agency.txt": [["agency_id", "agency_name"], ["A1", "Agency"]],
    "routes.txt": [["route_id", "agency_id", "route_long_name"], ["R1", "A1", "One"], ["R2", "A1", "Two"]],
    "stops.txt": [["stop_id", "stop_name", "location_type"],
                  ["S1", "a", "0"], ["S2", "b", ""], ["S3", "c", "1"]],
    "calendar.txt": [["service_id", *DAYS, "start_date", "end_date"],
                     ["WEEKDAY", "1", "1", "1", "1", "1", "0", "0", "20260401", "20270331"]],
    "trips.txt": [["route_id", "service_id", "trip_id"],
                  ["R1", "WEEKDAY", "T1"], ["R1", "WEEKDAY", "T2"]],
}
FREQ = ["trip_id", "start_time", "end_time", "headway_secs", "exact_times"]
CD = ["service_id", "date", "exception_type"]


def zip_bytes(files):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in files.items():
            if isinstance(content, list):
                content = "".join(",".join(row) + "\n" for row in content)
            z.writestr(name, content)
    return buffer.getvalue()


def base(**changes):
    files = copy.deepcopy(BASE)
    for name, content in changes.items():
        key = name + ".txt"
        if content is None:
            files.pop(key, None)
        else:
            files[key] = content
    return files


def with_rows(table, *new):
    return copy.deepcopy(BASE[table]) + [list(r) for r in new]


def drop_column(table, column):
    i = BASE[table][0].index(column)
    return [[c for k, c in enumerate(row) if k != i] for row in BASE[table]]


def calendar(**cells):
    header, row = copy.deepcopy(BASE["calendar.txt"])
    for k, v in cells.items():
        row[header.index(k)] = v
    return [header, row]


MEASURED, INVALID, NOT_CALC, INEXACT = (
    "measured", "invalid_input", "not_calculable", "not_exact_frequency_based")
ROUTE, AGENCY, STOP = (
    "gtfs_route_id_count", "gtfs_agency_record_count", "gtfs_boarding_location_id_count")

# case -> (files, {metric or date: (value, status, reason)})
CASES = {
    "1a": (base(), {AGENCY: (1, MEASURED, None), ROUTE: (2, MEASURED, None),
                    STOP: (2, MEASURED, None), MON: (2, MEASURED, None), SUN: (0, MEASURED, None)}),
    "1b": (base(agency=None), {AGENCY: (None, NOT_CALC, "agency:absent")}),
    "1c": (base(routes=with_rows("routes.txt", ["", "A1", "x"])),
           {ROUTE: (None, INVALID, "routes:blank_route_id"),
            MON: (None, INVALID, "routes:blank_route_id")}),
    "1d": (base(routes=with_rows("routes.txt", ["R1", "A1", "x"])),
           {ROUTE: (None, INVALID, "routes:duplicate_route_id"),
            MON: (None, INVALID, "routes:duplicate_route_id")}),
    "1cd": (base(routes=with_rows("routes.txt", ["R1", "A1", "x"], ["　", "A1", "x"])),
            {ROUTE: (None, INVALID, "routes:blank_route_id"),
             MON: (None, INVALID, "routes:blank_route_id")}),
    "1e": (base(stops=drop_column("stops.txt", "location_type")), {STOP: (3, MEASURED, None)}),
    "1f": (base(routes=drop_column("routes.txt", "route_id")),
           {ROUTE: (None, NOT_CALC, "routes:missing_column"),
            MON: (None, INVALID, "routes:missing_column")}),
    "2c": (base(calendar=None, calendar_dates=[CD, ["EXTRA", "20260504", "1"]],
                trips=[BASE["trips.txt"][0], ["R1", "EXTRA", "T1"]]),
           {MON: (1, MEASURED, None), TUE: (0, MEASURED, None)}),
    "2d": (base(calendar_dates=[CD, ["WEEKDAY", "20260504", "2"]]),
           {MON: (0, MEASURED, None), TUE: (2, MEASURED, None)}),
    "2e": (base(calendar=None), {MON: (None, INVALID, "calendars:both_absent"),
                                 SUN: (None, INVALID, "calendars:both_absent")}),
    "2f": (base(calendar=drop_column("calendar.txt", "sunday")),
           {MON: (None, INVALID, "calendar:missing_column")}),
    "2g": (base(calendar=with_rows("calendar.txt", BASE["calendar.txt"][1])),
           {MON: (None, INVALID, "calendar:duplicate_service_id")}),
    "2h": (base(calendar_dates=[CD, ["WEEKDAY", "20260504", "1"], ["WEEKDAY", "20260504", "2"]]),
           {MON: (None, INVALID, "calendar_dates:duplicate_key")}),
    "2i": (base(calendar_dates=[CD, ["WEEKDAY", "20260504", "3"]]),
           {MON: (None, INVALID, "calendar_dates:invalid_exception_type")}),
    "2j": (base(calendar=calendar(monday="2")),
           {MON: (None, INVALID, "calendar:invalid_weekday_flag")}),
    "2k": (base(calendar=calendar(start_date="2026-04-01")),
           {MON: (None, INVALID, "calendar:invalid_date")}),
    "2l": (base(trips=None), {MON: (None, INVALID, "trips:absent")}),
    "2m": (base(trips=with_rows("trips.txt", ["R1", "WEEKDAY", "T1"])),
           {MON: (None, INVALID, "trips:duplicate_trip_id")}),
    "3a": (base(frequencies=[FREQ, ["T1", "06:00:00", "07:00:00", "600", "1"]],
                trips=[*BASE["trips.txt"][:2]]), {MON: (6, MEASURED, None)}),
    "3b": (base(frequencies=[FREQ, ["T1", "06:00:00", "07:05:00", "600", "1"]]),
           {MON: (None, INVALID, "frequencies:not_divisible")}),
    "3c": (base(frequencies=[FREQ, ["T1", "06:00:00", "07:00:00", "600", "0"]]),
           {MON: (None, INEXACT, "frequencies:inexact_times"), SUN: (0, MEASURED, None)}),
    "3d": (base(frequencies=[FREQ, ["T1", "06:00:00", "07:00:00", "600", ""]]),
           {MON: (None, INEXACT, "frequencies:inexact_times")}),
    "3d2": (base(frequencies=[FREQ[:4], ["T1", "06:00:00", "07:00:00", "600"]]),
            {MON: (None, INEXACT, "frequencies:inexact_times")}),
    "3e": (base(frequencies=[FREQ, ["T1", "06:00:00", "07:00:00", "600", "1"]]),
           {MON: (7, MEASURED, None)}),
    "3e2": (base(frequencies=[FREQ, ["T1", "6:00:00", "7:00:00", "600", "1"],
                              ["T1", "125:00:00", "126:00:00", "1800", "1"]]),
            {MON: (9, MEASURED, None)}),
    "3f": (base(frequencies=[FREQ, ["T9", "06:00:00", "07:00:00", "600", "1"]]),
           {MON: (None, INVALID, "frequencies:unknown_trip")}),
    "3g": (base(frequencies=[FREQ, ["T1", "06:60:00", "07:00:00", "600", "1"]]),
           {MON: (None, INVALID, "frequencies:invalid_time")}),
    "3h": (base(frequencies=[FREQ, ["T1", "06:00:00", "07:00:00", "0", "1"]]),
           {MON: (None, INVALID, "frequencies:invalid_headway")}),
    "3i": (base(frequencies=[FREQ, ["T1", "07:00:00", "07:00:00", "600", "1"]]),
           {MON: (None, INVALID, "frequencies:end_not_after_start")}),
    "3j": (base(frequencies=[FREQ, ["T1", "06:00:00", "07:00:00", "600", "2"]]),
           {MON: (None, INVALID, "frequencies:invalid_exact_times")}),
    "3k": (base(frequencies=[FREQ, ["T1", "06:00:00", "07:00:00", "600", "1"],
                             ["T1", "06:00:00", "08:00:00", "600", "1"]]),
           {MON: (None, INVALID, "frequencies:duplicate_key")}),
    "6a": (base(trips=with_rows("trips.txt", ["R9", "WEEKDAY", "T3"])),
           {MON: (None, INVALID, "trips:unknown_route")}),
    "6b": (base(trips=with_rows("trips.txt", ["R1", "NONE", "T3"])),
           {MON: (None, INVALID, "trips:unknown_service")}),
    "6c": (base(trips=drop_column("trips.txt", "route_id")),
           {MON: (None, INVALID, "trips:missing_column")}),
    "6d": (base(trips=with_rows("trips.txt", ["", "WEEKDAY", "T3"])),
           {MON: (None, INVALID, "trips:blank_route_id")}),
    "6e": (base(trips=with_rows("trips.txt", ["R1", " ", "T3"])),
           {MON: (None, INVALID, "trips:blank_service_id")}),
    "6g": (base(routes=None), {MON: (None, INVALID, "routes:absent"),
                               ROUTE: (None, NOT_CALC, "routes:absent")}),
    "6i": (base(calendar=calendar(start_date="20270401")),
           {MON: (None, INVALID, "calendar:start_after_end")}),
    "6j": (base(calendar_dates=[CD, ["EXTRA", "20260509", "1"]],
                trips=with_rows("trips.txt", ["R2", "EXTRA", "T3"])),
           {MON: (2, MEASURED, None), WEEK[5]: (1, MEASURED, None)}),
    # order: an earlier row's later check outranks a later row's earlier check
    "7a": (base(trips=[BASE["trips.txt"][0], ["R9", "WEEKDAY", "T1"], ["R1", "WEEKDAY", "T1"]]),
           {MON: (None, INVALID, "trips:unknown_route")}),
    "7b": (base(trips=with_rows("trips.txt", ["R1", "WEEKDAY", "T1"], ["R9", "WEEKDAY", "T3"])),
           {MON: (None, INVALID, "trips:duplicate_trip_id")}),
    # a short row has '' in its missing cells; an empty line counts as a row
    "8a": (base(trips="route_id,service_id,trip_id\nR1,WEEKDAY,T1\nR1,WEEKDAY\n"),
           {MON: (None, INVALID, "trips:blank_trip_id")}),
    "8b": (base(agency="agency_id\nA1\n\nA2\n"), {AGENCY: (3, MEASURED, None)}),
    "8c": (base(routes=b"\xef\xbb\xbfroute_id\nR1\n"), {ROUTE: (1, MEASURED, None)}),
    "8d": (base(routes="route_id\n路線\n".encode("shift_jis")),
           {ROUTE: (None, INVALID, "routes:undecodable"),
            MON: (None, INVALID, "routes:undecodable")}),
}


@pytest.fixture(scope="module")
def metrics(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("zips")
    for name, (files, _) in CASES.items():
        (folder / f"{name}.zip").write_bytes(zip_bytes(files))
    unsafe = base()
    unsafe["../evil.txt"] = "x"
    (folder / "unsafe.zip").write_bytes(zip_bytes(unsafe))
    (folder / "broken.zip").write_bytes(b"no archive")
    members = archives.archive_members(spark, str(folder)).cache()
    lines = archive_feeds.land(spark, str(folder), str(tmp_path_factory.mktemp("land") / "x"))
    table = archive_feeds.feed_tables(lines, members)
    got = fm.feed_supply_metrics(table, WEEK).collect()
    result = {}
    for r in got:
        result.setdefault(r.feed_id, {})[r.service_date or r.metric_id] = (
            r.value, r.metric_status, r.reason)
    return result, members, lines


@pytest.mark.parametrize("case", CASES)
def test_case(metrics, case):
    got = metrics[0][case]
    assert len(got) == 10
    for key, expected in CASES[case][1].items():
        assert got[key] == expected, key


def test_unsafe_archives_take_no_part(metrics):
    result, members, _ = metrics
    assert not {"unsafe", "broken"} & set(result)
    v = {(r.feed_id, r.check_id, r.reason) for r in safety.archive_violations(members).collect()}
    assert v == {("unsafe", "member_name", "parent_reference"),
                 ("broken", "archive", "not_an_archive")}


def test_every_metric_keeps_the_contract(metrics):
    for per_feed in metrics[0].values():
        for value, status, reason in per_feed.values():
            assert (status == MEASURED) == (value is not None) == (reason is None)


def test_feed_info_uses_the_first_row_only(spark):
    df = spark.createDataFrame(
        [("a", 0, "20260401", "", "v1"), ("a", 1, "20260501", "20260601", "v2"),
         ("b", 0, "2026-04-01", "20260231", "v")],
        "feed_id string, row_idx int, feed_start_date string, feed_end_date string, "
        "feed_version string")
    got = {r.feed_id: r for r in quality.feed_info_first_row(df).collect()}
    assert got["a"].feed_start_date == date(2026, 4, 1) and got["a"].feed_end_date is None
    assert not got["a"].bad_end_date
    assert got["b"].bad_start_date and got["b"].bad_end_date


def test_bom_is_recorded(metrics):
    heads = {r.feed_id: r.had_bom for r in metrics[2].where(
        "file_name = 'routes.txt' AND row_idx = -1").collect()}
    assert heads["8c"] is True and heads["1a"] is False


def test_corrupt_member_fails_its_crc(spark, tmp_path):
    raw = bytearray(zip_bytes({"a.txt": "hello hello"}))
    raw[raw.index(b"hello")] ^= 1
    (tmp_path / "c.zip").write_bytes(bytes(raw))
    members = archives.archive_members(spark, str(tmp_path))
    assert [r.check_id for r in safety.archive_violations(members).collect()] == ["crc_or_read"]


def test_date_basis_keeps_sources_apart(metrics, spark):
    lines = metrics[2]
    feeds = spark.createDataFrame([("2d",), ("1a",)], "feed_id string")
    got = {r.feed_id: r for r in fm.date_basis(
        archive_feeds.table(lines, "calendar.txt"), archive_feeds.table(lines, "calendar_dates.txt"),
        archive_feeds.table(lines, "feed_info.txt"), feeds).collect()}
    assert got["2d"].calendar.min_start_date == date(2026, 4, 1)
    assert got["2d"].calendar_dates.removed_date_min == MON
    assert got["2d"].calendar_dates.added_date_min is None
    assert got["1a"].calendar_dates is None and got["1a"].feed_info is None


def test_bad_archives_stop_no_job(spark, tmp_path):
    good = zip_bytes(BASE)
    (tmp_path / "good.ZIP").write_bytes(good)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("routes.txt", "route_id\n" + "R1\n" * 500)
        z.writestr("trips.txt", "route_id,service_id,trip_id\n")
    raw = bytearray(buffer.getvalue())
    at = raw.index(b"routes.txt") + len("routes.txt")
    raw[at:at + 4] = b"\xff\xff\xff\xff"
    (tmp_path / "damaged.zip").write_bytes(bytes(raw))
    locked = bytearray(good)
    for mark, offset in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
        at = locked.find(mark)
        while at >= 0:
            locked[at + offset] |= 1
            at = locked.find(mark, at + 4)
    (tmp_path / "locked.zip").write_bytes(bytes(locked))
    (tmp_path / "many.zip").write_bytes(zip_bytes({**BASE, **{f"{i}.txt": "" for i in range(300)}}))
    (tmp_path / "junk.zip").write_bytes(b"PK\x03\x04 no archive")
    members = archive_feeds.land_members(spark, str(tmp_path), str(tmp_path / "members"))
    lines = archive_feeds.land(spark, str(tmp_path), str(tmp_path / "lines"))
    errors = {(r.feed_id, r.decode_error) for r in lines.where("row_idx = -1").collect()}
    assert {("good", None), ("damaged", "unreadable"), ("locked", "encrypted"), ("many", "over_limit")} <= errors
    assert members.where("feed_id = 'many' and crc_ok is not null").isEmpty()
    tables = archive_feeds.feed_tables(lines, members)
    assert [r.feed_id for r in tables.feeds.collect()] == ["good"]
    got = {(r.metric_id, r.service_date): r.value for r in fm.feed_supply_metrics(tables, WEEK).collect()}
    assert got[ROUTE, None] == 2


def test_any_number_of_dates(spark):
    from routeledger.operators import service

    days = [date(2026, 4, 1) + timedelta(days=i) for i in range(150)]
    cal = spark.createDataFrame(
        [("f", "s", 31, date(2026, 4, 1), date(2027, 1, 1))],
        "feed_id string, service_id string, mask int, start_date date, end_date date")
    cd = spark.createDataFrame(
        [("f", "s", days[149], 2), ("f", "t", days[100], 1)],
        "feed_id string, service_id string, date date, exception_type int")
    want = {("s", d) for d in days if d.weekday() < 5 and d != days[149]} | {("t", days[100])}
    got = {(r.service_id, r.service_date) for r in service.active_services(cal, cd, days).collect()}
    assert got == want


def read_alone(path, files):
    """The readers' own rows, without Spark."""
    import pandas as pd
    import pyarrow as pa

    entries = pd.concat(archives._list_entries([pd.DataFrame({"feed_id": ["f"], "path": [path]})]))
    entries = entries[entries["row_idx"] >= 0].assign(refusal=None)
    checked = pd.concat([pd.DataFrame(), *archives._check_members([entries])])
    wanted = entries[entries["name"].isin(list(files))]
    batch = pa.RecordBatch.from_pylist(wanted[["feed_id", "path", "name", "row_idx", "refusal"]].to_dict("records"))
    got = [r for b in archives._line_reader(files)([batch] if len(wanted) else []) for r in b.to_pylist()]
    return checked, got


def test_a_damaged_byte_anywhere_stops_no_reader(tmp_path):
    raw = zip_bytes({"a.txt": "x,y\n1,2\n", "b.txt": "x\n" * 40})
    for at in range(len(raw)):
        damaged = bytearray(raw)
        damaged[at] ^= 0xFF
        (tmp_path / "d.zip").write_bytes(bytes(damaged))
        read_alone(str(tmp_path / "d.zip"), {"a.txt": ("x", "y")})


@pytest.mark.parametrize("content, want", [
    (b"", (False, None, [])),
    (b"\xef\xbb\xbf", (True, None, [])),
    (b"\xef\xbb\xbfx,y\n1", (True, None, [("1", "")])),
    (b"x,y,x\n1,2,3,4\n\n", (False, None, [("1", "2"), ("", "")])),
    (b"x,z\r\n1,2\r\n", (False, None, [("1", None)])),
    (b'x,y\n"1\r2","a\n""b"""\n', (False, None, [("1\r2", 'a\n"b"')])),
    (b"x,y\n1\r2,3\n", (False, "not_csv", [])),
    (b"x\nab\xe8\xb7", (False, "unexpected end of data at byte 4", [])),
    (b"x\n" + b"a" * (archives.CHUNK - 3) + "路".encode() + b"\n", (False, None, [("a" * (archives.CHUNK - 3) + "路", None)])),
    (b"x\n" + b"a" * (archives.CHUNK - 3) + b"\xe8\x41", (False, f"invalid continuation byte at byte {archives.CHUNK - 1}", [])),
    (b"x\n" + b"a" * (archives.CHUNK - 3) + b"\r\nb\n", (False, None, [("a" * (archives.CHUNK - 3), None), ("b", None)])),
    (b"x\n" + b"a" * (archives.CHUNK - 3) + b"\rb\n", (False, "not_csv", [])),
])
def test_members_are_read_as_streams(tmp_path, content, want):
    (tmp_path / "s.zip").write_bytes(zip_bytes({"t.txt": content}))
    checked, got = read_alone(str(tmp_path / "s.zip"), {"t.txt": ("x", "y")})
    assert list(checked["crc_ok"]) == [True]
    head, *rows = got
    assert (head["had_bom"], head["decode_error"], [(r["x"], r["y"]) for r in rows]) == want
    assert [r["row_idx"] for r in got] == list(range(-1, len(rows)))


def test_the_last_member_of_a_name_counts(spark, tmp_path):
    buffer = io.BytesIO()
    with pytest.warns(UserWarning), zipfile.ZipFile(buffer, "w") as z:
        z.writestr("t.txt", "x\nold\n")
        z.writestr("t.txt", "x\nnew\n")
    (tmp_path / "äß 1%.zip").write_bytes(buffer.getvalue())
    got = archives.archive_lines(spark, str(tmp_path), {"t.txt": ("x",)}).where("row_idx >= 0").collect()
    assert [(r.feed_id, r.x) for r in got] == [("äß 1%", "new")]


def test_members_of_one_archive_are_read_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    names = [f"{i}.txt" for i in range(40)]
    (tmp_path / "one.zip").write_bytes(zip_bytes({n: "x\n1\n" for n in names}))
    lines = archives.archive_lines(spark, str(tmp_path), {n: ("x",) for n in names}).where("row_idx >= 0")
    tasks = lines.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in tasks) == 40 and len(tasks) >= 3
    assert "map<" not in lines.schema.simpleString()
    assert archives.archive_lines(spark, str(tmp_path), {"none.txt": ("x",)}).isEmpty()


def test_small_members_share_batches_and_listing_tasks(spark, tmp_path):
    """Thousands of small archives cost neither a batch a member nor a task a few dozen files."""
    import pyarrow as pa

    for i in range(300):
        with zipfile.ZipFile(tmp_path / f"f{i}.zip", "w") as z:
            z.writestr("trips.txt", f"route_id,trip_id\nr{i},t{i}\n" + ("" if i % 3 else "short\n"))
            z.writestr("routes.txt", b"\xef\xbb\xbfroute_id\nr" if i != 7 else b"\xff")
    members = [(f"f{i}", f"{tmp_path}/f{i}.zip", n, k, None) for k, n in enumerate(("trips.txt", "routes.txt")) for i in range(300)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c) for c in zip(*members)], ["feed_id", "path", "name", "row_idx", "refusal"])
    files = {"trips.txt": ("route_id", "service_id", "trip_id"), "routes.txt": ("route_id",)}
    batches = list(archives._line_reader(files)(iter([batch])))
    assert len(batches) == 2
    got = pa.Table.from_batches(batches).to_pylist()
    assert len(got) == 300 * 4 + 100 - 1
    at = {(r["feed_id"], r["file_name"], r["row_idx"]): r for r in got}
    assert at["f3", "trips.txt", 1]["route_id"] == "short" and at["f3", "trips.txt", 1]["trip_id"] == ""
    assert at["f4", "trips.txt", 0]["service_id"] is None and at["f4", "trips.txt", -1]["header"] == ["route_id", "trip_id"]
    assert at["f4", "routes.txt", 0]["had_bom"] and at["f4", "routes.txt", 0]["header"] is None
    assert at["f7", "routes.txt", -1]["decode_error"] and ("f7", "routes.txt", 0) not in at
    assert len(list(archives._list_entries(iter([batch.slice(0, 300).to_pandas()])))) == 1
    landed = archive_feeds.land(spark, str(tmp_path), str(tmp_path / "lines"))
    assert landed.count() == len(got)


def test_lines_of_a_member_go_on_over_batches(spark, tmp_path):
    rows = [(f, "trips.txt", i, f'"{f},{i}"é') for f in ("a", "b", "c") for i in range(25_000)]
    df = spark.createDataFrame(rows, "feed_id string, file_name string, row_idx long, line string")
    sinks.write_archives(df.repartition(5), str(tmp_path / "z"), 2)
    for f in ("a", "b", "c"):
        with zipfile.ZipFile(tmp_path / "z" / f"{f}.zip") as z:
            assert z.read("trips.txt").decode() == "".join(f'"{f},{i}"é\n' for i in range(25_000))
