"""Operators against brute force or hand-made answers on small fixtures."""

import random
import unicodedata
from datetime import date

import pytest
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.operators import (
    access, compare, contracts, layout, ordered, provenance, quality, registry, safety, scans,
    score, service,
)

MB = 1024 * 1024


# -- archive limits ---------------------------------------------------------------------------

def member_frame(spark, rows):
    return spark.createDataFrame(
        [(f, n, s, c, fl, m, d, True, None) for f, n, s, c, fl, m, d in rows],
        "feed_id string, name string, file_size bigint, compress_size bigint, flag_bits int, "
        "unix_mode int, is_dir boolean, crc_ok boolean, archive_error string")


def test_limits_pass_at_the_boundary(spark):
    plain = (0, 0o644, False)
    data = [("n200", f"f{i}", 1, 1, *plain) for i in range(200)]
    data += [("n201", f"f{i}", 1, 1, *plain) for i in range(201)]
    data += [("m100", "a", 100 * MB, MB, *plain), ("m101", "a", 100 * MB + 1, MB, *plain)]
    data += [("t500", f"f{i}", 100 * MB, MB, *plain) for i in range(5)]
    data += [("t501", f"f{i}", 100 * MB, MB, *plain) for i in range(5)] + [("t501", "z", 1, 1, *plain)]
    data += [("r200", "a", 200, 1, *plain), ("r201", "a", 201, 1, *plain),
             ("r0", "a", 1, 0, *plain), ("e0", "a", 0, 0, *plain)]
    data += [("enc", "a", 1, 1, 1, 0o644, False), ("link", "a", 1, 1, 0, 0o120777, False),
             ("dir", "a", 0, 0, 0, 0o40755, True), ("dos", "a", 1, 1, 0, 0, False)]
    data += [("dup", "Ａ.txt", 1, 1, *plain), ("dup", "a.TXT", 1, 1, *plain)]
    got = {(r.feed_id, r.check_id) for r in safety.archive_violations(
        member_frame(spark, data)).collect()}
    assert got == {
        ("n201", "member_count"), ("m101", "member_size"), ("t501", "total_size"),
        ("r201", "compression_ratio"), ("r0", "compression_ratio"), ("enc", "member_type"),
        ("link", "member_type"), ("dir", "member_type"), ("dup", "duplicate_name")}


# -- key statistics ---------------------------------------------------------------------------

def test_id_stats_blank_unique_duplicate(spark):
    df = spark.createDataFrame([("f", "", 0), ("f", "S1", 1), ("f", "S1", 2), ("f", " S1", 3)],
                               "feed_id string, id string, row_idx int")
    r = quality.id_stats(df, ["feed_id"], ["id"]).first()
    assert (r.row_count, r.blank_count, r.unique_count, r.duplicate_count) == (4, 1, 2, 1)


def test_duplicates_with_one_hot_key(spark):
    rng = random.Random(3)
    data = [("f", "hot" if rng.random() < 0.4 else str(rng.randrange(500)), i) for i in range(3000)]
    df = spark.createDataFrame(data, "feed_id string, id string, row_idx int").repartition(7)
    seen, expected = {}, set()
    for _, k, i in data:
        if k in seen:
            expected.add((k, i, seen[k]))
        else:
            seen[k] = i
    got = quality.duplicate_rows(df, ["feed_id"], ["id"])
    assert {(r.id, r.row_idx, r.first_row_idx) for r in got.collect()} == expected
    second = {(r.id, r.row_idx) for r in quality.second_occurrence(df, ["id", "feed_id"]).where(
        "rn = 2").collect()}
    first_repeat = {}
    for k, i, _ in expected:
        first_repeat[k] = min(i, first_repeat.get(k, i))
    assert second == set(first_repeat.items())


def test_second_occurrence_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("row_idx"))
    plan = quality.second_occurrence(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# -- services ---------------------------------------------------------------------------------

def week_bounds(spark, rows):
    return spark.createDataFrame(
        rows, "feed_id string, reference_date date, reference_status string, info_start date, "
        "info_end date, cal_start date, cal_end date")


@pytest.mark.parametrize("bounds, start, status", [
    ([("a", date(2026, 4, 1), "confirmed", None, None, date(2026, 1, 1), date(2026, 12, 31)),
      ("b", date(2026, 3, 1), "confirmed", date(2026, 4, 1), date(2027, 3, 31), date(2026, 1, 1),
       date(2026, 12, 31))], date(2026, 4, 6), "measured"),
    ([("a", date(2026, 4, 6), "confirmed", None, None, date(2026, 1, 1), date(2026, 4, 12))],
     date(2026, 4, 6), "measured"),
    ([("a", date(2026, 4, 6), "confirmed", None, None, date(2026, 1, 1), date(2026, 4, 11))],
     None, "not_comparable_no_common_week"),
    ([("a", date(2026, 4, 6), "confirmed", None, None, None, None)], None, "not_calculable"),
    ([("a", date(2026, 4, 6), "not_stated", None, None, date(2026, 1, 1), date(2026, 4, 11))],
     None, "not_calculable"),
    ([("a", date(2026, 4, 1), "confirmed", None, None, date(2026, 1, 1), date(2026, 12, 31)),
      ("x", date(2027, 1, 1), "not_confirmed", None, None, None, None)],
     date(2026, 4, 6), "measured"),
])
def test_comparison_week(spark, bounds, start, status):
    r = service.comparison_week(week_bounds(spark, bounds)).first()
    assert (r.week_start, r.metric_status) == (start, status)


def test_service_days_against_brute_force(spark):
    rng = random.Random(5)
    dates = [date(2026, 5, 4 + i) for i in range(7)]
    cal = [("f", str(i), rng.randrange(128), date(2026, 5, rng.randrange(1, 9)),
            date(2026, 5, rng.randrange(4, 15))) for i in range(60)]
    exc = list({(str(rng.randrange(80)), rng.choice(dates)): rng.choice([1, 2])
                for _ in range(150)}.items())
    expected = {(s, d) for _, s, m, a, b in cal for d in dates
                if a <= d <= b and m >> d.weekday() & 1}
    expected |= {k for k, e in exc if e == 1}
    expected -= {k for k, e in exc if e == 2}
    got = service.active_services(
        spark.createDataFrame(cal, "feed_id string, service_id string, mask int, start_date date, "
                              "end_date date"),
        spark.createDataFrame([("f", s, d, e) for (s, d), e in exc],
                              "feed_id string, service_id string, date date, exception_type int"),
        dates)
    assert {(r.service_id, r.service_date) for r in got.collect()} == expected


# -- ordered ----------------------------------------------------------------------------------

def test_page_blocks_across_segments(spark):
    rng = random.Random(7)
    kinds = {("d", p): rng.choice(["anchor", "appendix", None, None, None, None]) for p in range(120)}
    kinds |= {("e", p): None for p in range(3)}
    expected, current = {}, {}
    for (doc, p), k in sorted(kinds.items()):
        if k == "appendix":
            current[doc] = None
            expected[doc, p] = (None, "dropped")
        else:
            if k == "anchor":
                current[doc] = p
            start = current.get(doc)
            expected[doc, p] = (start, "block" if start is not None
                                else "error_continuation_without_start")
    df = spark.createDataFrame([(d, p, k) for (d, p), k in kinds.items()],
                               "doc string, page int, kind string").repartition(5)
    last = F.when(F.col("kind").isNotNull(), F.struct("page", "kind"))
    for parts in (7, 40, None):
        out = ordered.running_max(df, ["doc"], "page", last, "last", parts)
        assert {(r.doc, r.page): r.last and (r.last.page, r.last.kind) for r in out.collect()} == {
            key: max(((p, k) for (d, p), k in kinds.items()
                      if d == key[0] and p <= key[1] and k), default=None) for key in kinds}
    got = ordered.page_blocks(df, "doc", "page", F.coalesce(F.col("kind") == "anchor", F.lit(False)),
                              F.coalesce(F.col("kind") == "appendix", F.lit(False)))
    assert {(r.doc, r.page): (r.block_start, r.state) for r in got.collect()} == expected


def test_numbering_across_segments(spark):
    df = spark.createDataFrame([("a", 3 * i) for i in range(50)] + [("b", 9)], "k string, o int")
    got = {(r.k, r.o): r.n for r in ordered.numbered(df.repartition(4), ["k"], "o", "n", 16).collect()}
    assert got == {**{("a", 3 * i): i + 1 for i in range(50)}, ("b", 9): 1}


# -- layout -----------------------------------------------------------------------------------

def test_leader_clusters_compare_with_the_first_value(spark):
    df = spark.createDataFrame([(1, x) for x in (5.1, 1.0, 3.4, 2.5, 1.0)], "page int, x double")
    assert layout.leader_clusters(df, ["page"], "x", 2.0).first().leaders == [1.0, 3.4]


def test_leader_clusters_equal_a_sequential_pass(spark, monkeypatch):
    """Runs of any length, values on both sides of zero, and groups that differ by one key only."""
    rng = random.Random(4)
    rows, want = [], []
    for page in range(12):
        for kind in ("v", "h"):
            values = sorted({rng.choice([rng.uniform(-30, 30), rng.randrange(-60, 60) / 2, 300 + rng.uniform(0, 5)])
                             for _ in range(rng.choice([1, 5, 60, 300]))})
            rows += [(page, kind, v) for v in values for _ in range(rng.choice([1, 1, 2]))]
            last = None
            for v in values:
                if last is None or v - last >= 2.0:
                    want.append((page, kind, v))
                    last = v
    df = spark.createDataFrame(rows, "page int, kind string, x double").repartition(6)
    for tiles in (64, 4):
        monkeypatch.setattr(layout, "TILES", tiles)
        got = layout.leader_rows(df, ["page", "kind"], "x", 2.0)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_leaders_of_one_page_of_a_million_coordinates(spark):
    df = spark.range(1_000_000).selectExpr("1 as page", "id * 0.01D as x")
    got = layout.leader_rows(df, ["page"], "x", 2.0)
    assert got.count() == 5000
    # as a sequential pass over the same doubles finds them
    last, n = 0.0, 1
    for i in range(1_000_000):
        if i * 0.01 - last >= 2.0:
            last, n = i * 0.01, n + 1
    assert n == got.count() and got.agg(F.max("leader")).first()[0] == last


def test_missing_cells_are_read_from_their_rectangles(spark):
    """A header box that is missing, a row without boxes, words on a border, ties, and a box over several tiles."""
    words = spark.createDataFrame(
        [(1, "b", 10.0, 20.0, 60.0, 70.0, 2), (1, "a", 10.0, 20.0, 55.0, 65.0, 3), (1, "c", 10.0, 20.0, 60.0, 70.0, 1),
         (1, "edge", 90.0, 110.0, 60.0, 70.0, 4), (1, "far", 10.0, 20.0, 190.0, 200.0, 5), (2, "other", 10.0, 20.0, 60.0, 70.0, 6)],
        WORDS)
    box = lambda r, c, top, bottom: (1, r, c, 100.0 * (c - 1), 100.0 * c, top, bottom)
    cells = spark.createDataFrame(
        [box(1, 1, 0.0, 40.0), box(1, 2, 0.0, 40.0), box(1, 3, 0.0, 40.0), box(2, 2, 50.0, 80.0), box(2, 4, 50.0, 90.0),
         box(3, 1, 100.0, 400.0)], "page int, row_no int, col_no int, x0 double, x1 double, top double, bottom double")
    got = {(r.row_no, r.col_no): r.text for r in layout.recovered_cells(words, cells).collect()}
    assert got == {(2, 1): "a\nc\nb\nedge", (2, 3): "", (3, 2): "", (3, 3): ""}
    assert layout.recovered_cells(words, cells.where("row_no = 1")).count() == 0


def test_missing_cells_of_crowded_pages_meet_in_tiles(spark, rows, monkeypatch):
    """Whatever counts as crowded, the cells are those of a brute force; a header box without a number is always missing."""
    rng = random.Random(5)
    words = [(rng.randrange(4), f"w{i}", float(x := rng.randrange(400)), x + 6.0, float(y := rng.randrange(300)), y + 8.0, i)
             for i in range(300)] + [(5, "lone", 1.0, 2.0, 1.0, 2.0, 300)]
    heads = [(p, 1, c, 100.0 * (c - 1), 100.0 * c, 0.0, 10.0) for p in range(6) for c in range(1, 5)]
    heads += [(0, 1, None, 50.0, 150.0, 0.0, 10.0), (1, 1, 2, 100.0, 120.0, 0.0, 10.0)]
    found = [(p, r, c, 0.0, 1.0, 40.0 * r, 40.0 * r + rng.choice([30.0, 90.0])) for p in range(6) for r in range(2, 8)
             for c in range(1, 5) if rng.random() < 0.4]
    want = {}
    for p, r in {(c[0], c[1]) for c in found}:
        own = [c for c in found if c[:2] == (p, r)]
        top, bottom = min(c[5] for c in own), max(c[6] for c in own)
        for _, _, col, x0, x1, _, _ in [h for h in heads if h[0] == p and h[2] not in [c[2] for c in own]]:
            want.setdefault((p, r, col), []).extend(
                (w[4], w[2], w[6], w[1]) for w in words
                if w[0] == p and x0 <= (w[2] + w[3]) / 2 <= x1 and top <= (w[4] + w[5]) / 2 <= bottom)
    want = sorted(((*k, "\n".join(w[3] for w in sorted(v))) for k, v in want.items()), key=repr)
    table = spark.createDataFrame(words, WORDS)
    cells = spark.createDataFrame(heads + found, "page int, row_no int, col_no int, x0 double, x1 double, top double, bottom double")
    for crowd in (500, 75, 0):
        monkeypatch.setattr(layout, "CROWD", crowd)
        assert rows(layout.recovered_cells(table, cells)) == want


WORDS = "page int, text string, x0 double, x1 double, top double, bottom double, word_idx int"


def test_words_in_box_brute_force(spark):
    rng = random.Random(11)
    words = []
    for i in range(400):
        x, y = rng.randrange(600), rng.randrange(800)
        words.append((rng.randrange(3), f"w{i}", float(x), float(x + 10), float(y), float(y + 8), i))
    boxes = []
    for b in range(20):
        side = [rng.choice([None, float(rng.randrange(0, 300))]), rng.choice([None, float(rng.randrange(300, 600))]),
                rng.choice([None, float(rng.randrange(0, 400))]), rng.choice([None, float(rng.randrange(400, 800))])]
        boxes.append((rng.randrange(3), f"b{b}", *side))
    expected = set()
    for page, box, x0, x1, top, bottom in boxes:
        for w in words:
            cx, cy = (w[2] + w[3]) / 2, (w[4] + w[5]) / 2
            if (w[0] == page and (x0 is None or cx >= x0) and (x1 is None or cx <= x1)
                    and (top is None or cy >= top) and (bottom is None or cy <= bottom)):
                expected.add((box, w[6]))
    got = layout.words_in_box(
        spark.createDataFrame(words, WORDS),
        spark.createDataFrame(boxes, "page int, box_id string, x0 double, x1 double, top double, bottom double"))
    rows = [(r.box_id, r.word_idx) for r in got.collect()]
    assert set(rows) == expected and len(rows) == len(expected)


def test_label_value_and_gaps(spark):
    words = [(1, "名", 10, 15, 50, 60, 0), (1, "特定", 200, 220, 51, 61, 1), (1, "法人", 221, 240, 51, 61, 2),
             (1, "豆", 252, 260, 51, 61, 3), (1, "下", 200, 210, 90, 100, 4), (1, "名", 10, 15, 80, 90, 5)]
    df = spark.createDataFrame([(p, t, *map(float, c[:4]), c[4]) for p, t, *c in words], WORDS)
    assert [r.text for r in layout.label_value(df, "名", 150.0).collect()] == ["特定法人 豆"]


def test_cell_split_falls_back_to_the_first_line(spark):
    df = spark.createDataFrame([("A\nB\nC", "AB", "C"), ("A\nB\nC", "X", "Y"), ("A", "A", "")],
                               "c string, n string, l string")
    got = [tuple(r.s) for r in df.select(layout.cell_split(F.col("c"), F.col("n"), F.col("l")).alias("s")).collect()]
    assert got == [("AB", "C"), ("A", "BC"), ("A", "")]


# -- scans ------------------------------------------------------------------------------------

def test_leak_scan_finds_short_and_long_needles(spark):
    rng = random.Random(13)
    letters = "ab \t　\n"
    texts = [(i, "".join(rng.choice(letters) for _ in range(60))) for i in range(80)]
    names = [(i, "".join(rng.choice("ab ") for _ in range(rng.randrange(0, 9)))) for i in range(40)]
    names += [(100 + i, texts[i][1][i:i + 30]) for i in range(30)] + [(200, "é😀"), (201, "\n")]
    texts += [(900, None), (901, ""), (902, "x é 😀 y")]
    strip = str.maketrans("", "", " \t　")
    expected = {(t, n) for t, a in texts for n, b in names
                if a and b.translate(strip) and b.translate(strip) in a.translate(strip)}
    t = spark.createDataFrame(texts, "t long, text string")
    c = spark.createDataFrame(names, "n long, name string")
    rows = [(r.t, r.n) for r in scans.leak_scan(t, "t", "text", c, "n", "name").collect()]
    assert set(rows) == expected and len(rows) == len(expected)


def test_needles_with_one_beginning_meet_only_what_holds_them(spark):
    """Short and long needles of a common prefix that every text holds: pairs are matches, not all pairs."""
    texts = spark.createDataFrame([(i, f"xx common prefix {i} ab{i % 7}c") for i in range(200)], "t int, text string")
    names = [f"ab{i}" for i in range(2000)] + [f"common prefix {i}" for i in range(2000)]
    needles = spark.createDataFrame([(n,) for n in names], "n string")
    pairs = scans.occurrences(texts, ["t"], "text", needles, "n")
    got = {(r.t, r["_needle"]) for r in pairs.collect()}
    assert got == {(i, n) for i in range(200) for n in names if n in f"xx common prefix {i} ab{i % 7}c"}
    lengths = sorted({len(n) for n in names if len(n) < scans.SHORT})
    pieces = texts.select("t", "text").mapInArrow(scans._piece_rows("text", lengths, True), "t int, _piece bigint")
    keys = spark.createDataFrame([(n,) for n in names if len(n) < scans.SHORT], "n string").mapInArrow(
        scans._piece_rows("n", lengths, True, own_length=True), "n string, _piece bigint")
    met = pieces.join(keys, "_piece").count()
    assert met == sum(n in f"xx common prefix {i} ab{i % 7}c" for i in range(200) for n in names if len(n) < scans.SHORT)


def test_roster_names_in_order_of_position(spark):
    areas = spark.createDataFrame(
        [(1, "萩市と阿武町、萩市", "団体"), (2, "向津具地区", "団体"), (3, "山口市", "光市"),
         (4, "長門市向津具地区", "萩市"), (5, "", "会")], "k int, area string, org string")
    roster = spark.createDataFrame([(m,) for m in ("萩市", "阿武町", "長門市", "光市", "山口市")], "municipality string")
    expected = {1: "萩市;阿武町", 2: "長門市", 3: "光市;山口市", 4: "萩市;長門市", 5: ""}
    got = scans.area_roster(areas, "k", "area", "org", roster)
    assert {r.k: r.municipalities for r in got.collect()} == expected


def test_token_coverage_counts(spark):
    old = "## Head\nuse `col_a` and `ｃｏｌ_b`\n| x | y |\n|---|---|\n```\nlong line\nab\n```\n"
    new = "# t\ncol_a col_b\n## 改訂点\nHead was dropped\n"
    got = {r.kind: (r.total, r.present, r.explained, r.missing) for r in scans.token_coverage(
        spark.createDataFrame([(old, new)], "o string, n string"), "o", "n", "改訂点").collect()}
    # the heading is found in the notes, which are part of the new text
    assert got == {"heading": (1, 1, 0, 0), "identifier": (2, 2, 0, 0),
                   "table_first_column": (1, 0, 0, 1), "code_line": (1, 0, 0, 1)}
    assert unicodedata.normalize("NFKC", "ｃｏｌ_b") == "col_b"


# -- registry and access ----------------------------------------------------------------------

def test_municipal_sums_exceed_unique_totals(spark):
    ops = spark.createDataFrame(
        [("p", "1", V.TRANSPORT_TYPES[0], "A;B", 3, 1), ("p", "2", V.TRANSPORT_TYPES[1], "A", 2, 0),
         ("q", "1", V.TRANSPORT_TYPES[1], "", 5, 5)],
        "source_pdf string, registration_no string, transport_type string, "
        "service_area_municipalities string, vehicles_total long, vehicles_total_kei long")
    roster = spark.createDataFrame([(0, "B"), (1, "C"), (2, "A")], "roster_ord int, municipality string")
    rows = registry.municipal_supply(ops, roster).collect()
    assert [(r.municipality, r.operator_count, r.vehicles_total, r.vehicles_total_kei) for r in rows] == [
        ("B", 1, 3, 1), ("C", 0, 0, 0), ("A", 2, 5, 1)]
    u = registry.unique_vs_exploded(ops).first()
    assert (u.unique_operators, u.unique_vehicles, u.summed_operators, u.summed_vehicles) == (3, 10, 3, 8)
    by_type = registry.municipal_supply_by_type(ops, roster)
    assert by_type.count() == 6
    doc = {r.municipality: r for r in registry.municipal_supply_document(ops, roster).collect()}
    assert len(doc["A"].operators) == 2 and doc["C"].operators is None
    assert sum(x.vehicles_total for x in doc["A"].by_transport_type) == doc["A"].vehicles_total


def test_totals_rows_are_checks_only(spark):
    key = "source_pdf string, registration_no string, "
    ops = spark.createDataFrame([("p", "1", 3, 1), ("p", "2", 0, 0)], key + "vehicles_total long, vehicles_total_kei long")
    veh = spark.createDataFrame(
        [("p", "1", 1, "バス", 2, None), ("p", "1", 1, "セダン等", 1, 1), ("p", "1", 1, "合計", 3, 1)],
        key + "office_seq int, vehicle_type string, count long, count_kei long")
    got = {r.registration_no: (r.detail_count, r.detail_kei, r.is_consistent)
           for r in registry.reconcile_totals(ops, veh).collect()}
    assert got == {"1": (3, 1, True), "2": (0, 0, True)}


def test_access_states_and_bridge(spark):
    status = spark.createDataFrame(
        [("A", "public_download_confirmed", "f1;f2"), ("B", "not_publicly_distributed", "f9"), ("C", "odd", "")],
        "municipality string, availability_status string, feed_ids string")
    feeds = spark.createDataFrame([("f1",), ("f2",), ("f2",)], "feed_id string")
    got = {(r.rule_id, r.entity, r.detail) for r in access.bridge_violations(status, feeds).collect()}
    assert got == {("unknown_status", "C", "odd"), ("empty_feed_list", "C", ""),
                   ("unknown_feed", "B", "f9"), ("duplicate_feed_id", "f2", "")}
    counts = {r.availability_status: r.n for r in access.access_state_counts(status).collect()}
    assert counts == {"public_download_confirmed": 1, "authentication_required": 0,
                      "not_publicly_distributed": 1, "official_resource_unavailable": 0}


# -- provenance and scores --------------------------------------------------------------------

@pytest.mark.parametrize("statuses, worst", [
    (["unchanged"], 0), (["unchanged", "changed"], 1), (["changed", "unavailable"], 2),
    (["oversize", "invalid_baseline"], 3), ([], 3)])
def test_worst_exit(spark, statuses, worst):
    df = spark.createDataFrame([(s,) for s in statuses], "status string")
    got = provenance.freshness_summary(df).collect()
    assert {r.worst_exit for r in got} == {worst} and len(got) == 5


@pytest.mark.parametrize("version, declared, reason", [
    ("v1", 2, None), ("v0", 2, "invalid_manifest_schema"), (None, 2, "invalid_manifest_schema"),
    ("v1", 3, "invalid_source_count"), ("v1", None, "invalid_source_count")])
def test_manifest_level(spark, version, declared, reason):
    header = spark.createDataFrame(
        [(version, declared)], "schema_version string, expected_source_count bigint")
    sources = spark.createDataFrame([("a",), ("b",)], "source_id string")
    got = [r.reason for r in provenance.manifest_level(header, sources, "v1").collect()]
    assert got == ([reason] if reason else [])


def test_release_goes_only_when_all_pass(spark):
    checked = spark.createDataFrame([("a", None)], "source_id string, reason string")
    files = spark.createDataFrame([("x", "t\r\n")], "path string, text string")
    same = spark.createDataFrame([("x", "t\n")], "path string, text string")
    report = spark.createDataFrame([(0,)], "exit_code int")
    diff = provenance.reproduction_diff(files, same)
    strict = provenance.release_decision(checked, diff, report).collect()
    assert {r.decision for r in strict} == {"NO_GO"}
    assert {r.check_id for r in strict if r.n_failed} == {"exact_byte_reconstruction"}
    loose = provenance.release_decision(checked, diff, report, require_bytes=False).collect()
    assert {r.decision for r in loose} == {"GO"}
    empty = provenance.release_decision(checked.limit(0), diff, report, require_bytes=False).collect()
    assert {r.decision for r in empty} == {"NO_GO"}


def test_scorecard_golden(spark):
    given = {"utility": [4.0, 4.5, 2.0], "completeness": [4.5, 4.5, 4.5], "challenge": [3.5, 3.5, 4.5, 2.5]}
    data = [("w", c, s, float(x)) for c, xs in given.items() for s, x in zip(V.SCORE_SUBCRITERIA[c], xs)]
    df = spark.createDataFrame(data, "subject_id string, criterion_id string, subcriterion_id string, score double")
    r = score.scorecard(df.withColumn("score", F.col("score").cast("decimal(2,1)"))).first()
    assert (r.utility, r.completeness, r.challenge, r.comparison_index) == (3.5, 4.5, 3.5, 76.7)
    bad = df.where("subcriterion_id <> 'novelty'").withColumn("evidence", F.lit("x")).withColumn(
        "score", F.when(F.col("subcriterion_id") == "method_fit", 4.25).otherwise(F.col("score")))
    assert {r.rule_id for r in score.scorecard_contract(bad).collect()} == {"not_half_step", "missing_subcriterion"}


# -- contracts and comparison -----------------------------------------------------------------

def test_metric_contract_rules(spark):
    cases = [(1, "measured", None, None), (0, "measured", None, None), (-1, "measured", None, "measured_without_value"),
             (None, "measured", None, "measured_without_value"), (1, "measured", "x", "measured_with_reason"),
             (1, "invalid_input", "x", "value_without_measurement"), (None, "invalid_input", " ", "reason_missing"),
             (None, "not_confirmed", None, None), (None, "weird", "x", "unknown_status"), (None, None, "x", "unknown_status")]
    df = spark.createDataFrame([(i, v, s, r) for i, (v, s, r, _) in enumerate(cases)],
                               "i int, value long, metric_status string, reason string")
    got = {r.i: r.violation for r in contracts.metric_contract(df).collect()}
    assert got == {i: c[3] for i, c in enumerate(cases) if c[3]}


def test_multiset_diff_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "v int")
    assert {(r.v, r.side, r.n) for r in compare.multiset_diff(a, b).collect()} == {
        (1, "left_only", 1), (2, "left_only", 1), (3, "right_only", 1)}
    assert compare.multiset_equal(a, a)


def test_numbering_of_one_group_with_sparse_keys(spark):
    from routeledger.operators import ordered

    rows = spark.range(20_000).selectExpr("'u' as user", "id * 10000 + id % 7 as at")
    segments = ordered.segmented(rows, ["user"], "at", 20).groupBy("_seg").count().collect()
    assert len(segments) == 20 and max(r["count"] for r in segments) <= 2000
    got = ordered.numbered(rows, ["user"], "at", "n", 20)
    assert got.where("n = cast(at div 10000 as bigint) + 1").count() == 20_000


def test_one_outlying_key_does_not_gather_a_group(spark):
    rows = spark.range(100_000).selectExpr("'u' as user", "if(id = 99999, 9000000000000000, id) as at")
    segments = [r["count"] for r in ordered.segmented(rows, ["user"], "at", 16).groupBy("_seg").count().collect()]
    assert len(segments) == 16 and max(segments) < 2 * 100_000 / 16
    got = ordered.numbered(rows, ["user"], "at", "n", 16)
    assert got.where("n = if(at > 99999, 100000, at + 1)").count() == 100_000
    last = ordered.running_max(rows, ["user"], "at", F.when(F.col("at") % 1000 == 0, F.col("at")), "last", 16)
    assert last.where("last = at - at % 1000").count() == 100_000


def test_vehicle_rows_from_cells(spark):
    from routeledger.plans import vehicle_rows as vr

    heads = {1: "事務所", 2: "寝台車\n(うち軽)", 3: "セダン\n等", 4: "", 5: "合計\n(うち軽)"}
    table = {
        "d": [heads, {1: "North\nTown 1", 2: "2\n(1)", 5: "2\n(1)"}, {1: "South\nTown 2", 3: "３", 5: "4\n(0)"},
              {1: " \n"}, {1: "合計", 2: "2\n(1)", 3: "3", 5: "6\n(1)"}],
        "e": [heads, {1: "One", 4: "7", 5: "0\n()"}, {1: "合 計", 5: "9"}],
    }
    cells = spark.createDataFrame(
        [(d, r + 1, c, t) for d, rows in table.items() for r, row in enumerate(rows) for c, t in row.items()],
        "doc string, row_no int, col_no int, text string")
    docs = spark.createDataFrame([("d", V.GAP_AREA_TYPE), ("e", V.TRANSPORT_TYPES[0])], "doc string, transport_type string")
    read = vr.read_cells(cells, "doc", docs)
    got = {(r.doc, r.office_seq, r.office_name, r.office_location, r.vehicle_type, r["count"], r.count_kei)
           for r in vr.vehicle_rows(read, "doc").collect()}
    assert got == {("d", 1, "North", "Town 1", "寝台車", 2, 1), ("d", 1, "North", "Town 1", "合計", 2, 1),
                   ("d", 2, "South", "Town 2", "普通自動車", 3, None), ("d", 2, "South", "Town 2", "合計", 4, 0)}
    bad = {(r.doc, r.office_seq, r.reason) for r in vr.vehicle_problems(read, "doc").collect()}
    assert bad == {("d", 2, "office_total_mismatch"), ("e", 1, "value_without_heading"),
                   ("e", 1, "office_without_location"), ("e", None, "printed_total_mismatch")}


def test_a_route_without_a_name_is_not_the_required_one(spark):
    routes = spark.createDataFrame(
        [("A", 0, "1", None), ("B", 0, "1", " Line "), ("C", 0, "1", "Line"), ("D", 0, "2", "Line")],
        "feed_id string, row_idx int, route_id string, route_long_name string")
    anchors = spark.createDataFrame([(f, "1", "Line") for f in "ABCD"], "feed_id string, route_id string, expected_name string")
    reasons = lambda df: {r.feed_id: r.reason for r in df.collect()}
    assert reasons(quality.anchor_check(routes, anchors)) == {"A": "missing_name", "B": None, "C": None, "D": "missing_route"}
    status = spark.createDataFrame(
        [("A", "routes.txt", True, ["route_id"]), ("B", "routes.txt", True, ["route_id", "route_long_name"]),
         ("C", "trips.txt", True, ["trip_id"]), ("D", "routes.txt", True, ["route_long_name"])],
        "feed_id string, file_name string, present boolean, header array<string>")
    assert reasons(quality.anchor_check(routes, anchors, status)) == {
        "A": "missing_column", "B": None, "C": None, "D": "missing_column"}


def test_a_refused_manifest_is_one_row_of_the_report(spark):
    checked = spark.createDataFrame([("a", "raw/a", "x", 9, None)], "source_id string, local_path string, "
                                    "baseline_sha256 string, max_download_bytes long, reason string")
    seen = spark.createDataFrame([("a", "2024-01-01", "x", 3, None, None)], "source_id string, checked_at string, "
                                 "fetched_sha256 string, fetched_bytes long, declared_bytes long, error_category string")
    header = lambda v, n: spark.createDataFrame([(v, n)], "schema_version string, expected_source_count long")
    for v, n, want in (("v1", 1, ("a", "unchanged", None, 0)), ("v1", 2, ("<manifest>", "invalid_baseline", "invalid_source_count", 3)),
                       ("v2", 1, ("<manifest>", "invalid_baseline", "invalid_manifest_schema", 3))):
        level = provenance.manifest_level(header(v, n), checked, "v1")
        got = provenance.freshness_report(checked, seen, level).collect()
        assert [(r.source_id, r.status, r.error_category, r.exit_code) for r in got] == [want]


def test_common_and_own_weeks_equal_a_search_day_by_day(spark):
    """Holes, overlaps, touching ranges, info ranges, unconfirmed feeds, feeds without a limit."""
    from datetime import timedelta

    rng = random.Random(9)
    day0 = date(2024, 1, 1)
    at = lambda n: day0 + timedelta(days=n)
    refs_kind = "feed_id string, reference_status string, reference_date date, info_start date, info_end date"
    for trial in range(8):
        refs, ranges = [], []
        for f in range(rng.randint(1, 4)):
            own, n = [], rng.randint(0, 10)
            for _ in range(rng.randint(0 if trial == 7 else 1, 6)):
                own.append((at(n), at(n + rng.randint(3, 60))))
                n = (own[-1][1] - day0).days + rng.choice([-5, 1, 2, 9])
            refs.append((str(f), rng.choice(["confirmed"] * 4 + ["unconfirmed"]), rng.choice([at(rng.randint(0, 30)), at(5), None]),
                         rng.choice([None, at(rng.randint(0, 40))]), rng.choice([None, at(rng.randint(40, 200))])))
            ranges += [(str(f), a, b) for a, b in own]
        part = [r for r in refs if r[1] == "confirmed" and r[2]]

        def open_on(r, d):
            return any(a <= d <= b for f, a, b in ranges if f == r[0]) and (not r[3] or d >= r[3]) and (not r[4] or d <= r[4])

        def upper(r):
            return r[4] or max((b for f, _, b in ranges if f == r[0]), default=None)

        def first(feeds):
            base, end = max(r[2] for r in feeds), min(upper(r) for r in feeds)
            monday = base + timedelta(days=-base.weekday() % 7)
            while monday + timedelta(days=6) <= end:
                if all(open_on(r, monday + timedelta(days=i)) for r in feeds for i in range(7)):
                    return monday
                monday += timedelta(days=7)

        r_df = spark.createDataFrame(refs, refs_kind)
        g_df = spark.createDataFrame(ranges, "feed_id string, start_date date, end_date date")
        got = service.common_week(r_df, g_df).first()
        if not part or any(upper(r) is None for r in part):
            assert got.metric_status == "not_calculable" and got.week_start is None
        else:
            want = first(part)
            assert (got.n_feeds, got.week_start) == (len(part), want)
            assert got.metric_status == ("measured" if want else "not_comparable_no_common_week")
        own = {r.feed_id: r.week_start for r in service.own_weeks(r_df, g_df).collect()}
        assert own == {r[0]: first([r]) if upper(r) else None for r in part}
