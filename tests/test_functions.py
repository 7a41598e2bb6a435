"""Scalar functions on samples, one Spark job per table of samples."""

import pytest
from pyspark.sql import functions as F

from routeledger.functions import gtfs, policy
from routeledger.functions import text as T


@pytest.fixture
def apply(spark):
    """Evaluate a column function over a list of texts, in order."""
    def run(fn, values):
        df = spark.createDataFrame(
            [(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]
    return run


def test_halfwidth(apply):
    assert apply(T.halfwidth, ["Ａ１－（～）　〜ア漢", "abc"]) == ["A1-(~) ~ア漢", "abc"]


def test_blank_and_strip_cover_unicode(apply):
    assert apply(gtfs.is_blank, ["", " \t", "　 ", "　x", "\x1c "]) == [
        True, True, True, False, True]
    assert apply(gtfs.strip, ["　 a　b  "]) == ["a　b"]


@pytest.mark.parametrize("text, expected", [
    ("令和6年4月24日～令和9年4月23日", ("", "2024-04-24", "2024-04-24", "2027-04-23")),
    ("登録年月日：H18.10.1\n更新登録年月日：R5.10.1～R8.9.30",
     ("2006-10-01", "2023-10-01", "2023-10-01", "2026-09-30")),
    ("R5.10.1〜R8.9.30", ("", "2023-10-01", "2023-10-01", "2026-09-30")),
    ("登録年月日：平成30年1月2日 更新登録年月日：令和３年１月２日 ～ 令和６年１月１日",
     ("2018-01-02", "2021-01-02", "2021-01-02", "2024-01-01")),
    ("更新登録年月日：R5.10.1～R8.9.30", ("2023-10-01", "2023-10-01", "2023-10-01", "2026-09-30")),
    ("S63.1.1～R1.5.1", ("", "1988-01-01", "1988-01-01", "2019-05-01")),
    ("令和6年4月24日", None),
])
def test_registration_dates(apply, text, expected):
    got = apply(T.registration_dates, [text])[0]
    assert (tuple(got) if got else None) == expected


def test_registration_parts(apply):
    got = apply(T.registration_parts, ["中山市福第１号", "神戸市福第１号", "中山交 第 12 号", "中山第1号"])
    assert [tuple(g) if g else None for g in got] == [
        ("中山市福第1号", "中山", "福", "1"), ("神戸市福第1号", "神戸市", "福", "1"),
        ("中山交第12号", "中山", "交", "12"), None]


def test_area_prefix(apply):
    got = apply(T.area_prefix, ["下関市全域（離島を除く）", "萩市、阿武町（一部の村）", "全域"])
    assert got == [["下関市"], ["萩市", "阿武町"], []]


def test_clean_area_lines(apply):
    assert apply(T.clean_area_lines, ["路線又は\n 下関市 \n\n運送の区域 萩市\n運送の区域"]) == ["下関市\n萩市"]


def test_times_numbers_and_dates(apply):
    assert apply(gtfs.gtfs_seconds, ["6:00:00", "125:00:01", "06:60:00", "1234:00:00", "", "6:0:0"]) == [
        21600, 450001, None, None, None, None]
    assert apply(gtfs.positive_int, ["007", "0", "-1", "1.0", "", "x"]) == [7, None, None, None, None, None]
    valid = [x is not None for x in apply(
        gtfs.gtfs_date, ["20260401", "2026-04-01", "", "20261301", "20260230", "00000101", " 20260401"])]
    assert valid == [True, False, False, False, False, False, False]


def test_cell_value(apply):
    cells = ["2\n(1)", "2\n( )", "3\n0", "4", "", "１\n（２）"]
    assert [tuple(x) for x in apply(lambda c: T.cell_value(c, F.lit(True)), cells)] == [
        (2, 1), (2, 0), (3, 0), (4, 0), (0, 0), (1, 2)]
    assert tuple(apply(lambda c: T.cell_value(c, F.lit(False)), ["5"])[0]) == (5, None)


def test_vehicle_type_layouts(apply):
    kind = F.lit("交通空白地有償運送")
    assert apply(lambda c: T.vehicle_type(c, kind), ["セダン等(軽)", "普通 自動車(軽）", "シート", "謎"]) == [
        "普通自動車", "普通自動車", None, None]
    assert apply(lambda c: T.vehicle_type(c, kind, "coordinate"), ["シート車", "セダン等", "普通自動車"]) == [
        "回転シート車", "セダン等", None]


def test_scope_flags(spark):
    df = spark.createDataFrame([(1, ["イ", "二", "ト", "そ"]), (2, ["ト"])], "i int, w array<string>")
    got = {r.i: tuple(r)[1:] for r in df.select("i", *T.scope_flags(F.col("w")).values()).collect()}
    assert got == {1: (1, 0, 0, 1, 0, 0, 0), 2: (0, 0, 0, 0, 0, 0, 1)}


def test_redaction(spark):
    df = spark.createDataFrame(
        [(1, "a\n代表者の氏名 某\nb", True), (2, "a\nb", True), (3, "代表者の氏名　", True),
         (4, "a 代表者の氏名 x", False)], "i int, t string, need boolean")
    r = T.redact_lines(F.col("t"), "代表者の氏名", "[x]", F.col("need"))
    got = {x.i: (x.r.text, x.r.matched, x.r.problem) for x in df.select("i", r.alias("r")).collect()}
    assert got[1] == ("a\n代表者の氏名 [x]\nb", 1, None)
    assert got[2][2] == "count_mismatch" and got[3][2] == "empty_value"
    assert got[4] == ("a 代表者の氏名 x", 0, None)


def test_token_redaction_is_deterministic(apply):
    text = "k eyJa.b.c eyJa.b.cd end"
    once, twice = apply(T.redact_tokens, [text, text])
    assert once == twice and "eyJ" not in once and once.count("REDACTED_TOKEN_SHA256_") == 2


def test_name_candidate(spark):
    df = spark.createDataFrame([(["萩市長", "山田", "太郎"],)], "w array<string>")
    assert df.select(T.name_candidate(F.col("w"), ("市長", "理事長"))).first()[0] == "山田太郎"


def test_url_policy(apply):
    urls = ["https://ok.test/a", "http://ok.test/a", "https://no.test/a", "https://u@ok.test/",
            "https://ok.test:444/", "https://ok.test:443/", "https://ok.test/?q=1",
            "https://ok.test/#f", "https://ok.test:99999/", "HTTPS://OK.test/"]
    assert apply(lambda c: policy.url_reason(c, ["ok.test"]), urls) == [
        None, "https_required", "host_not_allowed", "userinfo_not_allowed", "port_not_allowed", None,
        "query_not_allowed", "fragment_not_allowed", "url_parse_error", None]


def test_member_names(apply):
    names = ["a.txt", "", "a\x00b", "a\\b", "/a", "C:a", "../a", "a/b", "a..b"]
    assert apply(policy.member_name_reason, names) == [
        None, "empty_name", "nul", "backslash", "absolute_path", "drive_name", "parent_reference",
        "directory", None]


def test_local_paths(apply):
    paths = ["raw/a.pdf", "raw", "/raw/a", "raw/../a", "data/a", "raw\\a", "", None]
    assert apply(policy.local_path_reason, paths) == [
        None, None, "local_path_traversal", "local_path_traversal", "local_path_must_be_under_raw",
        "local_path_must_use_posix_separators", "local_path_traversal",
        "local_path_must_use_posix_separators"]


def test_name_key_folds_width_and_case(apply):
    assert apply(policy.name_key, ["ＡＢＣ．txt", "abc.TXT", "Straße", None]) == [
        "abc.txt", "abc.txt", "strasse", None]


def test_half_step(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(4,2)) AS v FROM VALUES (3.25), (3.24), (3.75), (0.0) t(v)")
    assert [float(r[0]) for r in df.select(T.half_step(F.col("v"))).collect()] == [3.5, 3.0, 4.0, 0.0]
