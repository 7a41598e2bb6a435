"""The operator row where a table of the form is missing, empty or at odds with another."""

from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.plans import operator_rows as plan

KEYED = "source_pdf string, registration_no string, "
FROM_TEXT = (
    "registration_no_raw string, authority_code string, service_type_code string, serial_no string, "
    "operator_type string, transport_type string, org_name string, org_address string, org_address_raw string, "
    "service_area_municipalities string, registered_date string, renewed_date string, valid_from string, valid_to string")


def operators(spark, rows):
    df = spark.createDataFrame(rows, KEYED + "source_page int, page_count bigint, problem string")
    return df.withColumns({c.split()[0]: F.lit("x") for c in FROM_TEXT.split(", ")})


def test_operator_rows_of_incomplete_forms(spark):
    ops = operators(spark, [
        ("p", "1", 1, 2, None), ("p", "2", 5, 1, None), ("q", "1", 1, 1, None), ("q", None, 3, 1, "registration_no_unreadable")])
    states = spark.createDataFrame([
        ("p", 1, 1, "block", "甲市"), ("p", 2, 1, "block", "乙町１"), ("p", 3, 1, "block", ""), ("p", 4, None, "appendix", "丙市"),
    ], "doc_id string, page_no int, block_start int, state string, area_raw string")
    words = spark.createDataFrame([("p", "1", ["イ", "二", "ト"]), ("p", "2", ["ト", "その他"]), ("q", "1", None)],
                                  KEYED + "words array<string>")
    offices = spark.createDataFrame([
        ("p", "1", 2, "北", "北町"), ("p", "1", 1, "南", None), ("q", "1", 1, "東", "東町")],
        KEYED + "office_seq bigint, office_name string, office_location string")
    total = V.TOTAL_LABEL
    read = spark.createDataFrame([
        ("p", "1", 1, "南", "", "バス", 2, None), ("p", "1", 1, "南", "", total, 2, None),
        ("p", "1", 2, "北", "北１丁目", "バス", 1, 1), ("p", "1", 2, "北", "北１丁目", None, 9, 9),
        ("p", "1", None, None, None, "バス", 3, 1)],
        KEYED + "office_seq bigint, office_name string, office_location string, vehicle_type string, "
                "count bigint, count_kei bigint")
    out = plan.operator_rows(ops, plan.service_areas(states), words, offices, read, "県")
    assert out.columns == list(plan.COLUMNS) and len(out.columns) == len(set(out.columns))
    got = {(r.source_pdf, r.registration_no): r for r in out.collect()}
    assert set(got) == {("p", "1"), ("p", "2"), ("q", "1")}
    a, b, c = got["p", "1"], got["p", "2"], got["q", "1"]
    marks = list(V.SCOPE_COLUMNS.values())
    assert [a[m] for m in marks] == [1, 0, 0, 1, 0, 0, 1] and not any(b[m] or c[m] for m in marks)
    assert (a.service_area, a.service_area_raw) == ("甲市\n乙町1", "甲市\n乙町１")
    assert (a.office_name, a.office_location) == ("南;北", ";北町")
    assert (a.vehicles_total, a.vehicles_total_kei, a.flags) == (3, 1, "office_notation_diff")
    assert (b.service_area, b.office_name, b.vehicles_total, b.flags) == ("", "", 0, "")
    assert (c.office_name, c.vehicles_total, c.flags) == ("東", 0, "office_mismatch")
    assert {r.pref for r in got.values()} == {"県"}


def test_no_operators(spark):
    none = operators(spark, [("p", "1", 1, 2, "dates_unreadable")])
    areas = spark.createDataFrame([], "source_pdf string, source_page int, service_area string, service_area_raw string")
    words = spark.createDataFrame([], KEYED + "words array<string>")
    offices = spark.createDataFrame([], KEYED + "office_seq bigint, office_name string, office_location string")
    read = spark.createDataFrame([], KEYED + "office_seq bigint, office_name string, office_location string, "
                                             "vehicle_type string, count bigint, count_kei bigint")
    assert plan.operator_rows(none, areas, words, offices, read, "県").isEmpty()
