"""The whole operator row of the registry: what the page texts give, joined with the tables of the form.

Page texts give numbers, dates, names and areas; the form's tables give the passengers in scope, the offices and
the vehicles. All meet on the operator key. What an operator row lists in one cell (its offices, the lines of its
area) is collected per operator, as the printed form holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions import text as T
from routeledger.operators import registry

KEY = list(registry.OPERATOR_KEY)

COLUMNS = (
    "registration_no", "registration_no_raw", "authority_code", "service_type_code", "serial_no", "pref",
    "transport_type", "operator_type", "org_name", "org_address", "org_address_raw", "service_area",
    "service_area_raw", "service_area_municipalities", "registered_date", "renewed_date", "valid_from", "valid_to",
    *V.SCOPE_COLUMNS.values(), "office_name", "office_location", "partner_operator_name",
    "partner_operator_address", "vehicles_total", "vehicles_total_kei", "source_pdf", "source_page", "flags",
)


def service_areas(states: DataFrame) -> DataFrame:
    """(source_pdf, source_page, service_area, service_area_raw): area texts of a block's pages, in page order."""
    pages = states.where((F.col("state") == "block") & (F.col("area_raw") != "")).groupBy("doc_id", "block_start").agg(
        F.array_sort(F.collect_list(F.struct("page_no", "area_raw"))).alias("pages"))
    raw = F.array_join(F.transform("pages", lambda p: p["area_raw"]), "\n")
    return pages.select(
        F.col("doc_id").alias("source_pdf"), F.col("block_start").alias("source_page"),
        T.halfwidth(raw).alias("service_area"), raw.alias("service_area_raw"))


def _offices(offices: DataFrame) -> DataFrame:
    listed = offices.groupBy(*KEY).agg(F.array_sort(F.collect_list(
        F.struct("office_seq", "office_name", "office_location"))).alias("o"))

    def joined(cell: str) -> Column:
        return F.array_join(F.transform("o", lambda x: F.coalesce(x[cell], F.lit(""))), ";").alias(cell)

    return listed.select(*KEY, joined("office_name"), joined("office_location"))


def _totals(read: DataFrame) -> DataFrame:
    """Vehicles of the offices' types; columns of totals and unknown headings do not count."""
    counted = read.where(F.col("office_seq").isNotNull() & (F.col("vehicle_type") != V.TOTAL_LABEL))
    return counted.groupBy(*KEY).agg(
        F.sum("count").alias("vehicles_total"), F.sum(F.coalesce("count_kei", F.lit(0))).alias("vehicles_total_kei"))


def operator_rows(
    operators: DataFrame, areas: DataFrame, scope_words: DataFrame, offices: DataFrame, read: DataFrame,
    prefecture: str,
) -> DataFrame:
    """One row of ``COLUMNS`` per operator that could be read.

    ``operators`` comes from ``registry_from_text``; those with a problem are no rows. ``areas`` comes from
    ``service_areas``. The others are keyed by source and registration number: ``scope_words`` (words: the words of
    the passenger box), ``offices`` (office_seq, office_name, office_location above the vehicle table) and ``read``
    (cells of the vehicle table, one row per office and type). An operator that a table does not have gets 0 marks,
    empty offices, 0 vehicles and no flag. Partners are not printed on the form and stay empty.
    """
    inside = read.where(F.col("office_seq").isNotNull()).groupBy(*KEY, "office_seq").agg(
        F.min("office_name").alias("office_name"), F.min("office_location").alias("office_location"))
    flags = registry.office_flags(offices, inside).select(*KEY, "flags")
    scope = scope_words.select(*KEY, *T.scope_flags(F.col("words")).values())
    marks = list(V.SCOPE_COLUMNS.values())
    whole = operators.where(F.col("problem").isNull()).join(areas, ["source_pdf", "source_page"], "left")
    for side in (scope, _offices(offices), _totals(read), flags):
        whole = whole.join(side, KEY, "left")
    empty = ["service_area", "service_area_raw", "office_name", "office_location", "flags"]
    return whole.na.fill("", empty).na.fill(0, [*marks, "vehicles_total", "vehicles_total_kei"]).withColumns({
        "pref": F.lit(prefecture), "partner_operator_name": F.lit(""), "partner_operator_address": F.lit(""),
    }).select(*COLUMNS)
