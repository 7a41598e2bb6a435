"""Operator registry from page texts.

Each page is reduced to its few fields before any shuffle; pages are then grouped into blocks and
blocks into operators. Only place hits of a block, at most one per roster place, are collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions import text as T
from routeledger.operators import ordered, scans

_GAP = "[ \\t\u3000]"


def is_anchor(text: Column) -> Column:
    """A page that prints the registration-number label."""
    return text.rlike(rf"登{T.W}*録{T.W}*番{T.W}*号")


def page_fields(pages: DataFrame, appendix_marker: str) -> DataFrame:
    """(doc_id, page_no, flags, redaction, fields of the printed form)."""
    t = F.col("text")
    anchor = is_anchor(t)

    def line(pattern: str) -> Column:
        return T.strip(F.regexp_extract(t, pattern, 1))

    dates = F.regexp_extract(t, rf"(?s)登録年月日及び(.*?)\n名{_GAP}*称", 1)
    kind = F.regexp_extract(
        T.remove_blanks(F.regexp_extract(t, rf"(?s)\n住{_GAP}*所(.*?)\n運送の種別", 1)),
        "(" + "|".join(V.TRANSPORT_TYPES) + ")", 1)
    area = T.clean_area_lines(
        F.regexp_extract(t, r"(?s)(?:^|\n)((?:[^\n]*起点|路線又は).*?運送の区域)", 1))
    redacted = T.redact_lines(t, V.REDACTION_LABEL, V.REDACTION_MARKER, anchor)
    return pages.select(
        "doc_id", "page_no", anchor.alias("anchor"),
        t.contains(appendix_marker).alias("appendix"),
        redacted["problem"].alias("redaction_problem"),
        line(rf"登{_GAP}*録{_GAP}*番{_GAP}*号{_GAP}*([^\n]+)").alias("registration_no_raw"),
        T.registration_dates(dates).alias("dates"),
        line(rf"(?:^|\n)名{_GAP}*称{_GAP}+([^\n]+)").alias("org_name"),
        line(rf"(?:^|\n)住{_GAP}*所{_GAP}+([^\n]+)").alias("org_address_raw"),
        kind.alias("transport_type"), T.halfwidth(area).alias("area"), area.alias("area_raw"))


def redacted_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, text, problem): publishable page texts."""
    r = T.redact_lines(
        F.col("text"), V.REDACTION_LABEL, V.REDACTION_MARKER, is_anchor(F.col("text")))
    return pages.select("doc_id", "page_no", r.alias("r")).select(
        "doc_id", "page_no", "r.text", "r.problem")


def page_states(fields: DataFrame) -> DataFrame:
    """Page fields with ``block_start`` and ``state``."""
    return ordered.page_blocks(
        fields, "doc_id", "page_no", F.col("anchor"), F.col("appendix"))


def page_problems(states: DataFrame) -> DataFrame:
    """(doc_id, page_no, problem): pages outside any block or with a redaction fault."""
    outside = F.when(F.col("state").startswith("error_"), F.col("state"))
    return states.select(
        "doc_id", "page_no", F.coalesce(outside, "redaction_problem").alias("problem")
    ).where(F.col("problem").isNotNull())


def registry_from_text(
    states: DataFrame, roster: DataFrame, operator_types: DataFrame
) -> DataFrame:
    """One operator row per block; ``problem`` names the first unreadable field.

    ``operator_types``: doc_id, operator_type. Service areas of all pages of a block count, in
    page order.
    """
    block = ["doc_id", "block_start"]
    pages = states.where(F.col("state") == "block")
    size = pages.groupBy(*block).agg(F.count(F.lit(1)).alias("page_count"))
    hits = scans.roster_hits(pages, [*block, "page_no"], "area", roster)
    # position over the whole block: page first, then place on the page
    at = F.col("page_no").cast("bigint") * (1 << 32) + F.col("pos")
    places = (
        hits.groupBy(*block, "name").agg(F.min(at).alias("pos"))
        .groupBy(*block).agg(F.collect_set(F.struct("pos", "name")).alias("hits")))
    start = pages.where(F.col("page_no") == F.col("block_start"))
    own = F.col("org_name").rlike("[市町村]$")
    number = T.registration_parts(F.col("registration_no_raw"))
    none = F.array().cast("array<struct<pos:bigint,name:string>>")
    out = (
        # by their compressed files the landed pages look small enough to broadcast; they are not
        start.join(size.hint("merge"), block).join(places.hint("merge"), block, "left")
        .join(operator_types.hint("merge"), "doc_id", "left")
        .withColumn("r", number).withColumn("hits", F.coalesce("hits", none)))
    named = F.exists("hits", lambda h: h["name"] == F.col("org_name"))
    first = F.when(own & ~named, F.array(F.struct(
        F.lit(-1).cast("bigint").alias("pos"), F.col("org_name").alias("name")))).otherwise(none)
    names = F.transform(F.array_sort(F.concat(first, "hits")), lambda h: h["name"])
    problem = (
        F.when(F.col("redaction_problem").isNotNull(), F.col("redaction_problem"))
        .when(F.col("r").isNull(), "registration_no_unreadable")
        .when(F.col("dates").isNull(), "dates_unreadable")
        .when(F.col("org_name") == "", "org_name_missing")
        .when(F.col("transport_type") == "", "transport_type_unknown"))
    return out.select(
        F.col("doc_id").alias("source_pdf"), F.col("page_no").alias("source_page"), "page_count",
        "r.registration_no", "registration_no_raw", "r.authority_code", "r.service_type_code",
        "r.serial_no", "operator_type", "transport_type", "org_name",
        T.halfwidth(F.col("org_address_raw")).alias("org_address"), "org_address_raw",
        F.array_join(names, ";").alias("service_area_municipalities"),
        "dates.registered_date", "dates.renewed_date", "dates.valid_from", "dates.valid_to",
        problem.alias("problem"))
