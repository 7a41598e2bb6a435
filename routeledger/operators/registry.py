"""Operator registry: totals, office comparison, validity periods and municipal views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions import text as T

OPERATOR_KEY = ["source_pdf", "registration_no"]


def nonzero_rows(vehicles: DataFrame) -> DataFrame:
    """Drop rows with no vehicle and no inner count."""
    return vehicles.where(~((F.col("count") == 0) & (F.coalesce("count_kei", F.lit(0)) == 0)))


def reconcile_totals(operators: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Detail rows against printed totals, per office and per operator, outer and inner counts.

    Total rows are check rows and never join the detail sum. An operator without vehicle rows
    has detail 0.
    """
    is_total = F.col("vehicle_type") == V.TOTAL_LABEL
    kei = F.coalesce("count_kei", F.lit(0))
    office = vehicles.groupBy(*OPERATOR_KEY, "office_seq").agg(
        F.sum(F.when(~is_total, F.col("count")).otherwise(0)).alias("d"),
        F.sum(F.when(~is_total, kei).otherwise(0)).alias("dk"),
        F.sum(F.when(is_total, F.col("count"))).alias("t"),
        F.sum(F.when(is_total, kei)).alias("tk"),
    )
    differs = F.col("t").isNotNull() & ((F.col("d") != F.col("t")) | (F.col("dk") != F.col("tk")))
    per_op = office.groupBy(*OPERATOR_KEY).agg(
        F.sum("d").alias("detail_count"), F.sum("dk").alias("detail_kei"),
        F.count_if(differs).alias("office_mismatches"))
    out = operators.select(*OPERATOR_KEY, "vehicles_total", "vehicles_total_kei").join(
        per_op, OPERATOR_KEY, "left").na.fill(
        0, ["detail_count", "detail_kei", "office_mismatches"])
    same = (F.col("detail_count") == F.col("vehicles_total")) & (
        F.col("detail_kei") == F.col("vehicles_total_kei")) & (F.col("office_mismatches") == 0)
    return out.withColumn("is_consistent", same)


def inner_le_outer(vehicles: DataFrame) -> DataFrame:
    """Per source: rows with an inner count, and those where it exceeds the outer count."""
    return vehicles.groupBy("source_pdf").agg(
        F.count("count_kei").alias("checked"),
        F.count_if(F.col("count_kei") > F.col("count")).alias("violations"))


def office_flags(top: DataFrame, vehicle_side: DataFrame) -> DataFrame:
    """(key, flags): offices of the two tables compared by position, never by name.

    A different number of offices is a mismatch on its own. Otherwise a different name is a
    mismatch and, where the name agrees, a different place is a notation difference; an empty
    vehicle-side cell is not compared. Flags keep the order in which they first occur.
    """
    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(
            *OPERATOR_KEY, "office_seq", T.compare_key(F.col("office_name")).alias(f"{p}_name"),
            T.compare_key(F.col("office_location")).alias(f"{p}_loc"), F.lit(1).alias(p))

    both = side(top, "a").join(side(vehicle_side, "b"), [*OPERATOR_KEY, "office_seq"], "full_outer")
    name = (F.col("b_name") != "") & (F.col("a_name") != F.col("b_name"))
    loc = (F.col("b_loc") != "") & (F.col("a_loc") != F.col("b_loc"))
    agg = both.groupBy(*OPERATOR_KEY).agg(
        F.count("a").alias("n_top"), F.count("b").alias("n_vehicle"),
        F.min(F.when(name, F.col("office_seq"))).alias("first_name"),
        F.min(F.when(~name & loc, F.col("office_seq"))).alias("first_loc"))
    flags = F.when(F.col("n_top") != F.col("n_vehicle"), F.lit(V.OFFICE_MISMATCH)).otherwise(
        F.concat_ws(";", F.transform(
            F.array_sort(F.array_compact(F.array(
                F.when(F.col("first_name").isNotNull(),
                       F.struct(F.col("first_name").alias("s"), F.lit(V.OFFICE_MISMATCH).alias("f"))),
                F.when(F.col("first_loc").isNotNull(),
                       F.struct(F.col("first_loc").alias("s"), F.lit(V.OFFICE_NOTATION).alias("f")))))),
            lambda x: x["f"])))
    return agg.select(*OPERATOR_KEY, "n_top", "n_vehicle", flags.alias("flags"))


def period_sanity(operators: DataFrame, years=(2, 3, 5), low=2005, high=2099) -> DataFrame:
    """Warnings about validity periods; a period lasts whole years and ends a day early."""
    start, end = F.col("valid_from"), F.col("valid_to")
    whole = F.lit(False)
    for n in years:
        whole = whole | (end == F.date_sub(F.add_months(start, 12 * n), 1))
    warning = (
        F.when(start >= end, "not_ascending")
        .when((F.year(start) < low) | (F.year(end) > high), "year_out_of_range")
        .when(~whole, "unusual_length"))
    return operators.select(*OPERATOR_KEY, "valid_from", "valid_to", warning.alias("warning"))


def expiring_soon(operators: DataFrame, as_of: date, months: int = 6) -> DataFrame:
    """Registrations that end within ``months`` of ``as_of``."""
    limit = F.add_months(F.lit(as_of), months)
    return operators.where((F.col("valid_to") >= F.lit(as_of)) & (F.col("valid_to") <= limit)).select(
        *OPERATOR_KEY, "valid_to")


def registry_contract(operators: DataFrame, authority: str) -> DataFrame:
    """(rule_id, source_pdf, registration_no, n): broken consistency rules of the registry."""
    code_ok = F.lit(False)
    for kind, codes in V.SERVICE_TYPE_CODES.items():
        code_ok = code_ok | (
            (F.col("transport_type") == kind) & F.col("service_type_code").isin(*codes))
    any_scope = F.lit(0)
    for c in V.SCOPE_COLUMNS.values():
        any_scope = any_scope + F.col(c)
    rules = {
        "service_type_code": ~code_ok,
        "authority_code": F.col("authority_code") != authority,
        "scope_in_gap_area": (F.col("transport_type") == V.GAP_AREA_TYPE) & (any_scope != 0),
        "partner_not_empty": (F.col("partner_operator_name") != "")
        | (F.col("partner_operator_address") != ""),
    }
    broken = F.array(*[F.when(c, F.lit(r)) for r, c in rules.items()])
    rows = operators.select(*OPERATOR_KEY, F.explode(broken).alias("rule_id")).where(
        F.col("rule_id").isNotNull()).groupBy(
        "rule_id", *OPERATOR_KEY).agg(F.count(F.lit(1)).alias("n"))
    dup = operators.groupBy(*OPERATOR_KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.unionByName(dup.withColumn("rule_id", F.lit("duplicate_key")))


# -- municipal views --------------------------------------------------------------------------

_SUMS = ("operator_count", "vehicles_total", "vehicles_total_kei")


def by_municipality(operators: DataFrame) -> DataFrame:
    """One row per (operator, municipality it serves)."""
    return operators.withColumn(
        "municipality",
        F.explode(F.array_distinct(T.split_list(F.col("service_area_municipalities")))))


def _summary(grouped) -> DataFrame:
    return grouped.agg(
        F.count(F.lit(1)).alias("operator_count"), F.sum("vehicles_total").alias("vehicles_total"),
        F.sum("vehicles_total_kei").alias("vehicles_total_kei"))


def municipal_supply(operators: DataFrame, roster: DataFrame) -> DataFrame:
    """Registered supply per municipality in official order, places without records kept."""
    per = _summary(by_municipality(operators).groupBy("municipality"))
    return (
        roster.select("roster_ord", "municipality").join(per, "municipality", "left")
        .na.fill(0, list(_SUMS)).select("roster_ord", "municipality", *_SUMS)
        .orderBy("roster_ord"))


def municipal_supply_by_type(operators: DataFrame, roster: DataFrame) -> DataFrame:
    """The same per transport type, every type present for every municipality."""
    per = _summary(by_municipality(operators).groupBy("municipality", "transport_type"))
    types = F.explode(F.array(*map(F.lit, V.TRANSPORT_TYPES))).alias("transport_type")
    return (
        roster.select("roster_ord", "municipality", types)
        .join(per, ["municipality", "transport_type"], "left").na.fill(0, list(_SUMS))
        .select("roster_ord", "municipality", "transport_type", *_SUMS))


def unique_vs_exploded(operators: DataFrame) -> DataFrame:
    """Prefecture totals on operators themselves, beside the larger sum over municipalities."""
    places = F.size(F.array_distinct(T.split_list(F.col("service_area_municipalities"))))
    w = F.when(places > 0, places).otherwise(0)
    return operators.agg(
        F.count(F.lit(1)).alias("unique_operators"),
        F.sum("vehicles_total").alias("unique_vehicles"),
        F.sum("vehicles_total_kei").alias("unique_kei"),
        F.sum(w).alias("summed_operators"),
        F.sum(F.col("vehicles_total") * w).alias("summed_vehicles"),
        F.sum(F.col("vehicles_total_kei") * w).alias("summed_kei"))


def municipal_supply_document(operators: DataFrame, roster: DataFrame) -> DataFrame:
    """One nested row per municipality for the JSON sink: totals, types and operator list.

    Only the sink needs arrays; the operator list of a municipality is what the document prints.
    """
    types = municipal_supply_by_type(operators, roster).groupBy("municipality").agg(
        F.sort_array(F.collect_list(F.struct("transport_type", *_SUMS))).alias("by_transport_type"))
    listed = by_municipality(operators).groupBy("municipality").agg(F.sort_array(F.collect_list(
        F.struct(*OPERATOR_KEY, "transport_type", "vehicles_total", "vehicles_total_kei")
    )).alias("operators"))
    return municipal_supply(operators, roster).join(types, "municipality", "left").join(
        listed, "municipality", "left")


def vehicle_mix(operators: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Vehicles per municipality and type: outer counts only, total rows left out."""
    per_type = vehicles.where(F.col("vehicle_type") != V.TOTAL_LABEL).groupBy(
        *OPERATOR_KEY, "vehicle_type").agg(F.sum("count").alias("n"))
    return (
        by_municipality(operators).select(*OPERATOR_KEY, "municipality")
        .join(per_type, OPERATOR_KEY)
        .groupBy("municipality", "vehicle_type").agg(F.sum("n").alias("vehicle_count")))
