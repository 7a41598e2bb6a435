"""Contracts of published metric tables: each gives violation rows, none means accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions import gtfs

_SHA256 = "^[0-9a-f]{64}$"
REQUIRED_TEXT = (
    "source_zip_path", "source_zip_sha256", "scope_note", "official_reference_date",
    "checked_at", "metric_computed_at",
)


def metric_reason(value: Column, status: Column, reason: Column) -> Column:
    """First broken rule of a (value, metric_status, reason) triple, or NULL."""
    measured = status == V.MEASURED
    no_text = reason.isNull() | gtfs.is_blank(reason)
    return (
        F.when(status.isNull() | ~status.isin(*V.METRIC_STATUSES), "unknown_status")
        .when(measured & (value.isNull() | (value < 0)), "measured_without_value")
        .when(measured & reason.isNotNull(), "measured_with_reason")
        .when(~measured & value.isNotNull(), "value_without_measurement")
        .when(~measured & (status != V.NOT_CONFIRMED) & no_text, "reason_missing"))


def metric_contract(metrics: DataFrame) -> DataFrame:
    """Metric rows that break the triple rule, with ``violation``."""
    v = metric_reason(F.col("value"), F.col("metric_status"), F.col("reason"))
    return metrics.withColumn("violation", v).where(F.col("violation").isNotNull())


def week_contract(days: DataFrame, weeks: DataFrame) -> DataFrame:
    """(feed_id, n_dates, violation): seven consecutive dates equal to the declared bounds.

    Distinct dates whose span is one less than their number are consecutive, so no ordering of a
    feed's dates is needed.
    """
    per_day = days.groupBy("feed_id", "service_date").agg(F.count(F.lit(1)).alias("n"))
    got = per_day.groupBy("feed_id").agg(
        F.sum("n").alias("n_dates"), F.count("service_date").alias("n_distinct"),
        F.min("service_date").alias("first_date"), F.max("service_date").alias("last_date"))
    violation = (
        F.when(F.coalesce("n_dates", F.lit(0)) != 7, "not_seven_dates")
        .when((F.col("n_distinct") != 7) | (F.datediff("last_date", "first_date") != 6),
              "not_consecutive")
        .when((F.col("first_date") != F.col("week_start"))
              | (F.col("last_date") != F.col("week_end")), "bounds_mismatch"))
    return weeks.join(got, "feed_id", "left").select(
        "feed_id", F.coalesce("n_dates", F.lit(0)).alias("n_dates"), violation.alias("violation"))


def _record_rules(text_columns) -> dict[str, Column]:
    blank = F.lit(False)
    for c in text_columns:
        blank = blank | F.col(c).isNull() | gtfs.is_blank(F.col(c))
    keys = F.array(*map(F.lit, V.STRUCTURE_METRICS))
    return {
        "missing_text": blank,
        "bad_sha256": ~F.coalesce(F.col("source_zip_sha256"), F.lit("")).rlike(_SHA256),
        "metric_keys": F.coalesce(F.col("metric_keys"), F.array().cast("array<string>")) != keys,
    }


def comparable_set(records: DataFrame, version: str) -> DataFrame:
    """(set_id, rule_id, n): feeds shown side by side must agree on version, week and dates."""
    rules = _record_rules(("municipality", "municipality_code", *REQUIRED_TEXT))
    per = records.groupBy("set_id").agg(
        F.count_if(F.coalesce(F.col("metric_version"), F.lit("")) != version)
        .alias("metric_version"),
        (F.min(F.struct("week_start", "week_end")) != F.max(F.struct("week_start", "week_end")))
        .cast("bigint").alias("week_mismatch"),
        (F.min("date_keys") != F.max("date_keys")).cast("bigint").alias("date_keys_mismatch"),
        *[F.count_if(c).alias(r) for r, c in rules.items()])
    names = ["metric_version", "week_mismatch", "date_keys_mismatch", *rules]
    return per.unpivot("set_id", names, "rule_id", "n").where(F.col("n") > 0)


def independent_contract(records: DataFrame, version: str) -> DataFrame:
    """(feed_id, rule_id): a separately measured feed states its scope and its limits."""
    limits = F.coalesce("limitations", F.array().cast("array<string>"))
    rules = {
        "metric_version": F.coalesce(F.col("metric_version"), F.lit("")) != version,
        "measurement_scope": F.coalesce(F.col("measurement_scope"), F.lit("")) != "whole_feed",
        "comparison_mode": F.coalesce(F.col("comparison_mode"), F.lit(""))
        != "independent_not_comparable",
        **_record_rules(REQUIRED_TEXT),
        "source_size": F.coalesce("source_zip_size_bytes", F.lit(0)) <= 0,
        "too_few_limitations": F.size(limits) < 4,
        "blank_limitation": F.exists(limits, lambda x: x.isNull() | gtfs.is_blank(x)),
    }
    broken = F.array(*[F.when(c, F.lit(r)) for r, c in rules.items()])
    return records.select("feed_id", F.explode(broken).alias("rule_id")).where(
        F.col("rule_id").isNotNull())
