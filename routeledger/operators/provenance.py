"""Source manifests, freshness, reproduction and the release decision."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions import policy
from routeledger.functions import text as T

_SHA256 = "^[0-9a-f]{64}$"


def manifest_checks(
    manifest: DataFrame, fingerprints: DataFrame, hosts: Iterable[str]
) -> DataFrame:
    """Manifest rows with ``reason``: the first broken rule in fixed order, or NULL.

    ``fingerprints``: local_path, actual_bytes, actual_sha256 of the files that exist.
    """
    c = {name: F.col(name) for name in V.MANIFEST_COLUMNS}
    missing = F.lit(False)
    for col in c.values():
        missing = missing | col.isNull()
    repeated = manifest.groupBy("source_id").agg(F.count(F.lit(1)).alias("_n")).where(
        "_n > 1").select("source_id", F.lit(True).alias("_repeated"))
    day = c["baseline_acquired_at"]
    bad_day = ~day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") | F.try_to_date(day, "yyyy-MM-dd").isNull()
    path_reason = policy.local_path_reason(c["local_path"])
    reason = (
        F.when(missing, "missing_fields")
        .when(~c["source_id"].rlike("^[a-z0-9][a-z0-9-]{1,63}$"), "invalid_source_id")
        .when(F.coalesce("_repeated", F.lit(False)), "duplicate_source_id")
        .when(~c["source_type"].isin(*V.SOURCE_TYPES), "invalid_source_type")
        .when(policy.url_reason(c["official_url"], hosts).isNotNull(), "invalid_official_url")
        .when(~c["baseline_sha256"].rlike(_SHA256), "invalid_baseline_sha256")
        .when(c["baseline_bytes"] < 0, "invalid_baseline_bytes")
        .when(c["max_download_bytes"] <= 0, "invalid_max_download_bytes")
        .when(c["baseline_bytes"] > c["max_download_bytes"], "baseline_exceeds_download_limit")
        .when(bad_day, "invalid_baseline_acquired_at")
        .when(path_reason.isNotNull(), path_reason)
        .when(F.col("actual_sha256").isNull(), "baseline_file_missing")
        .when(F.col("actual_bytes") != c["baseline_bytes"], "baseline_size_mismatch")
        .when(F.col("actual_sha256") != c["baseline_sha256"], "baseline_sha256_mismatch"))
    return (
        manifest.join(repeated, "source_id", "left").join(fingerprints, "local_path", "left")
        .select(*V.MANIFEST_COLUMNS, reason.alias("reason")))


def manifest_level(header: DataFrame, manifest: DataFrame, schema_version: str) -> DataFrame:
    """(reason) of a manifest as a whole: wrong schema or a source count other than declared.

    ``header``: one row of schema_version and expected_source_count. No row means acceptable.
    """
    declared = header.select(
        F.lit(0).cast("bigint").alias("n"), "schema_version", "expected_source_count")
    counted = manifest.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(None).cast("string").alias("schema_version"),
        F.lit(None).cast("bigint").alias("expected_source_count"))
    both = declared.unionByName(counted).agg(
        F.sum("n").alias("n"), F.max("schema_version").alias("schema_version"),
        F.max("expected_source_count").alias("expected"))
    wrong_count = F.col("expected").isNull() | (F.col("expected") <= 0) | (
        F.col("expected") != F.col("n"))
    reason = F.when(
        F.coalesce(F.col("schema_version"), F.lit("")) != schema_version, "invalid_manifest_schema"
    ).when(wrong_count, "invalid_source_count")
    return both.select(reason.alias("reason")).where(F.col("reason").isNotNull())


def manifest_violations(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).select("source_id", "local_path", "reason")


def exit_code(status: Column) -> Column:
    out = F.lit(V.EMPTY_REPORT_EXIT)
    for s, code in V.FRESHNESS_EXIT.items():
        out = F.when(status == s, code).otherwise(out)
    return out


def freshness_report(
    checked: DataFrame, observations: DataFrame, level: DataFrame | None = None
) -> DataFrame:
    """Status of every manifest row against its latest fetch.

    With ``level``, the findings of ``manifest_level``, a manifest that is refused as a whole gives one row
    of its own and none of its sources is compared. A row that breaks the manifest contract is never compared. A declared or received size over
    the limit wins over the digest; a row nobody fetched is unavailable.
    """
    refused = level.first() if level is not None else None
    if refused is not None:
        return checked.sparkSession.range(1).select(
            F.lit("<manifest>").alias("source_id"), F.lit(None).cast("string").alias("local_path"),
            F.lit("invalid_baseline").alias("status"), F.lit(refused["reason"]).alias("error_category"),
            F.lit(None).cast("bigint").alias("fetched_bytes"), exit_code(F.lit("invalid_baseline")).alias("exit_code"))
    over = F.col("declared_bytes") > F.col("max_download_bytes")
    streamed = F.col("fetched_bytes") > F.col("max_download_bytes")
    invalid = F.col("reason").isNotNull()
    status = (
        F.when(invalid, "invalid_baseline")
        .when(over | streamed, "oversize")
        .when(F.col("error_category").isNotNull() | F.col("fetched_sha256").isNull(), "unavailable")
        .when(F.col("fetched_sha256") == F.col("baseline_sha256"), "unchanged")
        .otherwise("changed"))
    category = (
        F.when(invalid, F.col("reason"))
        .when(over, "content_length_exceeds_limit").when(streamed, "stream_exceeds_limit")
        .when(F.col("error_category").isNotNull(), F.col("error_category"))
        .when(F.col("fetched_sha256").isNull(), "not_fetched"))
    fetched = F.when(~invalid, F.when(over, F.col("declared_bytes")).otherwise(F.col("fetched_bytes")))
    return (
        checked.join(latest_observations(observations), "source_id", "left")
        .withColumn("status", status)
        .select("source_id", "local_path", "status", category.alias("error_category"),
                fetched.alias("fetched_bytes"), exit_code(F.col("status")).alias("exit_code")))


def latest_observations(observations: DataFrame) -> DataFrame:
    """One row per source: the fetch with the greatest ``checked_at``."""
    rest = [c for c in observations.columns if c not in ("source_id", "checked_at")]
    return observations.groupBy("source_id").agg(
        F.max_by(F.struct(*rest), F.struct("checked_at", *rest)).alias("o")
    ).select("source_id", "o.*")


def freshness_summary(report: DataFrame) -> DataFrame:
    """(status, n, worst_exit): every status, absent ones 0; an empty report exits with 3."""
    s = F.col("status")
    statuses = list(V.FRESHNESS_EXIT)
    wide = report.agg(
        *[F.count_if(s == v).alias(v) for v in statuses],
        F.coalesce(F.max(exit_code(s)), F.lit(V.EMPTY_REPORT_EXIT)).alias("worst_exit"))
    return wide.unpivot("worst_exit", statuses, "status", "n").select("status", "n", "worst_exit")


def reproduction_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, recreated, expected, byte_match, normalized_match) over both file sets.

    Inputs are (path, text). Contents are reduced to size and digests before they are joined;
    the normalised digest ignores CRLF against LF only.
    """
    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(
            "path", F.octet_length("text").cast("bigint").alias(f"{p}_bytes"),
            F.sha2("text", 256).alias(f"{p}_sha"),
            F.sha2(T.newline_norm(F.col("text")), 256).alias(f"{p}_norm"))

    j = side(expected, "expected").join(side(actual, "actual"), "path", "full_outer")
    both = F.col("expected_sha").isNotNull() & F.col("actual_sha").isNotNull()
    return j.select(
        "path", F.col("actual_sha").isNotNull().alias("recreated"),
        F.col("expected_sha").isNotNull().alias("expected"),
        "expected_bytes", "actual_bytes",
        (both & (F.col("expected_sha") == F.col("actual_sha"))).alias("byte_match"),
        (both & (F.col("expected_norm") == F.col("actual_norm"))).alias("normalized_match"))


def release_decision(
    checked: DataFrame, diff: DataFrame, report: DataFrame, require_bytes: bool = True,
    findings: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """(check_id, n_failed, decision): GO only when no check failed anywhere.

    Each input is read once and reduced to its counters; an empty input fails its checks.
    ``findings``: further checks by name, each a table whose every row is a failure, such as
    ``manifest_level`` or a scorecard's broken rules.
    """
    findings = findings or {}
    def counters(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
        n = F.count(F.lit(1))
        wide = df.agg(*[
            F.when(n == 0, 1).otherwise(F.count_if(c)).cast("bigint").alias(k)
            for k, c in checks.items()])
        return wide.unpivot([], list(checks), "check_id", "n_failed")

    wanted = F.col("expected")
    ok = F.col("byte_match") if require_bytes else F.lit(True)
    union = (
        counters(checked, {"accepted_sources": F.col("reason").isNotNull()})
        .unionByName(counters(diff, {
            "normalized_reconstruction": wanted & ~F.col("normalized_match"),
            "exact_byte_reconstruction": wanted & ~ok,
            "no_unexpected_files": ~wanted,
        }))
        .unionByName(counters(report, {"sources_available": F.col("exit_code") > 1})))
    for name, rows in findings.items():
        union = union.unionByName(rows.agg(F.count(F.lit(1)).alias("n_failed")).select(
            F.lit(name).alias("check_id"), "n_failed"))
    ids = ["accepted_sources", "normalized_reconstruction", "exact_byte_reconstruction",
           "no_unexpected_files", "sources_available", *findings]
    wide = union.agg(
        F.sum("n_failed").alias("total"),
        *[F.max(F.when(F.col("check_id") == i, F.col("n_failed"))).alias(i) for i in ids])
    return wide.unpivot("total", ids, "check_id", "n_failed").select(
        "check_id", "n_failed",
        F.when(F.col("total") == 0, "GO").otherwise("NO_GO").alias("decision"))
