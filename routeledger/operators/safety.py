"""Archive safety rules over a member table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions import policy


def archive_violations(members: DataFrame) -> DataFrame:
    """(feed_id, check_id, name, reason, n) for each broken rule; no row means safe.

    Archive-level rules (member count, total size) have no name. A name that repeats after
    normalisation is reported once, with the number of repeats.
    """
    name = F.col("name")
    judged = members.select(
        "feed_id", "name", "archive_error", "crc_ok",
        policy.member_name_reason(name).alias("name_reason"),
        policy.special_entry_reason(F.col("is_dir"), F.col("flag_bits"), F.col("unix_mode"))
        .alias("type_reason"),
        policy.oversized(F.col("file_size")).alias("oversized"),
        policy.over_ratio(F.col("file_size"), F.col("compress_size")).alias("over_ratio"))
    skip_read = F.col("name_reason").isNotNull() | F.col("type_reason").isNotNull()

    # exploding a plain array and dropping NULLs keeps the planner from evaluating it twice
    def rule(check: str, cond: Column, reason: Column) -> Column:
        return F.when(cond, F.struct(F.lit(check).alias("check_id"), reason.alias("reason")))

    rules = {
        "archive": (F.col("archive_error").isNotNull(), F.col("archive_error")),
        "member_name": (F.col("name_reason").isNotNull(), F.col("name_reason")),
        "member_type": (F.col("type_reason").isNotNull(), F.col("type_reason")),
        "member_size": (F.col("oversized"), F.lit("over_limit")),
        "compression_ratio": (F.col("over_ratio"), F.lit("over_limit")),
        "crc_or_read": (~skip_read & ~F.col("crc_ok"), F.lit("unreadable")),
    }
    per_row = F.array(*[rule(k, c, r) for k, (c, r) in rules.items()])
    rows = judged.select("feed_id", "name", F.explode(per_row).alias("v")).where(
        F.col("v").isNotNull()
    ).select("feed_id", "v.check_id", "name", "v.reason", F.lit(1).cast("bigint").alias("n"))
    named = members.where(name.isNotNull()).select("feed_id", "name")
    plain = name.rlike("^[\\x00-\\x7f]*$")
    # an ASCII name folds by lower-casing; only the others go through the normaliser
    keyed = named.where(plain).withColumn("name_key", F.lower("name")).unionByName(
        named.where(~plain).withColumn("name_key", policy.name_key(name)))
    repeats = (
        keyed.groupBy("name_key", "feed_id")
        .agg(F.count(F.lit(1)).alias("k"), F.min("name").alias("name"))
        .where(F.col("k") > 1)
        .select("feed_id", F.lit("duplicate_name").alias("check_id"), "name",
                F.lit("same_after_normalisation").alias("reason"), (F.col("k") - 1).alias("n")))
    totals = archive_totals(members)
    per_archive = F.array(
        rule("member_count", F.col("member_count") > V.MAX_MEMBERS, F.lit("over_limit")),
        rule("total_size", F.col("total_bytes") > V.MAX_TOTAL_BYTES, F.lit("over_limit")))
    whole = totals.select("feed_id", F.explode(per_archive).alias("v")).where(
        F.col("v").isNotNull()
    ).select("feed_id", "v.check_id", F.lit(None).cast("string").alias("name"), "v.reason",
             F.lit(1).cast("bigint").alias("n"))
    return rows.unionByName(repeats).unionByName(whole)


def archive_totals(members: DataFrame) -> DataFrame:
    """(feed_id, member_count, total_bytes, max_ratio)."""
    return members.where(F.col("name").isNotNull()).groupBy("feed_id").agg(
        F.count(F.lit(1)).alias("member_count"), F.sum("file_size").alias("total_bytes"),
        F.max(policy.compression_ratio(F.col("file_size"), F.col("compress_size")))
        .alias("max_ratio"))
