"""Scorecards: equal-weight means rounded to half steps, and their contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from routeledger import vocab as V
from routeledger.functions.text import half_step


def scorecard(scores: DataFrame) -> DataFrame:
    """(subject_id, criterion scores, comparison_index) from (subject, criterion, sub, score)."""
    exact = F.col("score").cast("decimal(4,2)")
    per = scores.groupBy("subject_id", "criterion_id").agg(
        half_step((F.sum(exact) / F.count(F.lit(1))).cast("decimal(12,8)")).alias("s"))
    wide = per.groupBy("subject_id").agg(
        *[F.max(F.when(F.col("criterion_id") == c, F.col("s"))).alias(c)
          for c in V.SCORE_SUBCRITERIA])
    total = sum((F.col(c) for c in V.SCORE_SUBCRITERIA), F.lit(0).cast("decimal(4,1)"))
    index = F.round(total * 100 / (5 * len(V.SCORE_SUBCRITERIA)), 1)
    return wide.select(
        "subject_id", *[F.col(c).cast("double").alias(c) for c in V.SCORE_SUBCRITERIA],
        index.cast("double").alias("comparison_index"))


def scorecard_contract(scores: DataFrame) -> DataFrame:
    """(subject_id, rule_id, n): scores off the half-step scale, unknown or missing parts,
    missing evidence."""
    pairs = [f"{c}/{s}" for c, subs in V.SCORE_SUBCRITERIA.items() for s in subs]
    score = F.col("score").cast("decimal(4,2)")
    known = F.concat_ws("/", "criterion_id", "subcriterion_id").isin(*pairs)
    per_sub = scores.groupBy("subject_id", "criterion_id", "subcriterion_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(score.isNull() | (score < 0) | (score > 5)).alias("out_of_range"),
        F.count_if(score * 2 != F.floor(score * 2)).alias("not_half_step"),
        F.count_if(F.coalesce(F.trim("evidence"), F.lit("")) == "").alias("missing_evidence"))
    rules = {
        "out_of_range": F.sum("out_of_range"), "not_half_step": F.sum("not_half_step"),
        "missing_evidence": F.sum("missing_evidence"),
        "unknown_subcriterion": F.sum(F.when(~known, F.col("n")).otherwise(0)),
        "duplicate_subcriterion": F.sum(F.col("n") - 1),
        "missing_subcriterion": F.lit(len(pairs)) - F.count_if(known),
    }
    per = per_sub.groupBy("subject_id").agg(*[
        v.cast("bigint").alias(k) for k, v in rules.items()])
    return per.unpivot("subject_id", list(rules), "rule_id", "n").where(F.col("n") > 0)


def top_improvements(items: DataFrame, limit: int = 3) -> DataFrame:
    """(subject_id, priority, improvement_id): the best ``limit`` per subject by expected gain.

    The rank filter lets map tasks keep only ``limit`` rows per subject before the shuffle.
    """
    w = Window.partitionBy("subject_id").orderBy(F.col("expected_gain").desc(), "improvement_id")
    return items.withColumn("priority", F.row_number().over(w)).where(
        F.col("priority") <= limit).select("subject_id", "priority", "improvement_id")
