"""Municipality access status, its feeds, and the hand-off states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions import text as T


def roster_equality(roster: DataFrame, status: DataFrame) -> DataFrame:
    """(municipality, problem): the status table must name each roster place exactly once."""
    both = (
        roster.select("municipality", F.lit(1).alias("r"), F.lit(0).alias("s"))
        .unionByName(status.select("municipality", F.lit(0).alias("r"), F.lit(1).alias("s")))
        .groupBy("municipality").agg(F.sum("r").alias("r"), F.sum("s").alias("s")))
    problem = (
        F.when(F.col("r") == 0, "not_in_roster").when(F.col("s") == 0, "missing_status")
        .when((F.col("r") > 1) | (F.col("s") > 1), "duplicate"))
    return both.select("municipality", problem.alias("problem")).where("problem IS NOT NULL")


def feed_bridge(status: DataFrame) -> DataFrame:
    """(municipality, pos, feed_id): the ordered feed list as rows."""
    return status.select(
        "municipality", F.posexplode(T.split_list(F.col("feed_ids"))).alias("pos", "feed_id"))


def bridge_violations(status: DataFrame, feeds: DataFrame) -> DataFrame:
    """(rule_id, entity, detail): unknown state, empty list, unresolved feed, duplicate feed id."""
    state = status.where(~F.col("availability_status").isin(*V.ACCESS_STATUSES)).select(
        F.lit("unknown_status").alias("rule_id"), F.col("municipality").alias("entity"),
        F.col("availability_status").alias("detail"))
    empty = status.where(F.size(T.split_list(F.col("feed_ids"))) == 0).select(
        F.lit("empty_feed_list").alias("rule_id"), F.col("municipality").alias("entity"),
        F.lit("").alias("detail"))
    ids = feeds.groupBy("feed_id").agg(F.count(F.lit(1)).alias("n"))
    unknown = feed_bridge(status).join(ids, "feed_id", "left_anti").select(
        F.lit("unknown_feed").alias("rule_id"), F.col("municipality").alias("entity"),
        F.col("feed_id").alias("detail")).distinct()
    dup = ids.where("n > 1").select(
        F.lit("duplicate_feed_id").alias("rule_id"), F.col("feed_id").alias("entity"),
        F.lit("").alias("detail"))
    return state.unionByName(empty).unionByName(unknown).unionByName(dup)


def municipality_access(roster: DataFrame, status: DataFrame, feeds: DataFrame) -> DataFrame:
    """The accepted state of every roster place with its feeds, and how many feeds resolve."""
    ids = feeds.select("feed_id").distinct().withColumn("known", F.lit(1))
    n = feed_bridge(status).join(ids, "feed_id", "left").groupBy("municipality").agg(
        F.count(F.lit(1)).alias("feed_count"), F.count("known").alias("known_feed_count"))
    return (
        roster.join(status, "municipality", "left").join(n, "municipality", "left")
        .na.fill(0, ["feed_count", "known_feed_count"])
        .select("roster_ord", "municipality", "availability_status", "feed_ids", "feed_count",
                "known_feed_count"))


def access_state_counts(status: DataFrame) -> DataFrame:
    """(availability_status, n) with every state of the vocabulary, absent ones as 0."""
    s = F.col("availability_status")
    wide = status.agg(*[F.count_if(s == v).alias(v) for v in V.ACCESS_STATUSES])
    return wide.unpivot([], list(V.ACCESS_STATUSES), "availability_status", "n")


def metrics_by_municipality(metrics: DataFrame, status: DataFrame) -> DataFrame:
    """Feed metrics a municipality may refer to, found through its feed list only.

    The value stays a whole-feed value: it is neither split nor added up.
    """
    return feed_bridge(status).join(metrics, "feed_id").select(
        "municipality", "feed_id", "metric_id", "value", "metric_status",
        F.lit("whole_feed").alias("measurement_scope"))


def registry_state(operator_count: Column) -> Column:
    return F.when(operator_count > 0, "registered").otherwise("no-registry")


def handoff_crosstab(supply: DataFrame, status: DataFrame) -> DataFrame:
    """(registry_state, availability_status, n) over municipalities."""
    return (
        supply.join(status, "municipality")
        .groupBy(registry_state(F.col("operator_count")).alias("registry_state"),
                 "availability_status")
        .agg(F.count(F.lit(1)).alias("n")))


def handoff_memo(supply: DataFrame, status: DataFrame, metric_feeds: DataFrame) -> DataFrame:
    """One row per (municipality, checklist item), decided by its current state alone.

    ``metric_feeds``: feed_id of feeds with measured metrics. Whether a place has metrics is
    separate from its registry and access states.
    """
    measured = feed_bridge(status).join(
        metric_feeds.select("feed_id").distinct(), "feed_id", "left_semi"
    ).select("municipality").distinct().withColumn("has_metrics", F.lit(True))
    base = (
        supply.select("municipality", "operator_count").join(status, "municipality")
        .join(measured, "municipality", "left"))
    registered = F.col("operator_count") > 0
    confirmed = F.col("availability_status") == "public_download_confirmed"
    has = F.coalesce("has_metrics", F.lit(False))
    state = F.concat_ws(
        "/", registry_state(F.col("operator_count")),
        F.when(confirmed, "gtfs-confirmed").otherwise("gtfs-unconfirmed"))
    items = F.array(
        F.lit("recheck_number_expiry_and_area_in_source"),
        F.when(registered, "check_expiry_and_overlap_do_not_sum")
        .otherwise("zero_is_not_absence_collect_more_sources"),
        F.when(confirmed, "recheck_official_distribution_and_scope")
        .otherwise("recheck_catalogue_and_operators_no_absence_claim"),
        F.when(has, "check_week_date_and_whole_feed_unit")
        .otherwise("accept_feed_before_filling_values"))
    return base.select(
        "municipality", registry_state(F.col("operator_count")).alias("registry_state"),
        "availability_status", has.alias("has_metrics"), state.alias("handoff_state"),
        F.posexplode(items).alias("item_no", "item"))
