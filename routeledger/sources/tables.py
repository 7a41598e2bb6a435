"""CSV, JSON and page-text inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window


def read_csv_table(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True
) -> DataFrame:
    """CSV with a header as text columns; an empty cell is '', never NULL.

    With ``multi_line`` a cell may hold line ends, and a file is read by one task. Files known to
    have none are read with False: large ones are then split among tasks.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = (
        spark.read.schema(schema).option("header", True).option("quote", '"')
        .option("escape", '"').option("multiLine", multi_line).option("enforceSchema", False)
        .option("mode", "FAILFAST").csv(path)
    )
    return df.na.fill("")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, record): the records of quoted CSV files, in as many tasks as the files have splits.

    A line starts a record where the quotes before it in its file are even in number. Each split counts its own
    quotes; only the small table of splits is ordered per file, and tells each split in which state it begins
    and which record its first lines go on with. Records of one line stay where they are; the lines of longer
    ones, and the last line of a split, are brought together.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path, lineSep="\n").select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("at"))
    odd = (F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    lines = lines.withColumn("odd", odd)
    split = ["file", "block"]
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*split).orderBy("at")
    until = inside.rowsBetween(Window.unboundedPreceding, -1)
    states = lines.groupBy(*split).agg((F.sum("odd") % 2).alias("odd")).select(
        *split, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("state"))
    parity = (F.col("state") + F.coalesce(F.sum("odd").over(until), F.lit(0))) % 2
    marked = lines.join(states, split).withColumn("start", parity == 0)
    own = F.max(F.when(F.col("start"), F.col("at"))).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("own", own).withColumn("alone", F.col("start") & F.coalesce(
        F.lead("start").over(inside), F.lit(False)))
    heads = marked.groupBy(*split).agg(F.max(F.when(F.col("start"), F.struct("block", "at"))).alias("last")).select(
        *split, F.max("last").over(before).alias("carried"))
    rest = marked.where("not alone").join(heads, split).select(
        "file", "block", "at", "value",
        F.when(F.col("own").isNotNull(), F.struct("block", F.col("own").alias("at"))).otherwise(F.col("carried")).alias("of"))
    line = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    joined = rest.groupBy("file", "of").agg(
        F.array_join(F.transform(line, lambda x: x["value"]), "\n").alias("record"))
    return marked.where("alone").select("file", "block", "at", F.col("value").alias("record")).unionByName(
        joined.select("file", "of.block", "of.at", "record"))


def read_quoted_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """What ``read_csv_table`` reads, cells with line ends included, with large files split among tasks.

    A row of more or fewer cells, and a header other than ``columns``, end the job.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    records = csv_records(spark, path)
    first = records.groupBy("file").agg(F.min(F.struct("block", "at")).alias("first")).select(
        "file", "first.block", "first.at", F.lit(True).alias("header"))
    text = F.regexp_replace("record", "\r$", "")
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    cells = F.from_csv(F.when(F.col("header"), F.regexp_replace(text, "^\ufeff", "")).otherwise(text), schema, options)
    rows = records.join(first, ["file", "block", "at"], "left").where(text != "").select("header", cells.alias("c"))
    wanted = F.struct(*[F.lit(c).alias(c) for c in columns])
    checked = F.when(F.col("header") & ~F.col("c").eqNullSafe(wanted), F.raise_error(F.lit("the header is not the expected one")).cast("boolean")).otherwise(
        F.col("header").isNull())
    return rows.where(checked).select(*[F.coalesce(F.col("c")[c], F.lit("")).alias(c) for c in columns])


def read_json_records(
    spark: SparkSession, path: str, schema: str, lines: bool = False
) -> DataFrame:
    """A JSON document holding one record or an array of records; with ``lines``, a record a line,
    which lets large files be split among tasks."""
    return spark.read.schema(schema).option("multiLine", not lines).option("mode", "FAILFAST").json(path)


def metric_records(records: DataFrame) -> DataFrame:
    """Nested feed metric records -> the canonical long table.

    ``metrics`` and ``scheduled_trip_count_by_date`` are maps to (value, metric_status, reason).
    """
    triple = ["v.value", "v.metric_status", "v.reason"]
    structure = records.select("feed_id", F.explode("metrics").alias("metric_id", "v")).select(
        "feed_id", "metric_id", F.lit(None).cast("date").alias("service_date"), *triple)
    daily = records.select(
        "feed_id", F.explode("scheduled_trip_count_by_date").alias("d", "v")
    ).select("feed_id", F.lit("scheduled_trip_count_by_date").alias("metric_id"),
             F.to_date("d").alias("service_date"), *triple)
    return structure.unionByName(daily)


METRIC_RECORD_SCHEMA = (
    "feed_id string, metric_version string, comparison_week_start string, "
    "comparison_week_end string, "
    "metrics map<string, struct<value:bigint, metric_status:string, reason:string>>, "
    "scheduled_trip_count_by_date "
    "map<string, struct<value:bigint, metric_status:string, reason:string>>"
)


def read_page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, page_no, text) from files named <document>_p<page>.txt."""
    name = F.col("_metadata.file_name")
    return spark.read.text(path, wholetext=True).select(
        F.regexp_extract(name, r"^(.+)_p[0-9]+\.txt$", 1).alias("doc_id"),
        F.regexp_extract(name, r"_p([0-9]+)\.txt$", 1).cast("int").alias("page_no"),
        F.col("value").alias("text"))
