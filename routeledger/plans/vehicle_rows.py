"""Vehicle rows of the registry from the cells of its vehicle tables.

``cells`` is the output of the grid operator with a document key: (doc, row_no, col_no, text). The
header row names the vehicle types from column 2 on; every later row with a name in column 1 is an
office, or the printed total of the document. Offices are numbered by their order and never
matched by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions import text as T
from routeledger.operators import layout, ordered
from routeledger.session import shared_folder

INNER_MARK = "軽"
PORTION = 10_000


def read_cells(
    cells: DataFrame, doc: str, documents: DataFrame, offices: DataFrame | None = None,
    header_row: int = 1, parts: int | None = None,
) -> DataFrame:
    """One row per office row and headed column, cells that are empty included.

    (doc, row_no, office_seq, office_name, office_location, vehicle_type, vehicle_type_label,
    count, count_kei). The printed total row has no ``office_seq``. ``documents``: doc and
    transport_type; ``offices``: doc, office_seq, name and location as printed above the table.

    The cells of one row, and the headings of one document, meet as arrays, so that no row is sorted once per
    column. ``parts``: how many tasks the rows are dealt to, if not as many as any shuffle has.
    """
    head = cells.where((F.col("row_no") == header_row) & (F.col("col_no") >= 2)).join(
        documents.select(doc, "transport_type"), doc
    ).select(
        doc, "col_no", T.unwrap_cell(F.col("text")).alias("vehicle_type_label"),
        T.vehicle_type(F.col("text"), F.col("transport_type")).alias("vehicle_type"),
        F.col("text").contains(INNER_MARK).alias("has_inner"))

    def dealt(df: DataFrame, *by: str) -> DataFrame:
        return df.repartition(parts, *by) if parts else df

    columns = dealt(
        cells.where((F.col("row_no") > header_row) & (F.col("col_no") >= 2)), doc, "row_no"
    ).groupBy(doc, "row_no").agg(F.collect_list(F.struct("col_no", "text")).alias("cells"))
    first_line = F.get(F.filter(F.split("text", "\n"), lambda x: T.strip(x) != ""), F.lit(0))
    rows = cells.where((F.col("row_no") > header_row) & (F.col("col_no") == 1)).where(
        first_line.isNotNull()).select(
        doc, "row_no", F.col("text").alias("office"),
        (T.remove_blanks(first_line) == V.TOTAL_LABEL).alias("is_total"))
    # the headings of a document go once to each portion of its offices, so that a long table is no single task
    portion = F.call_function("div", F.coalesce("office_seq", F.lit(0)), F.lit(PORTION))
    last = rows.where(~F.col("is_total")).groupBy(doc).agg(
        F.call_function("div", F.count(F.lit(1)), F.lit(PORTION)).alias("last"))
    heads = head.groupBy(doc).agg(F.collect_list(F.struct(
        "col_no", "vehicle_type_label", "vehicle_type", "has_inner")).alias("heads")
    ).join(last.hint("merge"), doc, "left").withColumn(
        "portion", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("last", F.lit(0)))))
    named = ordered.numbered(rows.where(~F.col("is_total")), [doc], "row_no", "office_seq")
    if offices is not None:
        named = named.join(offices.select(
            doc, "office_seq", F.col("name").alias("_name"), F.col("location").alias("_loc")),
            [doc, "office_seq"], "left")
        split = layout.cell_split(
            F.col("office"), F.coalesce("_name", F.lit("")), F.coalesce("_loc", F.lit("")))
    else:
        split = layout.cell_split(F.col("office"))
    named = named.select(doc, "row_no", "office_seq", split.alias("s")).select(
        doc, "row_no", "office_seq", F.col("s.name").alias("office_name"),
        F.col("s.location").alias("office_location"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (
        ("office_seq", "bigint"), ("office_name", "string"), ("office_location", "string"))]
    every = named.unionByName(rows.where("is_total").select(doc, "row_no", *nothing))
    value = T.cell_value(F.col("cell.text"), F.col("has_inner"))
    own = [doc, "row_no", "office_seq", "office_name", "office_location"]
    return (
        dealt(every.join(columns.hint("merge"), [doc, "row_no"], "left").withColumn("portion", portion), doc, "portion")
        .join(dealt(heads, doc, "portion").hint("merge"), [doc, "portion"])
        .select(*own, "cells", F.explode("heads").alias("head")).select(*own, "head.*", "cells")
        .withColumn("cell", F.explode_outer(F.filter("cells", lambda c: c["col_no"] == F.col("col_no"))))
        .withColumn("v", value)
        .select(doc, "row_no", "office_seq", "office_name", "office_location", "vehicle_type",
                "vehicle_type_label", F.col("v.total").cast("bigint").alias("count"),
                F.col("v.inner").cast("bigint").alias("count_kei")))


def vehicle_rows(read: DataFrame, doc: str) -> DataFrame:
    """The published rows: offices only, known types only, without zero rows."""
    some = (F.col("count") > 0) | (F.coalesce("count_kei", F.lit(0)) > 0)
    return read.where(
        F.col("office_seq").isNotNull() & F.col("vehicle_type").isNotNull() & some).drop("row_no")


def vehicle_problems(read: DataFrame, doc: str) -> DataFrame:
    """(doc, office_seq, reason): values under an empty heading, and totals that do not add up.

    An office's types are compared with its own total column; the printed total row of a document
    with the offices' totals.
    """
    total = F.col("vehicle_type") == V.TOTAL_LABEL
    kei = F.coalesce("count_kei", F.lit(0))
    known = F.col("vehicle_type").isNotNull()

    def summed(cond, cells=(F.col("count"), kei)):
        return [F.coalesce(F.sum(F.when(cond, c)), F.lit(0)) for c in cells]

    per_row = read.groupBy(doc, "row_no", "office_seq").agg(
        F.count_if(~known & ((F.col("count") > 0) | (kei > 0))).alias("stray"),
        F.count_if(total).alias("totals"), F.first("office_location").alias("location"),
        F.struct(*summed(known & ~total)).alias("detail"), F.struct(*summed(total)).alias("total"))
    office = F.col("office_seq").isNotNull()
    checks = {
        "value_without_heading": F.col("stray") > 0,
        "no_single_total_column": office & (F.col("totals") != 1),
        "office_without_location": office & (F.coalesce("location", F.lit("")) == ""),
        "office_total_mismatch": office & (F.col("totals") == 1) & (F.col("detail") != F.col("total")),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in checks.items()]))
    # both results come from the sums of rows, which are found once
    path = shared_folder(read.sparkSession, "vehicle_sums")
    per_row.select(doc, "office_seq", "totals", F.col("total.col1").alias("all"), F.col("total.col2").alias("inner"),
                   broken.alias("broken")).write.parquet(path)
    sums = read.sparkSession.read.parquet(path)
    rows = sums.select(doc, "office_seq", F.explode("broken").alias("reason"))
    both = (F.col("all"), F.col("inner"))
    whole = sums.where("totals > 0").groupBy(doc).agg(
        F.struct(*summed(office, both)).alias("offices"), F.struct(*summed(~office, both)).alias("printed"),
        F.sum(F.when(~office, F.col("totals")).otherwise(0)).alias("n")
    ).where((F.col("n") > 0) & (F.col("offices") != F.col("printed"))).select(
        doc, F.lit(None).cast("bigint").alias("office_seq"),
        F.lit("printed_total_mismatch").alias("reason"))
    return rows.unionByName(whole)
