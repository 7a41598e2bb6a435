"""Tables in one row group whose rows each become many are dealt to tasks before they grow."""

from pyspark.sql import functions as F

from routeledger.catalog import provenance, registry, rules
from routeledger.lenses import WEEK, Lens
from routeledger.operators import layout, ordered
from routeledger.plans import feed_facts, registry_text, vehicle_rows


def folder(spark, tmp_path, n):
    spark.range(n).select(
        F.col("id").alias("c_custkey"), F.format_string("Customer#%09d", "id").alias("c_name"),
        (F.col("id") % 25).cast("int").alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"),
    ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_scores_are_dealt_before_they_grow(spark, tmp_path):
    lens = Lens(spark, folder(spark, tmp_path, 120_000))
    got = provenance._scores(lens).groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("subject_id").alias("s")).collect()
    assert len(got) == 3 and sum(r.s for r in got) == 120_000 and max(r.s for r in got) < 45_000
    assert sum(r.n for r in got) == 120_000 * len(provenance._PAIRS)


def test_days_of_weeks_are_dealt_before_they_grow(spark, tmp_path):
    got = provenance.week_contract(spark, folder(spark, tmp_path, 120_000))
    assert got.count() == 120_000 and got.where("n_dates = 6").count() == 20_000
    # the aggregates follow the dealing by feed: no second exchange
    assert got._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 2


def test_small_tables_stay_as_they_are(spark, tmp_path):
    lens = Lens(spark, folder(spark, tmp_path, 1_000))
    assert lens.spread("customer", "c_custkey").rdd.getNumPartitions() == lens.table("customer").rdd.getNumPartitions()


def test_trips_are_dealt_by_lines(spark, tmp_path):
    n = 250_000
    spark.range(n).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 40).alias("l_suppkey"),
        (F.col("id") % 7).alias("l_partkey"), F.lit(6.0).alias("l_quantity"),
    ).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    lens = Lens(spark, str(tmp_path))
    for trips in (lens.frequencies(), lens.trips()):
        got = [r.n for r in trips.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(got) == 3 and sum(got) == n and max(got) < 100_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_are_dealt_before_their_fields_are_found(spark, tmp_path):
    lens = Lens(spark, folder(spark, tmp_path, 45_000))
    got = [r.n for r in registry._registry_pages(lens).groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert len(got) == 5 and sum(got) == 45_000 and max(got) < 12_000


def test_landed_pages_are_never_broadcast(spark):
    # alike texts compress to files far below the limit of a broadcast
    pages = spark.range(20_000).select(
        F.call_function("div", "id", F.lit(4)).alias("doc_id"), (F.col("id") % 4).alias("page_no"),
        F.repeat(F.lit("a line of a form\n"), 40).alias("text"))
    last = F.when(F.col("page_no") % 2 == 0, F.col("page_no"))
    for df in (ordered.running_max(pages, ["doc_id"], "page_no", last, "last"),
               ordered.numbered(pages, ["doc_id"], "page_no", "no")):
        assert "BroadcastExchange" not in plan(df) and df.count() == 20_000
    fields = registry_text.page_fields(pages, "no such mark")
    states = registry_text.page_states(fields)
    roster = spark.createDataFrame([("a line",)], "municipality string")
    kinds = pages.select("doc_id").distinct().withColumn("operator_type", F.lit("T"))
    out = plan(registry_text.registry_from_text(states, roster, kinds))
    # only names of the roster and their pieces may be broadcast
    assert [x for x in out.split("\n") if "BroadcastHashJoin" in x and "_needle" not in x and "_piece" not in x] == []


def test_page_problems_land_only_what_they_read(spark, tmp_path):
    got = registry.registry_page_problems(spark, folder(spark, tmp_path, 800))
    assert "org_name" not in got._jdf.queryExecution().analyzed().toString() and got.count() > 0


def test_vehicle_cells_meet_once_a_row_in_as_many_tasks_as_asked_for(spark, monkeypatch):
    n = 400
    row = F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_no"), F.lit(t).alias("text")) for c, t in ((1, "Office\nTown"), (2, "3"), (3, ""))]))
    heads = spark.createDataFrame([("V", -1, 2, "寝台車"), ("V", -1, 3, "合計")], "doc string, row_no bigint, col_no int, text string")
    cells = heads.unionByName(spark.range(n).select(
        F.lit("V").alias("doc"), F.col("id").alias("row_no"), row.alias("x")).select("doc", "row_no", "x.*"))
    documents = spark.createDataFrame([("V", "x")], "doc string, transport_type string")
    monkeypatch.setattr(vehicle_rows, "PORTION", 50)
    read = vehicle_rows.read_cells(cells, "doc", documents, header_row=-1, parts=16)
    assert {(r.doc, r.row_no, r.office_seq, r.vehicle_type, r["count"]) for r in read.collect()} == {
        ("V", i, i + 1, kind, value) for i in range(n) for kind, value in (("寝台車", 3), ("合計", 0))}
    # one document, yet no task has most of it
    assert read.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < n
    assert "REPARTITION_BY_NUM" in plan(read)


def test_missing_boxes_are_found_once(spark):
    words = spark.createDataFrame([(1, "a", 1.0, 5.0, 13.0, 17.0, 1)], (
        "page bigint, text string, x0 double, x1 double, top double, bottom double, word_idx bigint"))
    boxes = spark.createDataFrame(
        [(1, 1, 1, 0.0, 10.0, 0.0, 10.0), (1, 1, 2, 10.0, 20.0, 0.0, 10.0), (1, 1, 3, 20.0, 30.0, 0.0, 10.0),
         (1, 2, 3, 20.0, 30.0, 12.0, 20.0)],
        "page bigint, row_no int, col_no int, x0 double, x1 double, top double, bottom double")
    got = layout.recovered_cells(words, boxes)
    assert plan(got).count("LeftAnti") == 1
    assert {tuple(r) for r in got.collect()} == {(1, 2, 1, "a"), (1, 2, 2, "")}


def test_span_sides_meet_in_one_pass_over_the_rules(spark):
    edges = spark.createDataFrame(
        [(1, "v", x, 0.0) for x in (0.0, 10.0, 20.0, 21.5, 30.0)] + [(1, "h", 0.0, y) for y in (5.0, 0.0, 9.0)]
        + [(2, "v", x, 0.0) for x in (0.0, 10.0)] + [(2, "h", 0.0, y) for y in (0.0, 5.0)] + [(3, "h", 0.0, 1.0)],
        "page bigint, orientation string, x0 double, top double")
    got = layout.grid_boxes(edges, columns=2)
    # one join for the rows' numbers, one for those of the columns, one of both
    assert plan(got).count("Join ") == 3
    # the two right-most columns; page 2 has only one
    assert {tuple(r) for r in got.collect()} == {
        (1, 1, 1, 10.0, 20.0, 0.0, 5.0), (1, 1, 2, 20.0, 30.0, 0.0, 5.0),
        (1, 2, 1, 10.0, 20.0, 5.0, 9.0), (1, 2, 2, 20.0, 30.0, 5.0, 9.0)}


def test_lines_of_feeds_are_narrow(spark):
    lens = Lens(spark, "/root/testdata/sf0.001")
    t = rules.rule_feeds(lens)
    for file in feed_facts.CHECKED:
        types = dict(feed_facts._READERS[file](getattr(t, file), WEEK).dtypes)
        assert types["kind"] == types["file"] == types["bits"] == "int"
        # numbers that only some files have are flags of the bits, or the days of a week in one column
        assert not {"inexact", "base0", "added0", "removed0"} & set(types)


def test_rule_tables_are_read_once(spark):
    t = rules.rule_feeds(Lens(spark, "/root/testdata/sf0.001"))
    for file in feed_facts.CHECKED:
        assert plan(getattr(t, file)).count("FileScan") == 1


def test_windows_are_dealt_by_numbers(spark):
    lens = Lens(spark, "/root/testdata/sf0.001")
    for short in (None, "F1"):
        got = lens.frequencies(short)
        assert "hashpartitioning(row_idx" in plan(got) and "hashpartitioning(trip_id" not in plan(got)
        ids = got.where("feed_id = 'F1'").select(F.size(F.split("trip_id", "-")).alias("n")).distinct().collect()
        assert [r.n for r in ids] == [3 if short is None else 2]


def test_missing_cells_follow_the_dealing_of_pages(spark, tmp_path):
    """Lines and words of a page are dealt once; rows, headers and missing boxes meet without another exchange."""
    spark.range(600_000).select(
        F.call_function("div", F.col("id"), F.lit(4)).alias("l_orderkey"), (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 500).alias("l_partkey"), (F.col("id") % 9).alias("l_suppkey"), F.lit(7.0).alias("l_extendedprice"),
        F.lit("A").alias("l_returnflag")).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = registry.grid_recovered(spark, str(tmp_path))
    text = plan(got)
    assert text.count("REPARTITION_BY_NUM") == 4 and "ENSURE_REQUIREMENTS" not in text
    # six or seven columns per row, of which a quarter is missing
    assert abs(got.count() - 600_000 * 6.8 / 4) < 600_000 * 0.05
