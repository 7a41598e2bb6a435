import pytest
from pyspark.sql import functions as F

from routeledger.llm import language, shared

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def table(spark):
    return shared.read(spark, SF, "documents")


def test_held_out_languages_are_found(table):
    """A quarter of the rows declare nothing; their languages are found from the rest."""
    hidden = table.withColumn("lang", F.when(F.col("doc_id") % 4 != 0, F.col("lang")))
    got = language.of_documents(hidden).where("id % 4 = 0").join(table, F.col("id") == F.col("doc_id"))
    right, all_rows, kept = got.selectExpr("count_if(language = lang)", "count(*)", "count_if(accepted)").first()
    assert right >= 0.97 * all_rows and kept >= 0.99 * all_rows


def test_evidence_decides_where_the_text_does_not(spark):
    """Texts without evidence of their own go by host and declaration."""
    rows = [(i, "the and of that", "en", "a") for i in range(40)] + [(i, "und der die das", "de", "b") for i in range(40, 80)]
    rows += [(90, "xx", None, "a"), (91, "xx", None, "b"), (92, "yy", "de", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.id: r for r in language.of_documents(docs).collect()}
    assert [got[i].language for i in (90, 91, 92)] == ["en", "de", "de"]


def test_rare_languages_are_told(spark, monkeypatch):
    """A language of one row in 5,000 has a model, scored in a block of its own."""
    rare = "საქართველოს მთავარი ქალაქი თბილისი მდებარეობს მდინარე მტკვრის ნაპირას"
    rows = [(i, "the and of that which was", "en", "a") if i % 2 else (i, "und der die das nicht war", "de", "b")
            for i in range(4999)]
    rows += [(5000, rare, "ka", "a"), (5001, "ქალაქი მდებარეობს მთავარი მდინარე თბილისი", None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language._learned(language._rows(docs, "doc_id", F.col("text"), F.col("lang"), F.col("source")))[1]
    whole = model.block(0)
    monkeypatch.setattr(language, "BLOCK", 2)
    assert (model.block(2) == whole[2:]).all() and len(whole) == 4
    got = {r.id: r for r in language.of_documents(docs).where("id >= 4997").collect()}
    assert [(got[i].language, got[i].accepted) for i in (4997, 4998, 5000, 5001)] == [
        ("en", True), ("de", True), ("ka", True), ("ka", True)]


def test_pages_use_markup_and_address(spark):
    pages = shared.read(spark, SF, "pages")
    want = F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    got = language.of_pages(pages).join(pages, F.col("id") == F.col("page_id"))
    right, n = got.select(F.count_if(F.col("language") == want), F.count("*")).first()
    assert right >= 0.95 * n


def test_odd_rows(odd, docs):
    got = {(r.id, r.language == "und", r.accepted) for r in language.of_documents(odd).collect()}
    assert {(1, True, False), (2, True, False), (3, True, False)} <= got
    assert language.of_documents(odd).count() == 11
    assert language.of_documents(docs([])).count() == 0 and language.accepted(docs([])).count() == 0
    kept = language.accepted(odd)
    assert kept.columns == odd.columns and kept.where("doc_id in (1, 2, 3)").count() == 0
    nothing = odd.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string"))
    assert language.of_documents(nothing).where("accepted").count() == 0


def test_gibberish_is_rejected(spark, table):
    import random
    rnd = random.Random(1)
    noise = "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(400))
    more = spark.createDataFrame([(10**6, noise, None, None, 400)], table.schema)
    got = language.of_documents(table.unionByName(more)).where("id = 1000000").first()
    assert got.language == "und" and not got.accepted
