import numpy as np
import pytest
from pyspark.sql import functions as F

from routeledger.llm import shared, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    docs, labels = shared.read(spark, SF, "documents"), shared.read(spark, SF, "labels")
    got = toxicity.grade(docs, labels.where("doc_id % 4 != 0")).join(
        labels.where("doc_id % 4 = 0").select("doc_id", F.col("toxic").alias("known")), "doc_id")
    caught, toxic, false, clean = got.selectExpr(
        "count_if(toxic and known = 1)", "count_if(known = 1)", "count_if(toxic and known = 0)", "count_if(known = 0)").first()
    assert caught >= 0.85 * toxic and false <= 0.01 * clean


def test_severity_rises_with_the_features(spark):
    rows, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        n = 1 + i % 8 if bad else 0
        rows.append((i, f"plain words {i % 7} here " + " ".join(f"awful{k}" for k in range(n))))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    new = spark.createDataFrame([(1, "plain words"), (2, "awful0"), (3, "awful0 awful1 awful2"),
                                 (4, " ".join(f"awful{k}" for k in range(8)))], "doc_id long, text string")
    model = toxicity.fit(docs, table)
    assert (np.diff(model.cuts) > 0).all()
    got = {r.doc_id: r for r in shared.texts(new).mapInArrow(
        toxicity._score_rows(model), "doc_id long, toxic boolean, p_toxic double, grade int, severity double").collect()}
    assert not got[1].toxic and got[2].toxic and got[4].grade == 3
    assert got[1].severity < got[2].severity < got[3].severity < got[4].severity


def test_ordinal_gradient_reaches_an_optimum():
    """The fitted likelihood is no worse after any small step of one parameter."""
    rnd = np.random.default_rng(0)
    x = [np.flatnonzero(rnd.random(6) < 0.4) for _ in range(400)]
    score = np.array([f.sum() * 0.5 for f in x])
    grade = np.digitize(score + rnd.logistic(size=400), [1, 3, 5])
    w, cuts = toxicity._ordinal(x, grade, 6, 1500)

    def loss(w, cuts):
        s = np.array([w[f].sum() for f in x])
        f = np.hstack([np.zeros((400, 1)), 1 / (1 + np.exp(s[:, None] - cuts[None, :])), np.ones((400, 1))])
        return -np.log(f[np.arange(400), grade + 1] - f[np.arange(400), grade]).mean() + 0.5e-4 * (w**2).sum()

    best = loss(w, cuts)
    for k in range(6):
        for step in (-0.05, 0.05):
            moved = w.copy()
            moved[k] += step
            assert loss(moved, cuts) >= best - 1e-4


def test_odd_rows(spark, odd, docs):
    labels = spark.createDataFrame(
        [(4, 1, 1), (4, 1, 1), (5, 0, 0), (None, 1, 1), (8, None, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.grade(odd, labels).count() == 11
    none = toxicity.grade(odd, labels.limit(0))
    assert none.where("toxic or grade > 0").count() == 0 and none.count() == 11
    assert toxicity.grade(docs([]), labels).count() == 0


@pytest.mark.parametrize("limit", [50])
def test_the_sample_is_bounded(spark, limit):
    docs, labels = shared.read(spark, SF, "documents"), shared.read(spark, SF, "labels")
    assert toxicity._sample(docs, labels, limit).count() <= limit
