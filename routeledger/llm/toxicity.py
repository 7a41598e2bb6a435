"""Severity grades of toxic texts by cumulative-link ordinal regression on sparse text features.

Features: which words, and which beginnings of five bytes of longer words, a text holds. The model is fitted on
at most SAMPLE labelled rows, chosen by a hash of their ids. From these, features that tell toxic from other
rows (z score of their log odds) are kept, and every labelled row gets its grade: 0 not toxic, 1 to 3 toxic
with up to two, up to five or more strongly toxic features. P(grade <= k) = 1 / (1 + exp(-(cut_k - w x))): the
weights w are shared by all cuts, and the cuts are ordered by construction. Every document is scored.

Defined results: null and empty texts have no features and get the sample's base severity; a document without
a label is scored like others; of repeated label rows the largest grade holds; labels without a text are not
used; without any toxic or any other label in the sample every document is graded 0; rows without an id
are left out; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger.llm import shared, words as W

#: labelled rows that the fit reads, and features that it keeps, at most
SAMPLE = 20_000
FEATURES = 4096
GRADES = 4
#: P(grade > 0) from which a text counts as toxic: missing one is worse than a second look
TOXIC = 0.3
_HEAD = 5
_EDGES = (3, 6)


def features(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """The features of a column's rows, each once a row: rows in order, and feature hashes."""
    row = words.row()
    long_words = np.flatnonzero(words.end - words.start > _HEAD)
    head = np.zeros(len(long_words), np.uint64)
    for j in range(_HEAD):
        head = W.mix(head + words.data[words.start[long_words] + j].astype(np.uint64) + np.uint64(j + 1))
    pairs = np.zeros(len(row) + len(head), [("row", np.int64), ("feature", np.uint64)])
    pairs["row"] = np.concatenate([row, row[long_words]])
    pairs["feature"] = np.concatenate([W.mix(words.hash + np.uint64(1)), head])
    order = np.lexsort((pairs["feature"], pairs["row"]))
    pairs = pairs[order]
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = pairs[1:] != pairs[:-1]
    return pairs["row"][fresh], pairs["feature"][fresh]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.portions(batches):
        row, feature = features(W.split(batch.column("text"), W.ALNUM, True))
        at = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"),
             pa.ListArray.from_arrays(pa.array(at), pa.array(feature.view(np.int64)))],
            ["doc_id", "toxic", "features"])


@dataclass
class Model:
    """Kept features in order with their weights, and the increasing cuts between grades."""

    feature: np.ndarray
    weight: np.ndarray
    cuts: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) by row and k."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -50, 50)))


def _sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, toxic, features) of at most `limit` labelled documents; the ids sent out are as many at most."""
    some = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    return shared.texts(docs).join(F.broadcast(some), "doc_id").dropDuplicates(["doc_id"]).mapInArrow(
        _feature_rows, "doc_id long, toxic int, features array<long>")


def _choose(sample: DataFrame, toxic: int, rest: int) -> tuple[np.ndarray, np.ndarray]:
    """The most telling features, and which of them are strongly toxic."""
    has = sample.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum((F.col("toxic") > 0).cast("double")).alias("t"), F.sum((F.col("toxic") <= 0).cast("double")).alias("r"))
    t, r = F.col("t") + 0.5, F.col("r") + 0.5
    odds = F.log(t / (toxic + 1.0 - t)) - F.log(r / (rest + 1.0 - r))
    z = odds / F.sqrt(1.0 / t + 1.0 / r)
    best = (
        has.where("t + r >= 3").withColumn("z", z).where(F.abs("z") >= 3)
        .orderBy(F.desc(F.abs("z")), "feature").limit(FEATURES).toPandas().sort_values("feature")
    )
    strong = (best["z"] > 0) & (best["t"] / toxic > 20 * (best["r"] + 0.5) / rest)
    return best["feature"].to_numpy(np.int64), strong.to_numpy(bool)


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Model:
    """The model from at most `limit` labelled rows; only their kept features reach the driver."""
    sample = shared.landed(_sample(docs, labels, limit), "toxicity-sample")
    size = sample.selectExpr("count_if(toxic > 0)", "count_if(toxic <= 0)").first()
    if not size[0] or not size[1]:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES - 1, 50.0))
    feature, strong = _choose(sample, size[0], size[1])
    rows = _kept_rows(sample, feature).orderBy("doc_id").toPandas()
    y, x = rows["toxic"].to_numpy() > 0, [np.searchsorted(feature, f) for f in rows["features"]]
    hits = np.array([strong[f].sum() for f in x])
    grade = np.where(y, 1 + (hits >= _EDGES[0]) + (hits >= _EDGES[1]), 0)
    weight, cuts = _ordinal(x, grade, len(feature))
    return Model(feature, weight, cuts)


def _kept_rows(sample: DataFrame, feature: np.ndarray) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            keep = np.isin(flat, feature)
            new = np.concatenate([[0], np.cumsum(keep)])[at - at[0]].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 pa.ListArray.from_arrays(pa.array(new), pa.array(flat[keep]))], batch.schema.names)
    return sample.mapInArrow(rows, sample.schema)


def _ordinal(x: list[np.ndarray], grade: np.ndarray, n: int, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of the largest penalised likelihood, by gradient steps with adaptive rates."""
    row = np.repeat(np.arange(len(x)), [len(f) for f in x])
    col = np.concatenate(x).astype(np.int64) if len(row) else np.zeros(0, np.int64)
    m, k = len(grade), GRADES - 1
    # cut_0 = a_0, cut_j = cut_(j-1) + exp(a_j): ordered whatever a is
    rate = np.clip([(grade <= j).mean() for j in range(k)], 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(np.log(rate / (1 - rate)) + 1e-3 * np.arange(k))
    p = np.concatenate([np.zeros(n), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, gaps = p[:n], np.exp(p[n + 1:])
        cuts = p[n] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(row, w[col], m)
        f = 1 / (1 + np.exp(np.clip(score[:, None] - cuts[None, :], -50, 50)))  # P(grade <= j)
        full = np.hstack([np.zeros((m, 1)), f, np.ones((m, 1))])
        at = np.arange(m)
        likely = np.maximum(full[at, grade + 1] - full[at, grade], 1e-12)
        slope = full * (1 - full)
        up, down = slope[at, grade + 1] / likely, slope[at, grade] / likely
        d_score = up - down  # of minus log likelihood
        d_cut = np.array([down[grade == j + 1].sum() - up[grade == j].sum() for j in range(k)])
        tail = np.cumsum(d_cut[::-1])[::-1]
        g = np.concatenate([np.bincount(col, d_score[row], n) / m + 1e-4 * w, [tail[0] / m], tail[1:] * gaps / m])
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        p = p - 0.1 * (1 - (step - 1) / steps) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return p[:n], p[n] + np.concatenate([[0], np.cumsum(np.exp(p[n + 1:]))])


def _score_rows(model: Model):
    known = model.feature.view(np.uint64)
    order = np.argsort(known)
    known, weight = known[order], model.weight[order]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            row, feature = features(W.split(batch.column("text"), W.ALNUM, True))
            score = np.zeros(len(batch))
            if len(known):
                place = np.minimum(np.searchsorted(known, feature), len(known) - 1)
                hit = known[place] == feature
                score = np.bincount(row[hit], weight[place[hit]], len(batch))
            above = model.above(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above[:, 0] >= TOXIC), pa.array(above[:, 0]),
                 pa.array((above >= 0.5).sum(axis=1).astype(np.int32)), pa.array(above.sum(axis=1))],
                ["doc_id", "toxic", "p_toxic", "grade", "severity"])
    return rows


def grade(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, toxic, p_toxic, grade (the median grade), severity (the expected grade)."""
    return shared.texts(docs).mapInArrow(
        _score_rows(fit(docs, labels, limit)),
        "doc_id long, toxic boolean, p_toxic double, grade int, severity double")
