import numpy as np
import pytest
from pyspark.sql import functions as F

from routeledger.llm import neighbours as N, shared


def plain(vectors, k, every):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = x @ x[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_small_tables_are_exact(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, (rnd.standard_normal(8) * (1 + i % 5)).tolist()) for i in range(130)]
    rows += [(200 + i, rows[3][1]) for i in range(4)]  # ties
    got = found(N.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 7, 10))
    want = plain([(i, np.float32(v).tolist()) for i, v in rows], 7, 10)
    assert {q: [v for v, _ in a] for q, a in got.items()} == {q: [v for v, _ in a] for q, a in want.items()}
    for q in want:
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


@pytest.mark.parametrize("hot", [False, True])
def test_recall_beyond_the_sample(spark, monkeypatch, hot):
    """hot: a third of the rows in one direction, so that their cells are spread."""
    monkeypatch.setattr(N, "SAMPLE", 400)
    monkeypatch.setattr(N, "SHARD_ROWS", 1024)
    rnd = np.random.default_rng(2)
    x = rnd.standard_normal((3000, 32)) + 0.5 * rnd.standard_normal((10, 32))[rnd.integers(0, 10, 3000)]
    if hot:
        x[:1000] = x[0] + 1e-3 * rnd.standard_normal((1000, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(N.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    want = plain(rows, 20, 20)
    assert set(got) == set(want) and all(len(a) == 20 for a in got.values())
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_given_table(spark):
    table = shared.read(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got, want = found(N.search(table)), plain(rows, 20, 20)
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.9


@pytest.mark.parametrize("probes", [1, None])
def test_results_come_from_visited_cells_or_exact_scans(spark, monkeypatch, probes):
    """The sample's rows are no results by themselves; without enough probes all rows are scanned."""
    monkeypatch.setattr(N, "SAMPLE", 100)
    monkeypatch.setattr(N, "_wanted_probes", lambda *_: probes)
    rnd = np.random.default_rng(3)
    x = rnd.standard_normal((8, 32))[np.arange(800) % 8] + 0.5 * rnd.standard_normal((800, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = found(N.search(table, 5, 10)), plain(rows, 5, 10)
    assert set(got) == set(want) and all(len(a) == 5 for a in got.values())
    sample = [r.vec_id for r in table.select("vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(100).collect()]
    hashing = N.Hashing(32, np.sqrt((x * x).sum(axis=1)).max())
    seen = (hashing.cells(x)[:, None, :] == hashing.probes(x, [()])).any(axis=0)  # query by row
    by_cells = 0
    for q, near in got.items():
        score = x @ x[q]
        bound = np.sort([score[i] for i in sample if i != q])[-5]
        own = [i for i in np.argsort(-score) if i != q and seen[q, i] and score[i] >= bound][:5]
        by_cells += probes is not None and len(own) == 5
        assert [v for v, _ in near] == (own if probes and len(own) == 5 else [v for v, _ in want[q]])
    assert by_cells >= 10 or probes is None


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0])]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, cell int, x int")
    assert found(N.search(table)) == {0: [(8, 1.0), (20, 0.5)], 20: [(0, 0.5), (8, 0.5)]}
    assert N.search(table.limit(0)).count() == 0 and N.search(table.where("vec_id = 0")).count() == 0


def test_perturbations_come_in_order_and_never_both_ways():
    sets = N.perturbations(5, 300)
    assert sets[0] == () and len(set(sets)) == len(sets) == 3**5
    assert all(9 - r not in s for s in sets for r in s)
