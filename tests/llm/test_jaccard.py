import random

import pytest

from routeledger.llm import jaccard_join as J
from routeledger.llm.components import components

from .conftest import WORD


def plain(rows):
    """(doc_id, class_id, n_links) by comparing all pairs."""
    sets = []
    for i, text in rows:
        w = WORD.findall(text or "")
        sets.append((i, {tuple(w[a:a + 5]) for a in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()))
    root = list(range(len(sets)))
    links = [0] * len(sets)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[x] += 1
                links[y] += 1
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(least.get(find(x), i), i)
    return sorted((i, least[find(x)], links[x]) for x, (i, _) in enumerate(sets))


def result(df):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in df.collect())


@pytest.fixture(scope="module")
def near_copies():
    """Texts with groups of copies of from two to many, a passage that most share, and chains of likeness."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randint(0, 5000)}"
    passage = [word() for _ in range(40)]
    rows, n = [], 0
    for size in (1, 1, 1, 2, 3, 9, 120):
        base = [word() for _ in range(150)] + passage
        for _ in range(size):
            copy = list(base)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy)))
            n += 1
    chain = [word() for _ in range(200)]
    for _ in range(8):
        for _ in range(3):
            chain[rnd.randrange(200)] = word()
        rows.append((n, " ".join(chain)))
        n += 1
    rows += [(n + k, " ".join([word() for _ in range(30)] + passage)) for k in range(60)]
    return rows + [(900, rows[0][1]), (901, rows[0][1]), (902, rows[20][1])]


def test_join_equals_all_pairs(docs, near_copies):
    assert result(J.similar(docs(near_copies))) == plain(near_copies)


def test_split_nodes_and_blocks_change_nothing(docs, near_copies, monkeypatch):
    monkeypatch.setattr(J, "SMALL", 12)
    monkeypatch.setattr(J, "BLOCK", 25)
    assert result(J.similar(docs(near_copies))) == plain(near_copies)


def test_one_of_each(docs, near_copies):
    table = docs(near_copies)
    kept = J.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in plain(near_copies)})


def test_odd_rows(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]
    got, want = result(J.similar(odd)), plain(rows)
    assert got == want
    assert [r for r in got if r[0] in (1, 2, 3)] == [(1, 1, 0), (2, 2, 0), (3, 3, 0)]
    assert [r for r in got if r[0] in (5, 6)] == [(5, 5, 2), (5, 5, 2), (6, 5, 2)]
    assert result(J.similar(docs([]))) == []


def test_roots_reach_the_target():
    assert J.roots(0.999) > J.roots(0.9) > 1 and J.roots(0.999999) <= J.T


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (200, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
