import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from routeledger.llm import lexical

from .conftest import FOLD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(FOLD) for t in TERM.findall(text or "")]


def plain(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    sizes = [sum(b.values()) for _, b in bags]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for i, text in {x for x in items if x[0] is not None}:
        weights = {t: c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t, c in Counter(terms(text)).items() if df[t]}
        scores = []
        for (d, bag), size in zip(bags, sizes):
            if size:
                m = 75 + 25 * size * n // length
                scores.append((-sum(w * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t, w in weights.items()), d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(x for x in scores if x[0] < 0)[:k], 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def items_of(docs, rows):
    return docs(rows).withColumnRenamed("doc_id", "item_id")


def test_search_equals_brute_force(docs, random_texts):
    rnd = random.Random(5)
    texts = random_texts + [(1000 + i, " ".join(rnd.choices([f"T{j}" for j in range(60)], k=rnd.randint(1, 9)))) for i in range(400)]
    items = [(i, " ".join(rnd.choices([f"t{j}" for j in range(70)], k=rnd.choice([1, 2, 5, 40])))) for i in range(30)]
    items += [(3, "t1 t1 T2"), (3, "t1 t1 T2"), (77, "nothing here"), (78, ""), (79, None), (None, "t1")]
    assert result(lexical.ranked(docs(texts), items_of(docs, items))) == plain(texts, items)
    assert result(lexical.ranked(docs(texts), items_of(docs, items), 3)) == plain(texts, items, 3)


def test_small_blocks_and_slices_change_nothing(docs, random_texts, monkeypatch):
    items = [(i, t) for i, t in random_texts[:25]]
    for name, value in (("POSTINGS", 150), ("DOCUMENTS", 7), ("SLICE", 200), ("MASK_BYTES", 64)):
        monkeypatch.setattr(lexical, name, value)
    found = lexical.Searcher(docs(random_texts), items_of(docs, items))
    assert found.slices > 3
    got = sorted((r["item"].id, r["rank"], r.doc_id, r.score) for r in found.top(20).collect())
    assert got == plain(random_texts, items)


def test_odd_rows(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "A b w3 w3"), (2, "中文"), (3, "one"), (None, "a"), (4, None)]
    assert result(lexical.ranked(odd, items_of(docs, items))) == plain(rows, items)
    assert lexical.ranked(docs([]), items_of(docs, items)).count() == 0
    assert lexical.ranked(odd, items_of(docs, [])).count() == 0


def test_a_term_in_all_documents_scores_nothing(docs):
    texts = [(i, "all") for i in range(1200)]
    assert result(lexical.ranked(docs(texts), items_of(docs, [(1, "all")]))) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6), st.integers(0, 50))
def test_a_block_gives_all_of_the_best(seed, k, share):
    """Whatever the floor, no document that reaches it and is among the k best is left out."""
    rnd = np.random.default_rng(seed)
    size, vocabulary = int(rnd.integers(1, 40)), int(rnd.integers(1, 40))
    has = rnd.random((size, vocabulary)) < rnd.random()
    tf = rnd.integers(1, 4, has.shape)
    row, term = np.nonzero(has)
    m = rnd.integers(80, 300, size)
    block = lexical.Block(np.arange(size), m, has.sum(axis=1), term.astype(np.int64), tf[row, term])
    weight = rnd.integers(0, 5, vocabulary)
    scores = (has * weight * ((10**9 * tf) // (1000 * tf + 12 * m[:, None]))).sum(axis=1)
    floor = int(scores.max() * share // 50)
    rows, got = lexical.best_in_block(block, np.arange(vocabulary), weight, k, floor)
    assert (scores[rows] == got).all() and len(set(rows)) == len(rows)
    least = max(floor, 1, int(np.sort(scores)[-k]) if size >= k else 0)
    assert set(np.flatnonzero(scores >= least)) <= set(rows)
