import random

import numpy as np

from routeledger.llm import minhash
from routeledger.llm import words as W

from .conftest import FOLD, WORD


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[i:i + 2]) for i in range(max(1, len(w) - 1))} if w else set()


def plain(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both, either = len(sets[a][1] & sets[b][1]), len(sets[a][1] | sets[b][1])
            if either and 100 * both >= 80 * either and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    least = {}
    for (i, _), g in zip(sets, group):
        least[g] = min(i, least.get(g, i))
    return sorted((i, len(s), least[g], i == least[g]) for (i, s), g in zip(sets, group))


def result(df):
    return sorted(tuple(r) for r in df.drop("ver").collect())


def varied(seed, n=400, base=30):
    """A group spread around the threshold: a text and copies with a few words replaced, copies of copies too."""
    rnd = random.Random(seed)
    texts = [[f"v{i}" for i in range(base)]]
    for _ in range(n):
        own = list(rnd.choice(texts[-40:]))
        for _ in range(rnd.randint(0, 2)):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(40)}"
        texts.append(own)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_groups_equal_brute_force(docs, random_texts):
    rows = random_texts + [(500 + i, t.upper()) for i, t in random_texts[:5]] + [(700, "one"), (701, "ONE"), (702, "two")]
    assert result(minhash.near_groups(docs(rows))) == plain(rows)


def test_varied_copies_in_small_blocks(docs, monkeypatch):
    """Most links of a varied group are found by the second pass, over many cells of small blocks."""
    rows = varied(1) + [(5000 + i, t) for i, t in varied(2, 60, 12)]
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "LARGE", 8)
    assert result(minhash.near_groups(docs(rows))) == plain(rows)


def test_odd_rows(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(minhash.near_groups(odd)) == plain(rows)
    assert minhash.near_groups(docs([])).count() == 0


def test_sketches_fill_and_estimate():
    """Every coordinate is filled, also of sets smaller than the bins, and agreement is the similarity."""
    rnd = np.random.default_rng(1)
    for size in (1, 2, 9, 150, 5000):
        shared = max(1, size * 8 // 10)
        errors = []
        for _ in range(40):
            x = W.mix(rnd.integers(1, 1 << 62, 2 * size).astype(np.uint64))
            a, b = x[:size], np.concatenate([x[:shared], x[size:2 * size - shared]])
            s = minhash.sketches(np.concatenate([a, b]), np.array([0, size, 2 * size]))
            errors.append((s[0] == s[1]).mean() - shared / (2 * size - shared))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06
    assert (minhash.sketches(np.arange(3, dtype=np.uint64), np.array([0, 1, 3])).shape == (2, minhash.T))


def test_recall_at_the_threshold():
    """Of 4,000 pairs at exactly 0.8, all share a bucket and none is ruled out by its sketch."""
    rnd = np.random.default_rng(2)
    for size in (9, 90):
        lost = 0
        for _ in range(20):
            x = W.mix(rnd.integers(1, 1 << 62, 100 * (size + size // 9)).astype(np.uint64)).reshape(100, -1)
            a, b = x[:, :size], np.concatenate([x[:, :size - size // 9], x[:, size:]], axis=1)
            s = minhash.sketches(np.concatenate([a, b]).ravel(), np.arange(0, 200 * size + 1, size))
            same = s[:100] == s[100:]
            band = same.reshape(100, minhash.BANDS, minhash.ROWS).all(axis=2).any(axis=1)
            lost += (~band | (same.sum(axis=1) < minhash.LIKELY)).sum()
        assert lost == 0
