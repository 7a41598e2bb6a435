import hashlib

from routeledger.llm import substring

from .conftest import WORD


def plain(rows, length):
    """What is kept of each (doc_id, text), in order of doc_id."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for a in range(len(words) - length + 1):
            key = tuple(words[a:a + length])
            if key in seen:
                gone[a:a + length] = [True] * length
            seen.add(key)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def test_removal_equals_brute_force(docs, random_texts):
    for length, seed in ((20, 6), (6, 3)):
        want = plain(random_texts, length)
        got = {r.doc_id: r for r in substring.removal(docs(random_texts), length, seed).collect()}
        assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == {
            i: w[:3] for i, w in want.items()}


def test_texts_lose_their_repeats_and_keep_their_columns(docs, random_texts):
    table = docs(random_texts)
    out = substring.without_repeats(table)
    assert out.columns == table.columns and out.count() == len(random_texts)
    want = plain(random_texts, 20)
    before = dict(random_texts)
    for r in out.collect():
        assert " ".join(WORD.findall(r.text)) == want[r.doc_id][3]
        assert r.n_chars == len(r.text) and r.source == "src0" and r.ver == "v"
        if not want[r.doc_id][1]:
            assert r.text == before[r.doc_id]


def test_spans_are_the_maximal_repeats(docs):
    a = " ".join(f"a{i}" for i in range(30))
    b = " ".join(f"b{i}" for i in range(5))
    spans = substring.spans(docs([(1, a), (2, f"{b} {a} {b}"), (3, a + " " + a)])).collect()
    assert sorted((r.doc_id, r.first_word, r.n_words) for r in spans) == [(2, 5, 30), (3, 0, 60)]


def test_odd_rows(odd, docs):
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring.removal(odd).collect())
    assert got == [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (5, 3, 0), (5, 3, 0), (6, 3, 0),
                   (7, 30_000, 29_300), (8, 5, 0), (9, 2, 0), (9, 2, 0)]
    assert substring.without_repeats(odd).count() == 12
    assert substring.removal(docs([])).count() == 0 and substring.without_repeats(docs([])).count() == 0
    twice = " ".join(f"q{i}" for i in range(25))
    rows = substring.removal(docs([(1, twice), (1, twice)])).collect()
    assert [(r.n_words, r.n_removed) for r in rows] == [(25, 0), (25, 0)]
