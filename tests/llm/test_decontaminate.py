import hashlib
import re

import pytest

from routeledger.llm import decontaminate

from .conftest import FOLD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, items, length=13, share=20):
    words = lambda t: WORD.findall((t or "").translate(FOLD))
    windows = {}
    for i, text in items:
        w = words(text)
        for a in range(max(1, len(w) - length + 1) if w else 0):
            windows.setdefault(tuple(w[a:a + length]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, own = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                found = windows.get(tuple(w[a:a + n]))
                if found:
                    own |= found
                    hit.update(range(a, a + n))
        ids = ",".join(sorted(map(str, own)))
        out.append((i, len(w), len(hit), len(own), hashlib.sha256(ids.encode()).hexdigest(),
                    bool(hit) and share * len(hit) >= len(w)))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.drop("ver").collect())


def test_contamination_equals_brute_force(docs, random_texts):
    items = [(1, random_texts[3][1]), (2, random_texts[3][1]), (3, " ".join(random_texts[7][1].split()[:20])),
             (4, "T1 t2"), (5, "absent words only"), (6, ""), (7, None), (10, "t5")]
    table = docs(items).select("doc_id", "text")
    assert result(decontaminate.contamination(docs(random_texts), table)) == plain(random_texts, items)
    kept = decontaminate.clean(docs(random_texts), table, 13, 2)
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in plain(random_texts, items, 13, 2) if not r[5]]
    assert kept.columns == docs([]).columns


def test_odd_rows(odd, docs):
    items = docs([(1, "a b c"), (2, "B, C!"), (None, "a"), (3, None), (1, "a b c")])
    got = result(decontaminate.contamination(odd, items))
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [
        (1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0), (4, 1, 0, 0), (5, 3, 3, 2), (5, 3, 3, 2), (6, 3, 3, 2),
        (7, 30_000, 0, 0), (8, 4, 0, 0), (9, 2, 0, 0), (9, 2, 0, 0)]
    assert decontaminate.contamination(docs([]), items).count() == 0
    assert decontaminate.contamination(odd, docs([])).where("n_hit > 0").count() == 0
    assert decontaminate.clean(odd, items).count() == 9


def test_proximity(docs):
    item = "red green blue " + " ".join(f"z{i}" for i in range(10))
    texts = [(1, item), (2, item.replace("green", "green and then")), (3, "red " + "x " * 200 + "green blue"), (4, "z1 z2")]
    index = decontaminate.Index(docs(texts), docs([(1, item)]), reach=60)
    near = {r.doc_id for r in index.proximity(slop=5).collect()}
    assert {r.doc_id for r in index.phrases().collect()} == {1} and {1, 2} <= near and 4 not in near


def test_proximity_without_an_absent_word_and_by_default_reach(docs):
    """One word is replaced in every document, so no document has it; a far document is met over the full slop."""
    words = [f"z{i}" for i in range(13)]
    other = words[:6] + ["other"] + words[7:]
    texts = [(1, " ".join(other)), (2, " ".join(words[:6] + ["x"] * 25 + words[7:])), (3, "z1 z2"), (4, "")]
    items = docs([(1, " ".join(words)), (2, "z1 absent")])
    assert sorted((r.doc_id, r.n_near) for r in decontaminate.near(docs(texts), items).collect()) == [
        (1, 1), (2, 1), (3, 0), (4, 0)]
    exact = docs([(1, " ".join(words))])
    assert [(r.doc_id, r.n_near) for r in decontaminate.near(exact, items).collect()] == [(1, 0)]
    with pytest.raises(ValueError):
        decontaminate.Index(docs(texts), items).proximity()
