import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from routeledger.llm import words as W

TEXT = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aBc \t\n\x1cé中😀-9"), max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_words_are_those_of_the_pattern(texts):
    for sep, lower, pattern in ((W.SPACE, False, rb"[^\x20\x09-\x0D]+"), (W.ALNUM, True, rb"[0-9A-Za-z\x80-\xff]+")):
        got = W.split(pa.array(texts, pa.string()), sep, lower)
        want = [re.findall(pattern, (t or "").encode()) for t in texts]
        want = [[w.lower() for w in ws] if lower else ws for ws in want]
        assert np.diff(got.first).tolist() == [len(ws) for ws in want]
        flat = [w for ws in want for w in ws]
        assert [got.data[a:b].tobytes() for a, b in zip(got.start, got.end)] == flat
        assert len({(h, w) for h, w in zip(got.hash.tolist(), flat)}) == len(set(flat)) == len(set(got.hash.tolist()))
        for i in range(len(texts)):
            assert W.joined(got, None, i) == b" ".join(want[i])


def test_pieces_do_not_change_words(monkeypatch):
    texts = pa.array(["x" * 50 + " b " * 40, "", "c" * 300, "b x"])
    whole = W.split(texts, W.SPACE, False)
    monkeypatch.setattr(W, "_PIECE", 7)
    pieces = W.split(texts, W.SPACE, False)
    for name in ("start", "end", "hash", "first"):
        assert (getattr(whole, name) == getattr(pieces, name)).all()


def test_portions_hold_all_rows(monkeypatch):
    monkeypatch.setattr(W, "_PORTION", 5)
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "", "c" * 20, "d"])], ["text"])
    parts = list(W.portions([batch]))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 1
