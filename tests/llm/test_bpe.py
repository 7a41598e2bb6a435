import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from routeledger.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "th", "e", "ing", " ", "\n", "'s", "'LL", "É", "é", "Σ", "ς", "İ", "ß", "12", "½", "中文", "!", "...",
          "<|endoftext|>", "<|startoftext|>", "<|", "\x1c", "\x85", "\xa0", "😀", "ﬁ", "ǅ", "\x00", "aaaa", "''"]


@pytest.fixture(scope="module")
def both():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read()), Tokenizer.from_file(PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=6)), max_size=10).map("".join))
def test_ids_and_text_are_the_public_librarys(both, text):
    own, public = both
    ids = own.encode(text)
    assert ids == public.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == public.decode(ids, skip_special_tokens=False)


def test_long_words(both):
    own, public = both
    for text in ("a" * 5000, "abracadabra" * 700, "thethingthat" * 400 + "!" * 900):
        assert own.encode(text) == public.encode(text, add_special_tokens=False).ids


def test_documents(spark, odd, docs, both):
    public = both[1]
    rows = sorted((r.doc_id, r.text or "") for r in odd.collect() if r.doc_id is not None)
    want = []
    for i, text in rows:
        ids = public.encode(text, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(public.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(tuple(r) for r in bpe.digests(odd, PATH).collect()) == sorted(want)
    real = bpe.encoded(odd, PATH).collect()
    assert sorted((r.doc_id, len(r.ids)) for r in real) == sorted(w[:2] for w in want)
    assert bpe.digests(docs([]), PATH).count() == 0
