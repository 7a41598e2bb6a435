import hashlib

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from routeledger.llm import language, shared

from .test_decontaminate import plain as contamination
from .test_jaccard import plain as classes
from .test_substring import plain as repeats

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark):
    docs = shared.read(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = shared.landed(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        docs = out


def test_run_equals_the_plain_pipeline(spark):
    table = shared.read(spark, SF, "documents")
    kept = {r.id for r in language.of_documents(table).where("accepted").collect()}
    rows = [(r.doc_id, r.text) for r in table.collect() if r.doc_id in kept]
    text = dict(rows)
    rows = [(i, text[i]) for i, c, _ in classes(rows) if i == c]
    cut = repeats(rows, 20)
    rows = [(i, cut[i][3] if cut[i][1] else t) for i, t in rows]
    items = [(r.item_id, r.text) for r in shared.read(spark, SF, "benchmark").collect()]
    clean = {r[0] for r in contamination(rows, items) if not r[5]}
    public = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, t in rows:
        if i in clean:
            ids = public.encode(t, add_special_tokens=False).ids
            want[i] = (ids, hashlib.sha256(public.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (list(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
