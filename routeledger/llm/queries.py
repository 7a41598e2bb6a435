"""The corpus operators as registered queries over whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from routeledger.catalog import Registry
from routeledger.llm import bpe, chat, decontaminate, html_text, jaccard_join, language, language_model, lexical, merkle, minhash, neighbours, shared, substring, toxicity

R = Registry()

#: Words between white space, as DuckDB sees them.
_SPACED = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_SUBSTRING_SQL = f"""
with d as (select doc_id, {_SPACED} as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as k
        from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d)),
late as (select doc_id, i from win qualify row_number() over (partition by k order by doc_id, i) > 1),
gone as (select distinct doc_id, i + j as p from late, range(20) t(j)),
word as (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as p from d),
kept as (select doc_id, count(g.p) as n_removed, string_agg(x, ' ' order by p) filter (where g.p is null) as t
         from word left join gone g using (doc_id, p) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""


@R.add("op7_substring_dedup", _SUBSTRING_SQL)
def op7_substring_dedup(spark, sf_dir):
    return substring.removal(shared.read(spark, sf_dir, "documents"))


#: A-Z folded, other letters left alone; words of letters, digits and all beyond ASCII.
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"list_filter(regexp_split_to_array({_FOLDED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_DECONTAMINATE_SQL = f"""
with d as (select doc_id, {_PLAIN} as w from documents),
b as (select item_id, {_PLAIN} as w from benchmark),
win as (select distinct item_id, least(len(w), 13) as n, array_to_string(w[i:i + 12], ' ') as k
        from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from win),
place as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as k
          from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes)),
hit as (select doc_id, p.n, i, item_id from place p join win using (n, k)),
spot as (select doc_id, count(*) as n_hit from (
          select distinct doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, n, i from hit)) group by doc_id),
own as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
        from (select distinct doc_id, cast(item_id as varchar) as id from hit) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join spot using (doc_id) left join own using (doc_id)
"""


@R.add("op10_decontaminate", _DECONTAMINATE_SQL)
def op10_decontaminate(spark, sf_dir):
    items = shared.read(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "doc_id")
    return decontaminate.contamination(shared.read(spark, sf_dir, "documents"), items).drop("ver")


@R.add("benchmark_proximity")
def benchmark_proximity(spark, sf_dir):
    items = shared.read(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "doc_id")
    return decontaminate.near(shared.read(spark, sf_dir, "documents"), items).drop("ver")


_JACCARD_SQL = f"""
with recursive d as (select doc_id, {_SPACED} as w from documents),
g as (select doc_id, unnest(case when len(w) >= 5
        then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as k from d),
s as (select doc_id, count(*) as n from g group by doc_id),
common as (select x.doc_id as a, y.doc_id as b, count(*) as n from g x join g y using (k)
           where x.doc_id <> y.doc_id group by 1, 2),
p as (select a, b from common join s u on u.doc_id = a join s v on v.doc_id = b
      where 9 * common.n >= 4 * (u.n + v.n)),
r(a, b) as (select doc_id, doc_id from d union select r.a, p.b from r join p on r.b = p.a)
select doc_id, class_id, coalesce(n_links, 0) as n_links
from (select a as doc_id, min(b) as class_id from r group by a)
left join (select a as doc_id, count(*) as n_links from p group by a) using (doc_id)
"""


@R.add("op9_ngram_jaccard_join", _JACCARD_SQL)
def op9_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.similar(shared.read(spark, sf_dir, "documents")).drop("ver")


@R.add("op4_bpe_encode_decode")
def op4_bpe_encode_decode(spark, sf_dir):
    return bpe.digests(shared.read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@R.add("op5_language_id")
def op5_language_id(spark, sf_dir):
    return language.of_documents(shared.read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "language", "posterior", "accepted")


@R.add("page_language_id")
def page_language_id(spark, sf_dir):
    return language.of_pages(shared.read(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "language", "posterior", "accepted")


@R.add("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    return toxicity.grade(shared.read(spark, sf_dir, "documents"), shared.read(spark, sf_dir, "labels"))


_CHAT_SQL = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, * from (values (0, 'user', '</s>[INST] ok [/INST]'),
                                               (1, 'assistant', '</s>[INST] ok [/INST]')) as v(turn, role, text)),
n as (select *, length(text) + length(regexp_replace(text, '[^\\<\[\]]', '', 'g')) as body,
             length(role) + length(regexp_replace(role, '[^\\<\[\]]', '', 'g')) as name,
             lag(role) over (partition by conv_id order by turn, role, text) as before
      from t where conv_id is not null)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(3 + sum(body + case when before is not distinct from role then 3 else name + 6 end) as bigint)
           as formatted_chars
from n group by conv_id
"""


@R.add("op3_chat_format", _CHAT_SQL)
def op3_chat_format(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    given = shared.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(given.unionByName(own))


@R.add("op6_html_text")
def op6_html_text(spark, sf_dir):
    return html_text.extracted(shared.read(spark, sf_dir, "pages"))


@R.add("op1_nearest_neighbours")
def op1_nearest_neighbours(spark, sf_dir):
    return neighbours.search(shared.read(spark, sf_dir, "embeddings"))


@R.add("op2_language_model")
def op2_language_model(spark, sf_dir):
    return language_model.scored(shared.read(spark, sf_dir, "documents"))


#: crc32 goes through the digits bit by bit: an element 0 to 255 is a byte to fold in, -1 a shift.
_MERKLE_SQL = """
with recursive d as (select *, row_number() over () as rid from documents),
f as (select rid, doc_id, lang, text,
        case when doc_id is null then '-' else strlen(doc_id::varchar) || ':' || doc_id end
        || case when source is null then '-' else strlen(source) || ':' || source end
        || case when lang is null then '-' else strlen(lang) || ':' || lang end
        || case when n_chars is null then '-' else strlen(n_chars::varchar) || ':' || n_chars end as head,
        list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
            range(1, length(doc_id::varchar) + 1),
            lambda i: [ord((doc_id::varchar)[i])::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
          lambda c, x: case when x >= 0 then xor(c, x) when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as crc
      from d),
t as (select rid, doc_id, coalesce('=' || lang, '') as tree,
        sha256(head || case when text is null then '-' else strlen(text) || ':' || text end) as leaf,
        case when doc_id is not null and xor(crc, 4294967295::bigint) % 3 = 0 then
          sha256(head || case when text is null then '-' else strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end)
        end as changed from f),
p as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf, rid) - 1 as place,
        count(*) over (partition by tree) as n from t),
up(tree, level, place, n, h) as (
  select tree, 0, place, n, leaf from p
  union all
  select tree, level + 1, place // 8, (min(n) + 7) // 8, sha256(string_agg(h, '' order by place))
  from up where n > 1 group by tree, level, place // 8),
subroot as (select tree, h, row_number() over (order by tree) - 1 as place, count(*) over () as n from up where n = 1),
top(level, place, n, h) as (
  select 0, place, n, h from subroot
  union all
  select level + 1, place // 8, (min(n) + 7) // 8, sha256(string_agg(h, '' order by place))
  from top where n > 1 group by level, place // 8),
side as (select x.tree, x.level, x.place, coalesce(string_agg(y.h, '' order by y.place) filter (where y.place < x.place), '') as l,
           coalesce(string_agg(y.h, '' order by y.place) filter (where y.place > x.place), '') as r
         from up x join up y on y.tree = x.tree and y.level = x.level and y.place // 8 = x.place // 8
         where x.n > 1 group by x.tree, x.level, x.place),
top_side as (select x.level, x.place, coalesce(string_agg(y.h, '' order by y.place) filter (where y.place < x.place), '') as l,
           coalesce(string_agg(y.h, '' order by y.place) filter (where y.place > x.place), '') as r
         from top x join top y on y.level = x.level and y.place // 8 = x.place // 8
         where x.n > 1 group by x.level, x.place),
fold(rid, tree, level, place, h, proof) as (
  select rid, tree, 0, place, coalesce(changed, leaf), '' from p
  union all
  select rid, tree, level + 1, place // 8, sha256(l || h || r), proof || l || r from fold join side using (tree, level, place)),
done as (select rid, tree, h, proof from (select *, max(level) over (partition by rid) as last from fold) where level = last),
fold_top(rid, level, place, h, proof) as (
  select rid, 0, s.place, d.h, d.proof from done d join subroot s using (tree)
  union all
  select rid, level + 1, place // 8, sha256(l || h || r), proof || l || r from fold_top join top_side using (level, place)),
last as (select rid, h, proof from (select *, max(level) over (partition by rid) as last from fold_top) where level = last)
select p.doc_id, p.leaf, s.h as subroot, root.h as root, sha256(last.proof) as proof_sha256, last.h as folded_root,
       last.h = root.h as verified
from p join subroot s using (tree) join last using (rid) cross join (select h from top where n = 1) root
"""


@R.add("op12_merkle_manifest", _MERKLE_SQL)
def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest(shared.read(spark, sf_dir, "documents"))


_TERMS = rf"list_filter(regexp_split_to_array({_FOLDED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_LEXICAL_SQL = f"""
with d as (select row_number() over () as rid, doc_id, {_TERMS} as w from documents where doc_id is not null),
l as (select rid, doc_id, len(w) as n from d where len(w) > 0),
c as (select count(*) as docs, cast(sum(n) as bigint) as length from l),
tf as (select rid, term, count(*) as tf from (select rid, unnest(w) as term from d) group by rid, term),
df as (select term, count(*) as df from tf group by term),
q as (select item_id, text, term, count(*) as times
      from (select item_id, text, unnest({_TERMS}) as term from (select distinct item_id, text from benchmark where item_id is not null))
      group by item_id, text, term),
weight as (select item_id, text, term, times * cast(floor(1000 * ln((2.0 * docs + 2)::double / (2 * df + 1)::double)) as bigint) as w
           from q join df using (term), c),
scored as (select item_id, text, l.rid, doc_id,
             cast(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) as bigint) as score
           from weight join tf using (term) join l using (rid), c group by item_id, text, l.rid, doc_id)
select item_id, cast(row_number() over (partition by item_id, text order by score desc, doc_id) as integer) as rank, doc_id, score
from scored where score > 0
qualify row_number() over (partition by item_id, text order by score desc, doc_id) <= 20
"""


@R.add("op11_lexical_search", _LEXICAL_SQL)
def op11_lexical_search(spark, sf_dir):
    return lexical.ranked(shared.read(spark, sf_dir, "documents"), shared.read(spark, sf_dir, "benchmark"))


_MINHASH_SQL = f"""
with recursive d as (
  select row_number() over () as rid, doc_id, {_SPACED.replace("coalesce(text, '')", _FOLDED)} as w from documents where doc_id is not null),
t as materialized (select rid, unnest(case when len(w) >= 2
        then list_distinct(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')))
        when len(w) > 0 then w else [] end) as t from d),
id as materialized (select t, cast(row_number() over () as integer) as k from (select t from t group by t having count(*) > 1)),
g as materialized (select cast(rid as integer) as rid, k from t join id using (t)),
s as materialized (select rid, count(*) as n from t group by rid),
common as (select x.rid as a, y.rid as b, count(*) as n from g x join g y on x.k = y.k and x.rid < y.rid group by 1, 2),
half as (select a, b from common join s u on u.rid = a join s v on v.rid = b
      where 100 * common.n >= 80 * (u.n + v.n - common.n)),
p as materialized (select a, b from half union all select b, a from half),
r(a, b) as (select rid, rid from d union select r.a, p.b from r join p on r.b = p.a),
least as (select a as rid, min(doc_id) as component_id from r join d on d.rid = r.b group by a)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from d left join s using (rid) join least using (rid)
"""


@R.add("op13_minhash_dedup", _MINHASH_SQL)
def op13_minhash_dedup(spark, sf_dir):
    return minhash.near_groups(shared.read(spark, sf_dir, "documents")).drop("ver")


R.add("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
