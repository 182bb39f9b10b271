"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm.chat import OP6_SQL, op6_chat_format
from tidemark.llm.common import table
from tidemark.llm.decontam import contamination
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.exact_search import OP12_SQL, op12_exact_topk
from tidemark.llm.langid import op5_language_mixture
from tidemark.llm.merkle import OP11_SQL, op11_merkle_manifest
from tidemark.llm.mixing import MIX_SQL, poisson_mix
from tidemark.llm.near_dup import near_dup_classes
from tidemark.llm.quality import op10_quality_mil
from tidemark.llm.repair import OP13_SQL, op13_conversation_repair
from tidemark.llm.sharding import balanced_shards
from tidemark.llm.token_counts import op9_token_counts
from tidemark.llm.warc import OP1_SQL, op1_warc_revisits


def op2_bagminhash_dedup(spark, sf_dir: str):
    return near_dup_classes(table(spark, sf_dir, "documents"))


def op3_poisson_mix(spark, sf_dir: str):
    return poisson_mix(table(spark, sf_dir, "documents"))


def op4_positional_index(spark, sf_dir: str):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_balanced_shards(spark, sf_dir: str):
    return balanced_shards(table(spark, sf_dir, "documents"))


def op8_digest_index(spark, sf_dir: str):
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_warc_revisits, op2_bagminhash_dedup, op3_poisson_mix, op4_positional_index, op5_language_mixture, op6_chat_format, op7_balanced_shards, op8_digest_index, op9_token_counts, op10_quality_mil, op11_merkle_manifest, op12_exact_topk, op13_conversation_repair)
}

OP4_SQL = r"""
with words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
grams as (select item_id, w[k:k + least(len(w), 10) - 1] as g, least(len(w), 10) as n from items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(k) where len(w) > 0),
widths as (select distinct n from grams),
spots as (select doc_id, k, n, w[k:k + n - 1] as g from words, widths, unnest(range(1, len(w) - n + 2)) as t(k)),
found as (select s.doc_id, s.k, s.n, i.item_id from spots s join grams i on s.n = i.n and s.g = i.g),
hits as (select doc_id, count(distinct k + j) as n_hit from found, unnest(range(0, n)) as t(j) group by doc_id),
ids as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed from (select distinct doc_id, item_id::varchar as item from found) group by doc_id),
frequency as (select x, count(*) as c from (select unnest(w) as x from words) group by x),
phrases as (select g, list_distinct(g) as terms from (select distinct g from grams)),
rarest as (select g, any_value(p.terms) as terms, arg_min(x, c) as x from (select g, terms, unnest(terms) as x from phrases) p join frequency using (x) group by g having count(*) = len(any_value(p.terms))),
places as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as k from words),
around as (select distinct p.doc_id, r.g, r.terms, d.w[greatest(p.k - 14, 1):p.k + 14] as part from places p join rarest r using (x) join words d on d.doc_id = p.doc_id),
near as (select distinct doc_id, g from around where list_has_all(part, terms) and len(list_filter(range(1, greatest(len(part) - 14, 1) + 1),
    lambda s: len(list_filter(terms, lambda t: len(list_filter(part[s:s + 14], lambda y: y = t)) < len(list_filter(g, lambda y: y = t)))) = 0)) > 0),
close as (select doc_id, count(distinct item_id) as n_near from near join grams using (g) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated,
  coalesce(n_near, 0)::bigint as n_near_items
from words left join hits using (doc_id) left join ids using (doc_id) left join close using (doc_id)
"""

OP8_SQL = """
with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as h from documents)
select doc_id, max(doc_id) over (partition by h) as keep_id, count(*) over (partition by h)::bigint as group_size, doc_id = max(doc_id) over (partition by h) as kept, h as text_sha256 from d
"""

ORACLES = {"op1_warc_revisits": OP1_SQL, "op3_poisson_mix": MIX_SQL, "op4_positional_index": OP4_SQL, "op6_chat_format": OP6_SQL, "op8_digest_index": OP8_SQL, "op11_merkle_manifest": OP11_SQL, "op12_exact_topk": OP12_SQL, "op13_conversation_repair": OP13_SQL}
