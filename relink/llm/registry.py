"""Queries of this package over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocation, e8, filter_audit, html_region, inverted, langid, lattice, notices, packing, preference, reshard, simhash, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


#: Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a text whose A-Z are lowered, in DuckDB.
WORDS = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op3_decontaminate", rf"""
with d as (select doc_id, coalesce({WORDS.format('text')}, []) as w from documents),
     b as (select item_id, {WORDS.format('text')} as w from benchmark where text is not null),
     bw as (select distinct item_id, array_to_string(w[i : i + 9], ' ') as g, least(10, len(w)) as n
            from (select item_id, w, unnest(range(1, greatest(2, len(w) - 8))) as i from b where len(w) > 0)),
     sizes as (select distinct n from bw),
     dw as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as g
            from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
     hit as (select doc_id, item_id, i, dw.n from dw join bw on dw.g = bw.g and dw.n = bw.n),
     pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id),
     its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
             from (select distinct doc_id, item_id::varchar as item from hit) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join pos on d.doc_id = pos.doc_id left join its on d.doc_id = its.doc_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inverted.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_simhash_vptree")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_cross_parsing_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op8_ordered_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_flow_resharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshard.reshard(table(spark, sf_dir, "documents"))


@query("op6_addressed_archive", """
with p as (select page_id, coalesce(html, '') as html, max(page_id) over (partition by coalesce(html, '')) as lead from pages)
select page_id, strlen(html)::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(sha1(html), 1 + 5 * (i // 4)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int, 1)), '') as payload_digest,
       case when page_id = lead then 'response' else 'revisit' end as record_type,
       case when page_id <> lead then lead end as refers_to
from p
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive(table(spark, sf_dir, "pages"))
    return warc.records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_notice_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.labelled(notices.scan(table(spark, sf_dir, "documents")))


@query("op1_lattice_scores")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(table(spark, sf_dir, "documents"))


@query("op2_e8_near_duplicates", r"""
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings
       where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
         and len(list_filter(embedding, lambda x: x <> 0)) > 0),
     l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
           where list_cosine_similarity(a.e, b.e) >= 0.93),
     r as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from r join l on r.b = l.a)
select e.vec_id, (select count(*) from l where l.a = e.vec_id) as n_links, min(r.b) as component_id, min(r.b) = e.vec_id as kept
from embeddings e join r on r.a = e.vec_id group by e.vec_id
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e8.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op9_preference_pairs", """
with c as (select conv_id::bigint as pair_id, turn, role, text from conversations where conv_id is not null),
     a as (select pair_id, max(turn) as at_, max(text) filter (where turn = m) as answer from (select *, max(turn) over (partition by pair_id) as m from c where role = 'assistant') group by pair_id),
     b as (select c.*, a.at_, o.answer, coalesce(o.pair_id is not null and a.at_ is not null and c.pair_id % 5 <> 0, false) as swaps from c left join a on a.pair_id = c.pair_id left join a o on o.pair_id = c.pair_id + 1),
     s0 as (select pair_id, 0 as side, turn, role, text from c union all
            select pair_id, 1, turn, role, case when swaps and turn = at_ and role = 'assistant' then answer else text end from b where pair_id % 7 <> 0 and (not swaps or turn <= at_)),
     t as (select pair_id, side, row_number() over (partition by pair_id, side order by turn nulls first, role nulls first, text nulls first) as i, role, text from s0),
     s as (select pair_id, count(distinct side) as sides from t group by pair_id),
     n as (select pair_id, side, max(i) as n from t group by pair_id, side),
     d as (select c.pair_id, min(c.i) as i from t c join t r on c.pair_id = r.pair_id and c.i = r.i and c.side = 0 and r.side = 1
           where c.role is distinct from r.role or c.text is distinct from r.text group by c.pair_id),
     k as (select s.pair_id, case when sides < 2 then 0 else coalesce(d.i - 1, (select min(n) from n where n.pair_id = s.pair_id)) end as k, sides
           from s left join d on s.pair_id = d.pair_id),
     x as (select t.*, k, '<|' || replace(coalesce(role, 'unknown'), '|', '') || '|>' || chr(10) as h, replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) as b from t join k on t.pair_id = k.pair_id),
     y as (select *, coalesce(sum(length(h) + length(b)) over (partition by pair_id, side order by i rows between unbounded preceding and 1 preceding), 0) as pos from x where i > k),
     z as (select pair_id, side, string_agg(h || b, '' order by i) as body,
                  string_agg(case when role = 'assistant' then (pos + length(h))::bigint || '-' || (pos + length(h) + length(b))::bigint end, ',' order by i) as mask
           from y group by pair_id, side),
     p as (select pair_id, string_agg(h || b, '' order by i) as prompt from x where i <= k and side = 0 group by pair_id),
     own as (select distinct pair_id, side from t)
select k.pair_id, k.k::int as n_common, coalesce(prompt, '') as prompt,
       case when oc.side is not null then coalesce(c.body, '') end as chosen, case when orr.side is not null then coalesce(r.body, '') end as rejected,
       case when oc.side is not null then coalesce(c.mask, '') end as chosen_mask, case when orr.side is not null then coalesce(r.mask, '') end as rejected_mask,
       case when sides < 2 then 'unpaired' when c.body is null and r.body is null then 'equal' else 'pair' end as status
from k left join p on k.pair_id = p.pair_id
left join z c on k.pair_id = c.pair_id and c.side = 0 left join z r on k.pair_id = r.pair_id and r.side = 1
left join own oc on k.pair_id = oc.pair_id and oc.side = 0 left join own orr on k.pair_id = orr.pair_id and orr.side = 1
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.format_pairs(preference.swapped_answers(table(spark, sf_dir, "conversations")))
    spans = "array_join(transform({0}, s -> concat(s.from, '-', s.to)), ',') as {0}"
    return pairs.selectExpr("pair_id", "n_common", "prompt", "chosen", "rejected", spans.format("chosen_mask"), spans.format("rejected_mask"), "status")


@query("op12_branch_and_bound_phrases", r"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
     w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
     s as (select lang, m, array_to_string(w[i : i + m - 1], ' ') as phrase from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i
           from (select *, unnest([1, 2, 3, 4]) as m from w) where len(w) >= m)),
     f as materialized (select lang, m, phrase, count(*) as f from s group by all),
     n as (select lang, sum(f)::bigint as n from f where m = 1 group by lang),
     c as materialized (select lang, m, phrase, string_split(phrase, ' ') as ws, f as a from f where m > 1 and f >= 30),
     u as (select lang, m, phrase, a, k, array_to_string(ws[1 : k], ' ') as p, array_to_string(ws[k + 1 : m], ' ') as q
           from (select *, unnest(range(1, m)) as k from c)),
     cuts as (select u.*, x.f as l, y.f as r, 2000000::hugeint * a // (x.f + y.f) as score
              from u join f x on x.lang = u.lang and x.phrase = u.p join f y on y.lang = u.lang and y.phrase = u.q),
     best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
     held as (select lang, phrase, max(a) as over_ from (select lang, a, array_to_string(ws[i : i + s - 1], ' ') as phrase
              from (select *, unnest(range(1, m - s + 2)) as i from (select *, unnest([2, 3]) as s from c) where m > s)) group by all),
     live as (select b.* from best b left join held h on h.lang = b.lang and h.phrase = b.phrase
              where h.over_ is null or 100 * h.over_ < 80 * b.a)
select live.lang, row_number() over (partition by live.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from live join n on n.lang = live.lang qualify rank <= 2000
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


@query("op11_filter_audit", r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
     lab as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
     least as (select text, min(doc_id) as first from d group by text),
     f as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
                  (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
                  + 4 * (100 * (length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g'))) > 10 * length(d.text))::int
                  + 8 * regexp_matches(d.text, '[#$%&*|]')::int + 16 * coalesce(d.doc_id > first, false)::int as mask
           from d join least on least.text = d.text left join lab on lab.doc_id = d.doc_id),
     c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, mask),
     l as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
     o as (select a.x || b.x || c.x || d.x || e.x as o from l a, l b, l c, l d, l e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
     s as (select o, step, 1 << (ascii(o[step]) - 65) as bit,
                  list_sum([0] || list_transform(range(1, step), lambda j: 1 << (ascii(o[j]) - 65)))::int as before
           from (select o, unnest(range(1, 6)) as step from o)),
     x as (select part, o as filter_order, step::int as step, n, good, toxic, mask, bit, (mask & bit) <> 0 as fails, (mask & before) <> 0 as earlier from c, s)
select part, filter_order, step, coalesce(sum(n) filter (not fails and not earlier), 0)::bigint as kept,
       coalesce(sum(n) filter (fails and not earlier), 0)::bigint as removed, coalesce(sum(n) filter (fails and earlier), 0)::bigint as redundant,
       coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails, coalesce(sum(good) filter (fails and not earlier), 0)::bigint as good_lost,
       coalesce(sum(toxic) filter (fails and not earlier), 0)::bigint as toxic_lost,
       coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) filter (fails), 0)::bigint as shapley
from x group by part, filter_order, step
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


@query("op13_scored_region_text")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_region.extract(table(spark, sf_dir, "pages"))
