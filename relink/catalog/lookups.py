"""Joins through the crosswalk, pairing, set operations and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import shapes as sh, text as tx
from ..lineage import briefly, stored
from ..operators import audit as au, crosswalk as cx, harvest as hv, links as lk, overlay as ov, pairing as pa
from ..operators.ranking import chunk_index
from ..plans import project as pj
from .base import (
    CASE_CW, LINES, USER_CW, case_cw, crosswalk_of, entity_of, linked_documents, query, result_lines, t, user_cw,
    xw,
)

NATION_CW = "(select 'N' || c_nationkey as scope, c_custkey as source_key, 'c' || c_custkey as target_key from customer where c_acctbal >= 0)"


def nation_cw(spark, sf):
    return xw(t(spark, sf, "customer").where("c_acctbal >= 0"), "buyer", "c_custkey", "concat('c', c_custkey)", "concat('N', c_nationkey)")


@query("j01_lookup", f"""
select o_orderkey, target_key::varchar as target from orders left join {USER_CW} on o_custkey = source_key""")
def j01(spark, sf):
    return cx.lookup(t(spark, sf, "orders"), user_cw(spark, sf), "user", "o_custkey", "target").select("o_orderkey", "target")


SCOPED = "(select o_orderkey, 'N' || (length(o_orderstatus || o_orderpriority) - 5) as scope, o_custkey from orders)"


@query("j01b_scoped_lookup_salted", f"""
select o.o_orderkey, o.scope, target_key as target from {SCOPED} o left join {NATION_CW} c on o.scope = c.scope and o_custkey = source_key""")
def j01b(spark, sf):
    o = t(spark, sf, "orders").withColumn("scope", F.expr("concat('N', length(concat(o_orderstatus, o_orderpriority)) - 5)"))
    out = cx.lookup(o, nation_cw(spark, sf), "buyer", "o_custkey", "target", "scope", spread=F.col("o_orderkey"))
    return out.select("o_orderkey", "scope", "target")


@query("j02_lookup_default", f"""
select o_orderkey, coalesce(target_key::varchar, '1') as target from orders left join {USER_CW} on o_custkey = source_key""")
def j02(spark, sf):
    return cx.lookup(t(spark, sf, "orders"), user_cw(spark, sf), "user", "o_custkey", "target", default="1").select("o_orderkey", "target")


@query("j03_match_or_create", """
with s as (select p_partkey as id, lower(trim(p_name || ' ' || p_type || ' ' || p_size)) as nk from part),
  tg as (select nk, max(id) + 100000 as target_key from s where id in (select p_partkey from part where p_size > 25 and p_retailprice > 950) group by 1),
  f as (select nk, min(id) as created_from from s group by 1)
select id, target_key::varchar as target_key, case when target_key is not null then 'matched' when created_from = id then 'to_create' else 'reuse_new' end as outcome,
       case when target_key is null then created_from end as created_from
from s left join tg using (nk) left join f using (nk)""")
def j03(spark, sf):
    p = t(spark, sf, "part").withColumn("title", F.expr("initcap(concat(' ', p_name, ' ', p_type, ' ', p_size))"))
    target = p.where("p_size > 25 and p_retailprice > 950").select((F.col("p_partkey") + 100000).alias("id"), F.upper("title").alias("name"))
    out = cx.match_or_create(p.select(F.col("p_partkey").alias("id"), "title"), target, "id", cx.natural_key("title"),
                             cx.natural_key("name"), "id", ["id"], ["id"])
    return out.select("id", "target_key", "outcome", "created_from")


@query("j04_list_remap", """
select p_partkey, array_to_string(list_transform(list_filter(string_split(p_name, ' '), lambda w: not contains(w, 'e')), lambda w: upper(w)), ',') as words from part""")
def j04(spark, sf):
    p = t(spark, sf, "part")
    words = p.select(F.explode(F.split("p_name", " ")).alias("w")).distinct().where("not contains(w, 'e')")
    done = lk.resolve_refs(p, xw(words, "word", "w", "upper(w)"), ["p_partkey"], {"word": F.split("p_name", " ")}, out="m")
    return done.select("p_partkey", F.array_join(lk.remap_list(F.split("p_name", " "), "m", "word"), ",").alias("words"))


@query("j04b_link_remap", f"""
select l_orderkey, l_linenumber, l_partkey, target_key::varchar as target from lineitem join {CASE_CW} on l_partkey = source_key""")
def j04b(spark, sf):
    links = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lk.remap_links(links, case_cw(spark, sf), "case", "l_partkey", "target")


@query("j05_distinct_links", f"""
select l_orderkey, target_key::varchar as target, min(l_linenumber) as pos from lineitem join {CASE_CW} on l_partkey = source_key group by all""")
def j05(spark, sf):
    links = t(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("pos"), "l_partkey")
    mapped = lk.remap_links(links, case_cw(spark, sf), "case", "l_partkey", "target")
    return lk.distinct_links(mapped, ["l_orderkey"], "target", ["pos"]).select("l_orderkey", "target", "pos")


@query("j05b_distinct_list", """
with w as (select doc_id, generate_subscripts(string_split(text, ' '), 1) as i, unnest(string_split(text, ' ')) as w from documents),
  d as (select doc_id, w, min(i) as i from w where length(w) > 9 group by 1, 2)
select doc_id, coalesce(md5(string_agg(md5(w), ',' order by i)), md5('')) as words_md5 from documents left join d using (doc_id) group by 1""")
def j05b(spark, sf):
    d = t(spark, sf, "documents")
    words = d.select(F.explode(F.split("text", " ")).alias("w")).where("length(w) > 9").distinct()
    done = lk.resolve_refs(d, xw(words, "word", "w", "md5(w)"), ["doc_id"], {"word": F.split("text", " ")}, out="m")
    out = lk.remap_list(F.split("text", " "), "m", "word", distinct=True)
    return done.select("doc_id", F.md5(F.array_join(out, ",")).alias("words_md5"))


@query("j06_attribution_chain", f"""
with a as (select c_custkey as id, md5(c_name) as uuid from customer where c_acctbal > 1000),
r as (select o_orderkey, o_custkey, o_orderstatus, a.id as author, case when o_orderpriority = '1-URGENT' then 0 when o_orderpriority = '2-HIGH' then null else o_custkey end as member
      from orders left join customer c on o_custkey = c.c_custkey left join a on a.uuid = md5(c.c_name) and o_orderstatus <> 'P'),
u as (select o_orderkey, coalesce(author, member, case when o_orderstatus = 'F' then o_custkey end) as uid from r)
select o_orderkey, case when coalesce(uid, 0) = 0 then 1 else coalesce(target_key, 1) end as author_id from u left join {USER_CW} on uid = source_key""")
def j06(spark, sf):
    c = t(spark, sf, "customer")
    authors = xw(c.where("c_acctbal > 1000"), "author", "md5(c_name)", "c_custkey")
    rows = t(spark, sf, "orders").join(c.select(F.col("c_custkey").alias("o_custkey"), F.md5("c_name").alias("u")), "o_custkey", "left")
    rows = rows.select(
        "o_orderkey", F.expr("if(o_orderstatus <> 'P', u, null)").alias("author_uuid"),
        F.expr("case when o_orderpriority = '1-URGENT' then '0' when o_orderpriority = '2-HIGH' then 'abc' else cast(o_custkey as string) end").alias("member_id"),
        F.expr("if(o_orderstatus = 'F', o_custkey, null)").alias("created_by"))
    out = cx.attribute(rows, crosswalk_of(authors, user_cw(spark, sf)), "author_uuid", ["member_id", "created_by"], "author_id")
    return out.select("o_orderkey", "author_id")


@query("j07_attribution_aliases", f"""
select o_orderkey, coalesce(target_key, 1) as author_id
from (select o_orderkey, case when o_orderstatus = 'P' then null when o_orderstatus = 'F' and o_custkey <> 0 then o_custkey else nullif(o_custkey + 1, 0) end as uid from orders)
left join {USER_CW} on uid = source_key""")
def j07(spark, sf):
    run = entity_of(t(spark, sf, "orders"), "run", "o_orderpriority", id="o_orderkey", user_id="if(o_orderstatus = 'F', o_custkey, null)",
                    created_by="if(o_orderstatus = 'P', 'robot', '')", member_id="o_custkey + 1")
    rows = run.withColumn("who", sh.first_truthy("user_id", "created_by", "author_id", "member_id"))
    return cx.attribute(rows, user_cw(spark, sf), None, ["who"], "author_id").select(F.col("id").alias("o_orderkey"), "author_id")


@query("j08_title_lookup", """
with m as (select p_brand, p_name, max(p_partkey) as id from part where p_size > 20 group by all)
select p_partkey, case when p_retailprice > 950 then m.id when p_type <> 'SMALL' then p_partkey end as milestone
from part left join m using (p_brand, p_name)""")
def j08(spark, sf):
    p = t(spark, sf, "part")
    titles = cx.titles_to_ids(p.where("p_size > 20"), "p_name", "p_partkey", ["p_brand"], ["p_partkey"]).withColumnRenamed("p_partkey", "mid")
    rows = p.withColumn("wanted", F.when(F.col("p_retailprice") > 950, F.col("p_name"))).withColumn(
        "direct", F.when(F.col("p_type") != "SMALL", F.col("p_partkey")))
    return cx.lookup_by_title(rows, titles, "wanted", ["p_brand"], "mid", "direct", "milestone").select("p_partkey", "milestone")


@query("j09_detail_overlay", """
select o.o_orderkey, coalesce(case when o.o_totalprice > 200000 and o.o_orderstatus <> 'P' then 'D' end, o.o_orderstatus) as status,
  case when o.o_totalprice > 200000 and o.o_orderpriority <> '5-LOW' then 3 else 2 end as n_steps,
  case when o.o_totalprice > 200000 and o.o_orderpriority = '1-URGENT' then 3 else 2 end as n_files,
  case when o.o_totalprice > 200000 then o.o_custkey end as extra, coalesce(case when o.o_orderstatus = 'O' then 'own' end, case when o.o_totalprice > 200000 then 'detail' end) as note
from orders o""")
def j09(spark, sf):
    o = t(spark, sf, "orders")
    two, three = F.array(F.lit(1), F.lit(2)), F.array(F.lit(1), F.lit(2), F.lit(3))
    summary = o.select("o_orderkey", F.col("o_orderstatus").alias("status"), two.alias("steps"), two.alias("files"),
                       F.when(F.col("o_orderstatus") == "O", F.lit("own")).alias("note"))
    detail = o.where("o_totalprice > 200000").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.lit("D")).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.array(F.lit(1))).otherwise(three).alias("steps"),
        F.when(F.col("o_orderpriority") == "1-URGENT", three).otherwise(two).alias("files"),
        F.col("o_custkey").alias("extra"), F.lit("detail").alias("note"))
    out = ov.overlay(summary, detail, ["o_orderkey"], ("steps",), ("files",), ("note",), size=F.size)
    return out.select("o_orderkey", "status", F.size("steps").alias("n_steps"), F.size("files").alias("n_files"), "extra", "note")


@query("j10_case_metadata", f"""
select hash, case when p_size > 5 then p_brand || '/' || p_type when l_returnflag = 'R' then 'own' end as path,
       case when p_size > 5 then p_name end as first_step from {LINES} left join part on l_partkey = p_partkey""")
def j10(spark, sf):
    rows = entity_of(result_lines(spark, sf), "result", None, hash="hash", case_id="l_partkey", suite_title="if(l_returnflag = 'R', ' own ', null)")
    cases = entity_of(t(spark, sf, "part").where("p_size > 5"), "case", None, id="p_partkey", suite_title="concat(p_brand, '\\t', p_type)",
                      steps="array(named_struct('action', p_name))")
    out = pj.enrich_results(rows, None, cases)
    return out.select("hash", F.array_join("_path", "/").alias("path"), sh.get("_case_steps", "[0].action").alias("first_step"))


STEPS = "(select l_orderkey, l_linenumber, max(l_partkey) as p, max(l_suppkey) as s, max(l_quantity) as q from lineitem {0} group by 1, 2)"


@query("j11_zip_steps", f"""
with r as (select l_orderkey as id, [l_linenumber::int] as path, case when q > 25 then '.' else 'r' || p end as action, case when s > 5 then 'r' || s end as expected_result,
                  case when q > 10 then 5 end as status_id from {STEPS.format("where l_returnflag = 'R'")}
           union all select l_orderkey, [l_linenumber::int, 0], 'child', null, 2 from {STEPS.format("where l_returnflag = 'R'")} where q > 30),
c as (select l_orderkey as id, [l_linenumber::int] as path, 'c' || p as action, 'c' || s as expected_result, null::int as status_id from {STEPS.format("")}
      union all select l_orderkey, [l_linenumber::int, i], 'cc' || p, null, case when i = 1 then 3 end from {STEPS.format("")}, (values (0), (1)) v(i)),
covered as (select distinct id, path[:len(path) - 1] as parent from r),
m as (select coalesce(r.id, c.id) as id, coalesce(r.path, c.path) as path, r.id is not null as has_r, r.action as ra, c.action as ca, r.expected_result as re, c.expected_result as ce,
             r.status_id as rs, c.status_id as cs from r full join c on r.id = c.id and r.path = c.path)
select m.id, array_to_string(m.path, '.') as path, case when ra is null or ra = '.' then coalesce(ca, ra) else ra end as action, coalesce(re, ce) as expected_result,
  coalesce(rs, cs, case when not has_r and covered.id is null then 9 end) as status_id,
  case when has_r then 'result' when covered.id is null then 'synthetic' else 'case' end as origin
from m left join covered on covered.id = m.id and covered.parent = m.path[:len(m.path) - 1]""")
def j11(spark, sf):
    def base(rows):
        return rows.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("p"), F.max("l_suppkey").alias("s"), F.max("l_quantity").alias("q"))

    lines = t(spark, sf, "lineitem")
    r, c = base(lines.where("l_returnflag = 'R'")), base(lines)
    own = r.selectExpr("l_orderkey as id", "array(l_linenumber) as path", "if(q > 25, '.', concat('r', p)) as action",
                       "if(s > 5, concat('r', s), null) as expected_result", "if(q > 10, 5, null) as status_id").unionByName(
        r.where("q > 30").selectExpr("l_orderkey as id", "array(l_linenumber, 0) as path", "'child' as action",
                                     "cast(null as string) as expected_result", "2 as status_id"))
    case = c.selectExpr("l_orderkey as id", "array(l_linenumber) as path", "concat('c', p) as action", "concat('c', s) as expected_result",
                        "cast(null as int) as status_id", "9 as parent_status").unionByName(
        c.selectExpr("l_orderkey as id", "explode(array(0, 1)) as i", "l_linenumber", "p").selectExpr(
            "id", "array(l_linenumber, i) as path", "concat('cc', p) as action", "cast(null as string) as expected_result",
            "if(i = 1, 3, null) as status_id", "9 as parent_status"))
    out = ov.zip_steps(own, case, ["id"])
    return out.withColumn("path", F.array_join(F.col("path").cast("array<string>"), "."))


@query("j12_pair_by_position", """
with c as (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_partkey) - 1 as i from part)
select p_brand, p_partkey, case when i % 20 < 15 or p_brand <> 'Brand#1' then (p_partkey + 7)::varchar end as target_key from c""")
def j12(spark, sf):
    sent = chunk_index(t(spark, sf, "part"), ["p_brand"], ["p_partkey"], 20)
    kept = sent.where("pos < 15 or p_brand <> 'Brand#1'")
    returned = kept.groupBy("p_brand", "chunk").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", (F.col("p_partkey") + 7).cast("string").alias("id")))), lambda x: x["id"]).alias("ids"))
    return pa.pair_returned(sent, returned, ["p_brand", "chunk"], "pos", "ids").select("p_brand", "p_partkey", "target_key")


SENT = f"""(select project_code, hash, l_partkey, l_returnflag, l_quantity, (rn - 1) // 500 as chunk, (rn - 1) % 500 as pos
  from (select *, row_number() over (partition by project_code order by hash) as rn from {LINES}))"""


def sent_rows(spark, sf):
    rows = result_lines(spark, sf).select("project_code", "hash", "l_partkey", "l_returnflag", "l_quantity")
    with briefly(rows, "lines") as lines:
        return stored(chunk_index(lines, ["project_code"], ["hash"], 500), "sent")


@query("j13_pair_by_delta", f"""
with sent as (select * from {SENT}),
bad as (select distinct project_code, chunk from sent where project_code = '5-LOW' and l_quantity = 1)
select s.project_code, s.chunk::bigint as chunk, s.hash as source_key, case when bad.chunk is null then md5('t' || s.hash) end as target_key,
       case when bad.chunk is null then 'delta' else 'fallback' end as method
from sent s left join bad on s.project_code = bad.project_code and s.chunk = bad.chunk""")
def j13(spark, sf):
    sent = sent_rows(spark, sf)
    before = sent.where("l_returnflag = 'A'").select("project_code", "chunk", F.md5(F.concat(F.lit("old"), "hash")).alias("target"),
                                                     F.lit(0).cast("bigint").alias("at"))
    made = sent.where("not (project_code = '5-LOW' and l_quantity = 1)").select(
        "project_code", "chunk", F.md5(F.concat(F.lit("t"), "hash")).alias("target"), F.col("pos").alias("at"))
    strays = sent.where("project_code = '1-URGENT' and l_returnflag = 'R'").select(
        "project_code", "chunk", F.md5(F.concat(F.lit("stray"), "hash")).alias("target"), (-F.col("pos") - 1).alias("at"))
    after = before.unionByName(made).unionByName(strays)
    fresh = stored(pa.new_keys(before, after, ["target"]), "fresh")
    return pa.pair_by_delta(sent, fresh, ["project_code", "chunk"], "pos", "hash", "at", "target")


#: Chunks of four kinds: every row has its case; rows have titles only; neither, so that any key agrees; and rows with a case
#: beside rows that know a title only, whose keys are of other cases.
KINDS = f"""k as (select *, chunk % 4 as kind, case chunk % 4 when 0 then l_partkey when 3 then case when l_returnflag <> 'R' then l_partkey end end as case_id,
    case chunk % 4 when 1 then 't' || l_partkey when 3 then case when l_returnflag = 'R' then 'r' || l_partkey end else ' ' end as title from {SENT}),
made as (select project_code, chunk, kind, 499 - pos as ord, md5('t' || hash) as target, case when kind = 3 and l_returnflag = 'R' then -l_partkey else l_partkey end as key_case,
    case kind when 1 then 't' || l_partkey when 3 then case when l_returnflag = 'R' then 'r' || l_partkey else 'own' end else 'x' end as key_title from k where l_quantity > 5)"""


@query("j14_pair_greedily", f"""
with {KINDS},
s as (select *, row_number() over (partition by project_code, chunk, case when kind in (0, 3) then case_id end, case when kind in (1, 3) and case_id is null then title end order by pos) as n from k),
m as (select *, row_number() over (partition by project_code, chunk, case when kind = 0 or (kind = 3 and key_title = 'own') then key_case end,
  case when kind = 1 or (kind = 3 and key_title <> 'own') then key_title end order by ord, target) as n from made)
select s.project_code, s.chunk::bigint as chunk, s.hash as source_key, m.target as target_key from s join m on s.project_code = m.project_code and s.chunk = m.chunk and s.n = m.n
 and (s.kind = 2 or (s.case_id is not null and s.case_id = m.key_case) or (s.case_id is null and s.title = m.key_title))""")
def j14(spark, sf):
    sent = sent_rows(spark, sf).withColumn("kind", F.expr("chunk % 4"))
    sent = sent.withColumn("case_id", F.expr("case kind when 0 then l_partkey when 3 then if(l_returnflag <> 'R', l_partkey, null) end")).withColumn(
        "title", F.expr("case kind when 1 then concat('t', l_partkey) when 3 then if(l_returnflag = 'R', concat('r', l_partkey), null) else ' ' end"))
    made = sent.where("l_quantity > 5").select(
        "project_code", "chunk", (F.lit(499) - F.col("pos")).alias("at"), F.md5(F.concat(F.lit("t"), "hash")).alias("target"),
        F.expr("if(kind = 3 and l_returnflag = 'R', -l_partkey, l_partkey)").alias("case_id"),
        F.expr("case kind when 1 then concat('t', l_partkey) when 3 then if(l_returnflag = 'R', concat('r', l_partkey), 'own') else 'x' end").alias("title"))
    return pa.pair_greedily(sent, made, ["project_code", "chunk"], "pos", "hash", "at", "target")


@query("j15_resume", "select o_orderkey from orders where o_totalprice <= 100000")
def j15(spark, sf):
    o = t(spark, sf, "orders")
    done = xw(o.where("o_totalprice > 100000"), "run", "o_orderkey", "o_orderkey + 1", "o_orderpriority")
    return cx.resume(o, done, "run", "o_orderkey", "o_orderpriority").select("o_orderkey")


@query("j16_parents_with_links", f"""
select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem join {CASE_CW} on l_partkey = source_key)""")
def j16(spark, sf):
    links = lk.remap_links(t(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), case_cw(spark, sf), "case", "l_partkey", "target")
    parents = t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return lk.parents_with_links(parents, links, ["l_orderkey"]).withColumnRenamed("l_orderkey", "o_orderkey")


@query("j17_shared_step_refs", """
select p_partkey, case when p_type = 'SMALL' then '' else md5(p_type) || ';' end || 'plain ' || p_name as steps from part""")
def j17(spark, sf):
    p = t(spark, sf, "part").withColumn("steps", F.expr("parse_json(to_json(array(named_struct('shared', p_type, 'action', null), named_struct('shared', null, 'action', concat('plain ', p_name)))))"))
    p = p.withColumn("steps", sh.items("steps"))
    cw = xw(t(spark, sf, "part").select("p_type").distinct().where("p_type <> 'SMALL'"), "shared_step", "p_type", "md5(p_type)")
    ref = lambda s: sh.get(s, "shared")
    done = lk.resolve_refs(p, cw, ["p_partkey"], {"shared_step": F.transform("steps", ref)}, out="m")
    out = lk.substitute_refs("steps", "m", "shared_step", ref)
    return done.select("p_partkey", F.array_join(F.transform(out, lambda s: F.coalesce(s["shared"], sh.get(s["step"], "action"))), ";").alias("steps"))


@query("j18_map_key_remap", """
select p_partkey, case when p_size > 25 then 'T' || p_brand || '=' || p_name else '' end || case when p_size > 25 and p_type <> 'SMALL' then ';' else '' end ||
       case when p_type <> 'SMALL' then 'T' || p_type || '=' || p_size else '' end as fields from part""")
def j18(spark, sf):
    p = t(spark, sf, "part").withColumn("entries", F.expr(
        "array(named_struct('key', concat(p_brand, if(p_size > 25, '', '?')), 'value', p_name), named_struct('key', p_type, 'value', cast(p_size as string)))"))
    brands = t(spark, sf, "part").select(F.explode(F.array("p_brand", "p_type")).alias("k")).distinct().where("k <> 'SMALL'")
    done = lk.resolve_refs(p, xw(brands, "custom_field", "k", "concat('T', k)"), ["p_partkey"],
                           {"custom_field": F.transform("entries", lambda e: e["key"])}, out="m")
    out = lk.remap_map_keys("entries", "m", "custom_field")
    return done.select("p_partkey", F.array_join(F.transform(out, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("fields"))


@query("j19_shared_parameters", """
select p_partkey, case when p_type <> 'SMALL' then 'ref ' || md5(p_type) else 'single ' || p_name || '=' || p_brand end || ';group ' || p_brand || '=' || p_size || '|1' as parameters from part""")
def j19(spark, sf):
    raw = ("parse_json(to_json(array(named_struct('type', 'single', 'shared_id', p_type, 'item', named_struct('title', p_name, 'values', array(p_brand)), 'items', null),"
           " named_struct('type', 'group', 'shared_id', null, 'item', null, 'items', array(named_struct('title', p_brand, 'values', array(cast(p_size as string), '1')),"
           " named_struct('title', '', 'values', array('x')))))))")
    case = entity_of(t(spark, sf, "part"), "case", "p_brand", id="p_partkey", parameters=raw)
    cw = xw(t(spark, sf, "part").select("p_type").distinct().where("p_type <> 'SMALL'"), "shared_parameter", "p_type", "md5(p_type)")
    done = lk.resolve_refs(case, cw, ["id"], {"shared_parameter": F.transform(sh.items("parameters"), lambda p: sh.get(p, "shared_id"))}, out="m")

    def show(p):
        shape = F.array_join(F.transform(p["items"], lambda i: F.concat(i["title"], F.lit("="), F.array_join(i["values"], "|"))), ",")
        return F.coalesce(F.concat(F.lit("ref "), p["shared_id"]), F.concat(p["type"], F.lit(" "), shape))

    return done.select(F.col("id").alias("p_partkey"), F.array_join(F.transform(pj.parameter_shapes("m"), show), ";").alias("parameters"))


RECONCILE = f"""(with s as (select o_orderkey as id, count(distinct l_partkey) as n from orders left join lineitem on l_orderkey = o_orderkey group by 1),
 g as (select o_orderkey as id, count(distinct target_key) as n from orders left join lineitem on l_orderkey = o_orderkey left join {CASE_CW} on l_partkey = source_key
       where o_orderstatus <> 'P' group by 1)
select o_orderpriority as scope, o_orderkey::varchar as source_key, (o_orderkey + 1000000)::varchar as target_key, s.n as src_n, coalesce(g.n, -1) as tgt_n,
       case when o_orderstatus = 'F' then o_custkey end as src_plan, 'Run ' || o_orderkey as title,
       case when g.n is null then 'missing' when g.n = s.n then 'match' else 'mismatch' end as outcome
from orders join s on s.id = o_orderkey left join g on g.id = o_orderkey where o_totalprice > 50000)"""


def reconciled(spark, sf):
    o = t(spark, sf, "orders")
    links = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct()
    mapped = lk.remap_links(links, case_cw(spark, sf), "case", "l_partkey", "target")
    cw = xw(o.where("o_totalprice > 50000"), "run", "o_orderkey", "o_orderkey + 1000000", "o_orderpriority")
    runs = o.select(F.col("o_orderpriority").alias("scope"), "o_orderkey", "o_orderstatus", "o_custkey")
    n_src = links.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    n_tgt = mapped.groupBy("l_orderkey").agg(F.count_distinct("target").alias("n"))
    plan = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    src = runs.join(n_src, runs.o_orderkey == n_src.l_orderkey, "left").select(
        "scope", F.col("o_orderkey").alias("id"), F.coalesce("n", F.lit(0)).alias("n"), plan.alias("plan"),
        F.concat(F.lit("Run "), "o_orderkey").alias("title"))
    tgt = runs.where("o_orderstatus <> 'P'").join(n_tgt, F.col("o_orderkey") == n_tgt.l_orderkey, "left").select(
        "scope", (F.col("o_orderkey") + 1000000).alias("id"), F.coalesce("n", F.lit(0)).alias("n"), F.lit(None).cast("bigint").alias("plan"))
    return au.reconcile(cw, src, tgt)


@query("j20_reconcile", f"select * from {RECONCILE}")
def j20(spark, sf):
    return reconciled(spark, sf).drop("tgt_plan")


def brand_refs(spark, sf):
    """Keys referred to by projects: scope = brand, key = name."""
    return t(spark, sf, "part").select(F.col("p_brand").alias("scope"), F.md5("p_name").alias("key"), F.col("p_size").alias("ordinal"))


@query("j21_first_owner", """
select md5(p_name) as key, arg_min(p_brand, (substr(p_brand, 7)::int)) as owner from part group by 1""")
def j21(spark, sf):
    refs = brand_refs(spark, sf).withColumn("ordinal", F.expr("cast(substr(scope, 7) as int)"))
    return lk.first_owner(refs, "key", "scope", "ordinal")


@query("j22_fan_out", """
select distinct p_brand as scope, md5(p_name) as key, upper(p_name) as target_key from part where p_name not like '%e%'""")
def j22(spark, sf):
    known = t(spark, sf, "part").where("p_name not like '%e%'").select(F.md5("p_name").alias("key"), F.upper("p_name").alias("target_key")).distinct()
    refs = brand_refs(spark, sf).withColumn("key", F.upper("key"))
    return lk.fan_out(refs, known, "scope", "key").select("scope", "key", "target_key")


@query("j23_candidate_keys", """
select page_id, md5('t' || url) || case when length(html) > 1500 and html <> url then ',' || md5('t' || html) else '' end as keys from pages""")
def j23(spark, sf):
    p = t(spark, sf, "pages").withColumn("items", F.parse_json(F.to_json(F.expr(
        "array(upper(md5(url)), concat(left(md5(url), 8), '-', substr(md5(url), 9)), md5(html))"))))
    cw = crosswalk_of(xw(p, "attachment", "md5(url)", "md5(concat('t', url))"),
                      xw(p.where("length(html) > 1500"), "attachment", "md5(html)", "md5(concat('t', html))"))
    cw = cx.build_crosswalk(cw)
    keys = tx.media_keys("items")
    done = lk.resolve_refs(p, cw, ["page_id"], {"attachment": keys}, out="m")
    return done.select("page_id", F.array_join(lk.remap_list(keys, "m", "attachment", distinct=True), ",").alias("keys"))


@query("p09_pending_creates", """
select c_custkey, lower(c_name) || '@x.example' as email from customer
where c_mktsegment <> 'MACHINERY' and c_acctbal > 0 and not (c_mktsegment = 'BUILDING') and c_custkey <> 0""")
def p09(spark, sf):
    from ..plans import workspace as ws
    c = t(spark, sf, "customer")
    source = entity_of(c, "user", None, id="nullif(c_custkey, 0)", email="if(c_mktsegment = 'MACHINERY', '', concat(c_name, '@x.example'))", name="c_name", is_active="c_acctbal > 0")
    target = c.where("c_mktsegment = 'BUILDING'").select((F.col("c_custkey") + 100000).alias("id"), F.concat("c_name", F.lit("@X.example")).alias("email"))
    return ws.users(source, target)["payload"].select(F.col("source_id").alias("c_custkey"), "email")


# ------------------------------------------------------------------ set operations


@query("u01_union_distinct", """
select lang as scope, md5(doc_id::varchar) as key from documents union select source, md5(doc_id::varchar) from documents union select role, md5(text) from conversations""")
def u01(spark, sf):
    d = linked_documents(spark, sf)
    c = t(spark, sf, "conversations").withColumn("body", F.expr("concat(text, ' /attachment/', md5(text), '/')"))
    refs = hv.all_refs(hv.harvest_refs(d, "lang", [hv.text_refs("text")], 0, "doc_id"), hv.harvest_refs(d, "source", [hv.text_refs("text")], 1, "doc_id"),
                       hv.harvest_refs(c, "role", [hv.text_refs("body")], 2, "conv_id"))
    return hv.keys_by_scope(refs)


@query("u02_global_distinct", "select distinct md5(p_name) as key from part")
def u02(spark, sf):
    return hv.keys_by_scope(brand_refs(spark, sf)).select("key").distinct()


@query("u03_new_keys", f"select hash from {LINES} where l_returnflag <> 'A' and hash not in (select hash from {LINES} where l_returnflag = 'A')")
def u03(spark, sf):
    r = result_lines(spark, sf)
    return pa.new_keys(r.where("l_returnflag = 'A'"), r, ["hash"]).select("hash")


@query("u04_transfer_split", """
select md5(doc_id::varchar) as key, case when lang = 'en' then 'already_mapped' when source = 'src1' then 'at_target' else 'to_transfer' end as label,
       case when lang = 'en' then md5('t' || doc_id) when source = 'src1' then md5(doc_id::varchar) end as target_key from documents""")
def u04(spark, sf):
    d = t(spark, sf, "documents").withColumn("key", F.md5(F.col("doc_id").cast("string")))
    mapped = xw(d.where("lang = 'en'"), "attachment", "upper(key)", "md5(concat('t', doc_id))")
    return hv.transfer_split(d.select("key"), mapped, d.where("source = 'src1'").select("key"))


@query("u05_union_media", """
select page_id, url || ',' || '{"h":"' || md5(url) || '"}' || case when length(html) > 1500 then ',' || md5(html) else '' end as items from pages""")
def u05(spark, sf):
    p = t(spark, sf, "pages")
    a = F.parse_json(F.to_json(F.array("url")))
    b = F.parse_json(F.expr("concat('[{\"h\":\"', md5(url), '\"}]')"))
    c = F.parse_json(F.to_json(F.expr("if(length(html) > 1500, array(url, md5(html)), array(url))")))
    return p.select("page_id", F.array_join(tx.union_media(a, b, c), ",").alias("items"))


# ------------------------------------------------------------------ counts


def entity_rows(spark, sf):
    """Rows of three entities with their targets, per nation."""
    c = t(spark, sf, "customer").selectExpr("concat('N', c_nationkey) as project", "'user' as entity", "if(c_acctbal > 0, c_custkey, null) as target")
    s = t(spark, sf, "supplier").selectExpr("concat('N', s_nationkey) as project", "'environment' as entity", "if(s_acctbal > 0, s_suppkey, null) as target")
    n = t(spark, sf, "nation").selectExpr("concat('N', n_nationkey) as project", "'project' as entity", "cast(n_nationkey as bigint) as target")
    return c.unionByName(s).unionByName(n)


ENTITY_ROWS = """(select 'N' || c_nationkey as project, 'user' as entity, case when c_acctbal > 0 then c_custkey end as target from customer
 union all select 'N' || s_nationkey, 'environment', case when s_acctbal > 0 then s_suppkey end from supplier
 union all select 'N' || n_nationkey, 'project', n_nationkey from nation)"""


@query("a01_entity_stats", f"select entity, count(*) as processed, count(target) as created from {ENTITY_ROWS} group by 1")
def a01(spark, sf):
    return au.stats(entity_rows(spark, sf), ["entity"], "target")


@query("a02_merged_stats", f"select entity, count(*) as processed, count(target) as created from {ENTITY_ROWS} group by 1")
def a02(spark, sf):
    rows = entity_rows(spark, sf)
    first = au.stats(rows.where("project < 'N2'"), ["entity"], "target")
    return au.merge_stats([first, au.stats(rows.where("project >= 'N2'"), ["entity"], "target")], ["entity"])


@query("a03_project_summary", f"""
select coalesce(project, '(all)') as project, coalesce(entity, '(all)') as entity, count(*) as processed, count(target) as created
from {ENTITY_ROWS} group by rollup (project, entity)""")
def a03(spark, sf):
    return au.summary(entity_rows(spark, sf), "project", "entity", "target")


@query("a04_unique_keys", """
select coalesce(p_brand, '(all)') as scope, count(distinct p_name) as n_keys from part group by grouping sets ((p_brand), ())""")
def a04(spark, sf):
    refs = hv.keys_by_scope(brand_refs(spark, sf))
    per = refs.groupBy("scope").agg(F.count("*").alias("n_keys"))
    return per.unionByName(refs.select("key").distinct().agg(F.count("*").alias("n_keys")).withColumn("scope", F.lit("(all)")))


EXPECTED = """case o_orderpriority when '1-URGENT' then o_custkey when '2-HIGH' then 5 when '3-MEDIUM' then o_orderkey when '4-NOT SPECIFIED' then 3 end"""


def counted_runs(spark, sf):
    return entity_of(
        t(spark, sf, "orders"), "run", "o_orderpriority", id="o_orderkey",
        stats="case o_orderpriority when '1-URGENT' then parse_json(concat('{\"total\":', o_custkey, '}')) when '2-HIGH' then parse_json('{\"passed\":2,\"failed\":3}') else parse_json('{}') end",
        results_count="if(o_orderpriority = '3-MEDIUM', o_orderkey, null)", cases="if(o_orderpriority = '4-NOT SPECIFIED', array(1, 2, 3), null)")


@query("a05_expected_results", f"select o_orderkey, {EXPECTED} as expected from orders")
def a05(spark, sf):
    runs = counted_runs(spark, sf)
    return runs.select(F.col("id").alias("o_orderkey"), au.expected_results(runs).alias("expected"))


@query("a06_project_profile", f"""
with l as (select l_orderkey, count(*) as total from lineitem group by 1)
select o_orderpriority as project_code, count(*) filter (where o_orderstatus = 'F') as cases_total, count(*) as runs_total,
       sum(coalesce({EXPECTED}, total, 0))::bigint as results_total from orders left join l on l_orderkey = o_orderkey group by 1""")
def a06(spark, sf):
    runs = counted_runs(spark, sf)
    runs = runs.select("project_code", "id", au.expected_results(runs).alias("expected"))
    cases = t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderpriority").alias("project_code"))
    looked_up = result_lines(spark, sf).groupBy("project_code", F.col("l_orderkey").alias("run_id")).agg(F.count("*").alias("total"))
    return au.project_profile(cases, runs, looked_up)


@query("a07_reconcile_summary", f"""
select count(*) as compared, count(*) filter (where outcome = 'match') as matching, count(*) filter (where outcome = 'mismatch') as mismatching,
  count(*) filter (where outcome = 'missing') as missing, count(*) filter (where src_plan <> 0) as plan_runs,
  count(*) filter (where src_plan <> 0 and outcome = 'match') as plan_runs_match from {RECONCILE}""")
def a07(spark, sf):
    return au.reconcile_summary(reconciled(spark, sf))


def planned_users(spark, sf):
    from ..plans import workspace as ws
    c = t(spark, sf, "customer")
    source = entity_of(c, "user", None, id="c_custkey", email="if(c_mktsegment = 'MACHINERY', '', concat(c_mktsegment, '.', c_nationkey, '@x.example'))",
                       name="c_name", is_active="c_acctbal > 0")
    target = c.where("c_mktsegment = 'BUILDING'").select((F.col("c_custkey") + 100000).alias("id"),
                                                         F.lower(F.expr("concat(c_mktsegment, '.', c_nationkey, '@x.example')")).alias("email"))
    return ws.users(source, target)


USERS = """(with s as (select *, case when c_mktsegment <> 'MACHINERY' then lower(c_mktsegment || '.' || c_nationkey || '@x.example') end as email from customer),
 g as (select email, max(c_custkey) + 100000 as tid from s where c_mktsegment = 'BUILDING' group by 1), f as (select email, min(c_custkey) as cf from s where email is not null and c_acctbal > 0 group by 1)
 select s.c_custkey, s.email, case when s.email is null then 'invalid' when tid is not null then 'matched' when cf = c_custkey then 'to_create'
   when cf < c_custkey then 'reuse_new' else 'defaulted' end as outcome, case when tid is not null then tid::varchar when s.email is not null and (cf is null or cf > c_custkey) then '1' end as target_key
 from s left join g using (email) left join f using (email))"""


@query("a08_email_map", f"select email, arg_max(target_key, c_custkey) as target_key from {USERS} where target_key is not null group by 1")
def a08(spark, sf):
    return planned_users(spark, sf)["by_email"]


@query("a09_user_outcomes", f"select outcome, count(*) as n from {USERS} group by 1")
def a09(spark, sf):
    return planned_users(spark, sf)["counts"]


@query("a10_nested_count", "select p_brand, sum(len(string_split(p_name, ' ')))::bigint as n_configurations from part group by 1")
def a10(spark, sf):
    from ..sources.pages import entity_rows as rows_of
    from .scans import configuration_pages
    groups = rows_of(configuration_pages(spark, sf), "configuration_group")
    return groups.groupBy(F.col("project_code").alias("p_brand")).agg(F.sum(au.nested_count(groups)).alias("n_configurations"))


@query("a11_url_per_key", """
with r as (select md5(p_name) as key, 'https://h/attachments/' || md5(p_name) || '/' || p_partkey as url, case when p_size > 25 then 1 else 0 end as rank, lpad(p_partkey::varchar, 12, '0') as row_id from part)
select key, arg_max(url, (rank, row_id)) as url from r group by 1""")
def a11(spark, sf):
    p = t(spark, sf, "part").withColumn("u", F.expr("concat('![x](https://h/attachments/', md5(p_name), '/', p_partkey, ')')")).withColumn(
        "rid", F.lpad(F.col("p_partkey").cast("string"), 12, "0"))
    refs = hv.all_refs(hv.harvest_refs(p.where("p_size <= 25"), "p_brand", [hv.text_refs("u")], 0, "rid"),
                       hv.harvest_refs(p.where("p_size > 25"), "p_brand", [hv.text_refs("u")], 1, "rid"))
    return hv.url_per_key(refs)


@query("a12_event_counts", "select event_type as event, count(*) as n from events group by 1")
def a12(spark, sf):
    return au.outcome_counts(t(spark, sf, "events").withColumnRenamed("event_type", "event"), ["event"])


@query("rejects_with_reasons", """
select 'result' as entity, o_orderpriority as scope, l_orderkey::varchar as source_key, case when l_returnflag = 'A' then 'no case' else 'case not mapped' end as reason
from lineitem join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey where l_returnflag = 'A' or not p_size > 5""")
def rejected(spark, sf):
    rows = cx.lookup(result_lines(spark, sf), case_cw(spark, sf), "case", "l_partkey", "target")
    return au.rejects(rows, "result", "project_code", "l_orderkey", {
        "no case": F.col("l_returnflag") == "A", "case not mapped": F.col("target").isNull()})
