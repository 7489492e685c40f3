"""Row-wise operators: predicates, codes and ids, dates, text, nested members."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, enums, predicates as pr, shapes as sh, text as tx
from ..operators import audit, links as lk, overlay as ov
from .base import ATT_CW, LINES, NEW_WS, OLD_WS, attachment_cw, entity_of, linked_documents, query, result_lines, t

# ------------------------------------------------------------------ predicates


@query("p01_allow_list", "select n_nationkey, n_name from nation where n_name in ('NATION_2', 'NATION_5')")
def p01(spark, sf):
    return pr.allow(t(spark, sf, "nation"), "n_name", ["NATION_2", "NATION_5"]).select("n_nationkey", "n_name")


@query("p02_deny_list", "select n_nationkey, n_name from nation where n_name not in ('NATION_2', 'NATION_5')")
def p02(spark, sf):
    return pr.deny(t(spark, sf, "nation"), "n_name", ["NATION_2", "NATION_5"]).select("n_nationkey", "n_name")


@query("p03_required_keys", """
select p_partkey, p_brand from part where trim(replace(p_name, 'red', '')) <> '' and p_size > 3 and trim(p_brand) <> ''""")
def p03(spark, sf):
    p = t(spark, sf, "part").withColumn("title", F.replace("p_name", F.lit("red"), F.lit(""))).withColumn(
        "id", F.when(F.col("p_size") > 3, F.col("p_partkey")))
    return p.where(pr.has_all("id", "title", "p_brand")).select("p_partkey", "p_brand")


FIRST_WORDS = "string_split(text, ' ')"


@query("p04_first_alias", """
select conv_id, turn, coalesce(nullif(trim(case when role = 'user' then text end), ''), nullif(trim(case when role = 'system' then '  ' end), ''),
       nullif(trim(role), '')) as label from conversations""")
def p04(spark, sf):
    c = t(spark, sf, "conversations")
    return c.select("conv_id", "turn", sh.first_non_blank(
        F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "system", F.lit("  ")), F.col("role")).alias("label"))


@query("p05_defaults", """
select o_orderkey, coalesce(case when o_orderstatus <> 'P' then o_orderstatus end, 'normal') as severity,
       coalesce(case when o_totalprice > 100000 then 3 end, 2) as priority from orders""")
def p05(spark, sf):
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", sh.or_default(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), "normal").alias("severity"),
                    sh.or_default(F.when(F.col("o_totalprice") > 100000, F.lit(3)), 2).alias("priority"))


@query("p06_non_empty", """
select page_id, trim(html) <> '' as has_html, len(string_split(url, '?')) - 1 > 0 as has_query,
       len(string_split(url, '?')) > 1 as shaped from pages""")
def p06(spark, sf):
    p = t(spark, sf, "pages").withColumn("parts", F.split("url", r"\?"))
    params = F.slice("parts", F.lit(2), F.size("parts"))
    v = F.parse_json(F.to_json(params))
    return p.select("page_id", sh.present("html").alias("has_html"), sh.present(params, "collection").alias("has_query"),
                    sh.nonempty(v).alias("shaped"))


@query("p07_run_finished", """
select o_orderkey, o_orderpriority = '1-URGENT' or o_orderdate < timestamp '1996-01-01' or o_orderstatus = 'F'
       or o_totalprice > 300000 as finished from orders""")
def p07(spark, sf):
    run = entity_of(
        t(spark, sf, "orders"), "run", "o_orderpriority", id="o_orderkey", is_completed="o_orderpriority = '1-URGENT'",
        finished_at="if(o_orderdate < timestamp_ntz'1996-01-01', '2020-01-01', '')", state="if(o_orderstatus = 'F', ' Done ', 'active')",
        run_status="named_struct('title', if(o_totalprice > 300000, 'Closed', 'open'))")
    return run.select(F.col("id").alias("o_orderkey"), pr.run_finished(run).alias("finished"))


@query("p08_defect_resolved", "select event_id, event_type in ('error', 'view') or (event_type = 'click' and value > 10) as resolve from events")
def p08(spark, sf):
    v = ("if(event_type = 'error', parse_json('\"Resolved\"'), if(event_type = 'view', parse_json('3'),"
         " if(event_type = 'click' and value > 10, parse_json('\"duplicate\"'), if(event_type = 'signup', parse_json('0'), parse_json('\"open\"')))))")
    return t(spark, sf, "events").select("event_id", pr.defect_resolved(F.expr(v)).alias("resolve"))


@query("p10_key_shape", """
select doc_id, length(replace(trim(w), '-', '')) >= 32 and regexp_full_match(lower(replace(trim(w), '-', '')), '[a-f0-9]+') as is_key
from (select doc_id, case when lang = 'en' then upper(md5(text)) when lang = 'fr' then left(md5(text), 30)
      when lang = 'es' then left(md5(text), 8) || '-' || substr(md5(text), 9) || '-ab' else lang end as w from documents)""")
def p10(spark, sf):
    w = F.expr("case when lang = 'en' then upper(md5(text)) when lang = 'fr' then left(md5(text), 30)"
               " when lang = 'es' then concat(left(md5(text), 8), '-', substr(md5(text), 9), '-ab') else lang end")
    return t(spark, sf, "documents").select("doc_id", tx.looks_like_key(w).alias("is_key"))


@query("p11_run_summary", """
select o_orderpriority as project_code, o_orderkey as source_run_id, left(repeat('Run ' || o_orderkey || ' ', 40), 200) as title,
       length(o_orderstatus) as description_len, o_custkey::varchar as user_id, 'M ' || o_orderstatus as milestone_title,
       2 as n_cases_on_run from orders""")
def p11(spark, sf):
    run = entity_of(t(spark, sf, "orders"), "run", "o_orderpriority", id="o_orderkey", title="repeat(concat('Run ', o_orderkey, ' '), 40)",
                    description="o_orderstatus", user_id="o_custkey", milestone="named_struct('title', concat('M ', o_orderstatus))",
                    cases="array(o_custkey, o_orderkey)")
    return audit.run_summary(run).select("project_code", "source_run_id", "title", "description_len", "user_id",
                                         "milestone_title", "n_cases_on_run")


@query("p12_user_label", """
select c_custkey, '  - ' || lower(c_name) || '  |  ' || case when c_acctbal > 5000 then c_name when c_mktsegment <> 'BUILDING'
       then 'C ' || c_mktsegment else 'C' end || case when c_acctbal > 0 then '' else ' (inactive)' end as line from customer""")
def p12(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", tx.display_line(
        F.lower("c_name"), F.when(F.col("c_acctbal") > 5000, F.col("c_name")), F.lit("C"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")), F.col("c_acctbal") > 0).alias("line"))


# ------------------------------------------------------------------ ids, codes, numbers

HASHED = "('0x' || substr(md5({0}::varchar), 1, 8))::bigint % 2147483647"


@query("m01_safe_id", f"""
select o_orderkey, case when id <= 2147483647 then id else {HASHED.format('id')} end as new_id
from (select o_orderkey, o_orderkey * 1000000 as id from orders)""")
def m01(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", enums.safe_id(F.col("o_orderkey") * 1000000).alias("new_id"))


@query("m02_id_collisions", f"""
select new_id, count(*) as n_originals, min(id) as first_original from (
  select id, case when id <= 2147483647 then id else {HASHED.format('id')} end % 100003 as new_id
  from (select distinct l_orderkey * 1000000 + l_partkey as id from lineitem)) group by 1 having count(*) > 1""")
def m02(spark, sf):
    from ..operators.crosswalk import collisions
    ids = t(spark, sf, "lineitem").select((F.col("l_orderkey") * 1000000 + F.col("l_partkey")).alias("id"))
    # Folding the ids into a smaller range makes collisions show at any scale.
    return collisions(ids.withColumn("new_id", enums.safe_id("id") % 100003), "id", "new_id")


@query("m02b_ids_of_their_own", """
select p_brand, count(*) as n_ids, count(*) as n_distinct, 100 as low, 100 + max(n) as high, count(*) filter (where p_size <= 25) as n_kept
from part join (select max(c) - 1 as n from (select count(*) as c from part group by p_brand)) on true group by p_brand""")
def m02b(spark, sf):
    """Two loads into a range that the largest brand fills to the last id."""
    from ..operators.crosswalk import assign_ids
    p = t(spark, sf, "part").select("p_brand", "p_partkey", "p_size")
    most = p.groupBy("p_brand").count().agg(F.max("count")).first()[0]
    first = assign_ids(p.where("p_size <= 25"), "p_partkey", 100, 99 + most, by=["p_brand"])
    both = assign_ids(p, "p_partkey", 100, 99 + most, first, ["p_brand"])
    kept = first.select("p_brand", "p_partkey", F.col("made").alias("was"))
    return both.join(kept, ["p_brand", "p_partkey"], "left").groupBy("p_brand").agg(
        F.count("*").alias("n_ids"), F.count_distinct("made").alias("n_distinct"), F.lit(100).alias("low"),
        F.when(F.max("made") <= 99 + most, F.lit(99 + most)).otherwise(F.max("made")).cast("bigint").alias("high"),
        F.count_if(F.col("was") == F.col("made")).alias("n_kept"))


STATUS_WORDS = {"error": "Fail", "click": "pending", "view": "Pass", "signup": "retry", "purchase": "odd"}
WORD_SQL = "case event_type when 'error' then 'Fail' when 'click' then 'pending' when 'view' then 'Pass' when 'signup' then 'retry' else 'odd' end"


def words(spark, sf):
    ev = t(spark, sf, "events")
    word = F.expr(WORD_SQL)
    return ev.withColumn("word", word).withColumn("n", F.floor(F.col("value")).cast("int"))


@query("m03_result_status", f"""
select event_id, coalesce(case floor(value)::int when 1 then 'passed' when 2 then 'blocked' when 3 then 'skipped' when 4 then 'retest' when 5 then 'failed' end,
       case event_type when 'error' then 'failed' when 'click' then 'in_progress' when 'view' then 'passed' when 'signup' then 'retest' else 'skipped' end) as status
from events""")
def m03(spark, sf):
    return words(spark, sf).select("event_id", enums.result_status("n", "word").alias("status"))


@query("m04_run_status", """
select event_id, case when s in ('retest', 'in_progress') then 'blocked' when s in ('passed', 'failed', 'blocked', 'skipped', 'untested', 'invalid') then s else 'skipped' end as status
from (select event_id, case event_type when 'error' then 'Retest' when 'click' then 'in_progress' when 'view' then 'untested' when 'signup' then 'zzz' else 'passed' end as w, lower(w) as s from events)""")
def m04(spark, sf):
    w = F.expr("case event_type when 'error' then 'Retest' when 'click' then 'in_progress' when 'view' then 'untested' when 'signup' then 'zzz' else 'passed' end")
    return t(spark, sf, "events").select("event_id", enums.run_execution_status(w).alias("status"))


@query("m05_step_status", f"""
select event_id, case when value > 20 then case event_type when 'error' then 'failed' when 'click' then 'in_progress' else 'passed' end
  else coalesce(case floor(value)::int when 1 then 'passed' when 2 then 'failed' when 3 then 'blocked' when 5 then 'skipped' when 7 then 'in_progress' end, 'passed') end as status
from events""")
def m05(spark, sf):
    v = F.when(F.col("value") > 20, F.parse_json(F.concat(F.lit('"'), F.col("word"), F.lit('"')))).otherwise(
        F.parse_json(F.col("n").cast("string")))
    return words(spark, sf).select("event_id", enums.step_status(v).alias("status"))


@query("m06_severity", """
select o_orderkey, case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 4 when '5-LOW' then 5 else 0 end as severity from orders""")
def m06(spark, sf):
    w = F.expr("case o_orderpriority when '1-URGENT' then 'Blocker' when '2-HIGH' then 'critical' when '3-MEDIUM' then 'normal' when '5-LOW' then 'MINOR' end")
    return t(spark, sf, "orders").select("o_orderkey", enums.severity_code(w).alias("severity"))


@query("m07_field_entity", "select event_id, case event_type when 'click' then 1 when 'error' then 2 else 0 end as entity from events")
def m07(spark, sf):
    w = F.expr("case event_type when 'click' then 'Run' when 'error' then 'defect' when 'view' then 'case' else 'x' end")
    return t(spark, sf, "events").select("event_id", enums.field_entity_of_word(w).alias("entity"))


@query("m08_field_type", """
select p_partkey, case when p_size > 40 then p_size else case p_type when 'SMALL' then 1 when 'LARGE' then 6 when 'ECONOMY' then 9 when 'STANDARD' then 3 else 0 end end as type from part""")
def m08(spark, sf):
    v = F.expr("if(p_size > 40, parse_json(cast(p_size as string)), parse_json(concat('\"', case p_type when 'SMALL' then 'number' when 'LARGE' then 'MultiSelect'"
               " when 'ECONOMY' then 'date' when 'STANDARD' then 'selectbox' else 'other' end, '\"')))")
    return t(spark, sf, "part").select("p_partkey", enums.field_type_code(v).alias("type"))


@query("m09_duration", """
select event_id, case when event_type = 'error' then null when event_type = 'click' then floor(value)::bigint
       when event_type = 'view' then floor(value)::bigint * 1000 when event_type = 'signup' then event_id end as ms from events""")
def m09(spark, sf):
    ev = t(spark, sf, "events").withColumn("n", F.floor("value"))
    is_ = lambda x: F.col("event_type") == x
    text = F.when(is_("signup"), F.lit("x"))
    return ev.select("event_id", enums.duration_ms(
        [F.when(is_("error"), F.lit(-5).cast("bigint")).when(is_("click"), F.col("n")), text.try_cast("bigint"),
         F.when(is_("signup"), F.col("event_id"))],
        [F.when(is_("error") | is_("view"), F.col("n"))]).alias("ms"))


@query("m10_numeric_id", """
select c_custkey, case when c_mktsegment = 'BUILDING' then c_custkey::varchar when c_mktsegment = 'MACHINERY' then 'id-' || c_custkey
       else (c_custkey + 7)::varchar end as id from customer""")
def m10(spark, sf):
    raw = F.expr("case when c_mktsegment = 'BUILDING' then concat('  00', c_custkey) when c_mktsegment = 'MACHINERY' then concat('id-', c_custkey)"
                 " else cast(c_custkey + 7 as string) end")
    return t(spark, sf, "customer").select("c_custkey", enums.numeric_text(raw).alias("id"))


# ------------------------------------------------------------------ dates


@query("d01_wall_clock", """
select event_id, case event_type when 'signup' then strftime(ts, '%Y-%m-%d') || ' 00:00:00' when 'error' then 'at ' || event_id
       else strftime(ts, '%Y-%m-%d %H:%M:%S') end as at from events""")
def d01(spark, sf):
    raw = F.expr("case event_type when 'click' then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+05:00'\") when 'view' then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
                 " when 'signup' then date_format(ts, 'yyyy-MM-dd') when 'error' then concat('at ', event_id) else date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'-05:00'\") end")
    return t(spark, sf, "events").select("event_id", dates.wall_clock(raw).alias("at"))


@query("d02_day", """
select event_id, case event_type when 'error' then left('2026-13-45 x' || event_id, 10) when 'click' then 'abc' else strftime(ts, '%Y-%m-%d') end as day from events""")
def d02(spark, sf):
    raw = F.expr("case event_type when 'error' then concat('2026-13-45 x', event_id) when 'click' then 'abc' else date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") end")
    return t(spark, sf, "events").select("event_id", dates.day(raw).alias("day"))


@query("d03_iso_text", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as created_at from orders")
def d03(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", dates.iso_text("o_orderdate").alias("created_at"))


# ------------------------------------------------------------------ text

LINKED = f"""(select doc_id, lang, source, n_chars, md5(doc_id::varchar) as k, text as raw, text || ' ![a b](https://files.example/public/team/{OLD_WS}/attachment/' ||
  upper(md5(doc_id::varchar)) || '/pic.png) see /attachment/' || md5(doc_id::varchar) || '/ and /attachments/' || md5(doc_id::varchar) || '/x' as text from documents)"""


@query("x01_embedded_keys", f"select doc_id, array_to_string(list_distinct([k]), ',') as keys from {LINKED}")
def x01(spark, sf):
    return linked_documents(spark, sf).select("doc_id", F.array_join(tx.embedded_keys("text"), ",").alias("keys"))


@query("x02_embedded_urls", f"""
select doc_id, k as key, 'https://files.example/public/team/{OLD_WS}/attachment/' || upper(k) || '/pic.png' as url from {LINKED}""")
def x02(spark, sf):
    return linked_documents(spark, sf).select("doc_id", F.inline(tx.embedded_urls("text")))


@query("x03_keys_of_fields", """
select conv_id, turn, unnest(list_distinct([md5(conv_id::varchar), md5(text), md5(turn::varchar)])) as key from conversations""")
def x03(spark, sf):
    from ..operators.harvest import text_refs, value_refs
    c = t(spark, sf, "conversations").withColumn("body", F.expr("concat(text, ' /attachment/', md5(cast(conv_id as string)), '/ ')"))
    listed = F.parse_json(F.to_json(F.array(F.expr("named_struct('value', concat(text, ' /attachments/', md5(text), '/'))"))))
    single = F.parse_json(F.to_json(F.expr("named_struct('value', concat('/attachment/', upper(md5(cast(turn as string))), '/z'))")))
    refs = F.flatten(F.array(text_refs("body"), value_refs(listed), value_refs(single)))
    return c.select("conv_id", "turn", F.explode(F.array_distinct(F.transform(refs, lambda r: r["key"]))).alias("key"))


@query("x04_urls_of_fields", """
select conv_id, turn, md5(conv_id::varchar) as key, 'https://h.example/attachment/' || md5(conv_id::varchar) || '/' || turn as url from conversations
union all
select conv_id, turn, md5(text), 'https://h.example/attachments/' || md5(text) || '/b' from conversations""")
def x04(spark, sf):
    from ..operators.harvest import value_refs
    c = t(spark, sf, "conversations").withColumn("body", F.expr(
        "concat(text, ' ![n](https://h.example/attachment/', md5(cast(conv_id as string)), '/', turn, ') ')"))
    listed = F.parse_json(F.to_json(F.array(F.expr("named_struct('value', concat('![m](https://h.example/attachments/', md5(text), '/b)'))"))))
    refs = F.flatten(F.array(tx.embedded_urls("body"), value_refs(listed)))
    return c.select("conv_id", "turn", F.inline(refs)).where("url is not null")


@query("x05_rewrite_text", f"""
select d.doc_id, md5(case when a.target_key is null then d.text else d.raw || ' ![a b](https://files.example/public/team/{NEW_WS}/attachment/' || a.target_key ||
       '/pic.png) see /attachment/' || a.target_key || '/ and /attachments/' || d.k || '/x' end) as text_md5
from {LINKED} d left join {ATT_CW} a using (doc_id)""")
def x05(spark, sf):
    out = lk.rewrite_text(linked_documents(spark, sf), attachment_cw(spark, sf), ["doc_id"], ["text"], new_workspace=NEW_WS)
    return out.select("doc_id", F.md5("text").alias("text_md5"))


@query("x05b_rewrite_text_symmetric", f"""
select d.doc_id, md5(case when a.target_key is null then d.text else d.raw || ' ![a b](https://files.example/public/team/{OLD_WS}/attachment/' || a.target_key ||
       '/pic.png) see /attachment/' || a.target_key || '/ and /attachments/' || a.target_key || '/x' end) as text_md5
from {LINKED} d left join {ATT_CW} a using (doc_id)""")
def x05b(spark, sf):
    out = lk.rewrite_text(linked_documents(spark, sf), attachment_cw(spark, sf), ["doc_id"], ["text"], symmetric=True)
    return out.select("doc_id", F.md5("text").alias("text_md5"))


@query("x06_media_list", """
select page_id, unnest(list_distinct([md5(url), md5(html), md5(page_id::varchar)])) as key from pages""")
def x06(spark, sf):
    items = F.parse_json(F.to_json(F.array(F.expr(
        "named_struct('fileHash', upper(md5(url)), 'href', concat('https://h/attachments/', md5(html), '/f'), 'id', page_id)"))))
    plain = F.parse_json(F.to_json(F.array(F.expr("md5(cast(page_id as string))"), F.lit("short"))))
    return t(spark, sf, "pages").select("page_id", F.explode(tx.media_keys(items, plain)).alias("key"))


@query("x07_nested_media", """
select page_id, unnest([md5(url), md5(html), md5(page_id::varchar)]) as key from pages""")
def x07(spark, sf):
    from ..operators.harvest import result_refs
    step = ("array(named_struct('data', named_struct('files', array(md5(html))), 'execution', named_struct('comment', concat('/attachment/', md5(cast(page_id as string)), '/'))))")
    rows = entity_of(t(spark, sf, "pages"), "result", None, hash="cast(page_id as string)", steps=step,
                     execution="named_struct('screenshots', array(named_struct('url', concat('https://h/attachment/', md5(url), '/a'))))")
    refs = result_refs(rows)
    return refs.select(F.col("row_id").cast("bigint").alias("page_id"), "key").distinct()


@query("x08_harvest_per_project", """
select p_brand as scope, 'case' as kind, md5(p_name) as key from part group by all
union all select o_orderpriority, 'defect', md5(o_orderkey::varchar) from orders
union all select role, 'result', md5(text) from conversations group by all""")
def x08(spark, sf):
    from ..operators import harvest as hv
    cases = entity_of(t(spark, sf, "part"), "case", "p_brand", id="p_partkey", attachments="array(named_struct('hash', upper(md5(p_name))))")
    defects = entity_of(t(spark, sf, "orders"), "defect", "o_orderpriority", id="o_orderkey",
                        actual_result="concat('x /attachment/', md5(cast(o_orderkey as string)), '/ y')")
    results = entity_of(t(spark, sf, "conversations"), "result", "role", hash="concat(conv_id, ':', turn)",
                        comment="concat(text, ' /attachment/', md5(text), '/')")
    refs = hv.all_refs(hv.case_refs(cases), hv.result_refs(results), hv.defect_refs(defects))
    kind = F.element_at(F.array(F.lit("case"), F.lit("result"), F.lit("defect")), F.col("source_rank") + 1)
    return refs.select("scope", kind.alias("kind"), "key").distinct()


@query("x09_workspace_hash", "select page_id, case when length(html) > 1500 then md5(url) end as ws from pages")
def x09(spark, sf):
    p = t(spark, sf, "pages")
    body = F.to_json(F.expr("named_struct('result', array(named_struct('url', if(length(html) > 1500, concat('https://h/public/team/', md5(url), '/a'), url))))"))
    return p.select("page_id", tx.workspace_hash(body).alias("ws"))


@query("x10_split_name", r"""
select c_custkey, case when c_acctbal < 0 then lower(c_mktsegment) else string_split(c_name, '#')[1] end as first_name,
       case when c_acctbal < 0 then '' else string_split(c_name, '#')[2] || ' of ' || c_mktsegment end as last_name from customer""")
def x10(spark, sf):
    c = t(spark, sf, "customer")
    name = F.expr("if(c_acctbal < 0, '   ', concat('  ', replace(c_name, '#', '\t '), ' of ', c_mktsegment, ' '))")
    first, last = tx.split_name(name, F.expr("concat(lower(c_mktsegment), '@example.com')"))
    return c.select("c_custkey", first.alias("first_name"), last.alias("last_name"))


@query("x11_display_title", f"""
select hash, case when l_returnflag = 'A' then 'Line ' || l_linenumber when l_returnflag = 'R' then 'Part ' || l_partkey
       when l_linestatus = 'F' then 'Automated Test ' || l_partkey when l_quantity > 25 then 'Automated Test ' || l_orderkey
       else 'Automated Test ' || left(hash, 12) end as title from {LINES}""")
def x11(spark, sf):
    r = result_lines(spark, sf)
    case = F.when(F.col("l_returnflag") == "R", F.parse_json(F.expr("concat('{\"name\":\"Part ', l_partkey, '\"}')")))
    own = F.when(F.col("l_returnflag") == "A", F.expr("concat(' Line ', l_linenumber, ' ')"))
    return r.select("hash", tx.result_title(
        [own, F.lit("  ")], case, F.when(F.col("l_linestatus") == "F", F.col("l_partkey").cast("string")),
        F.when(F.col("l_quantity") > 25, F.col("l_orderkey")), F.lit(None).cast("bigint"), "hash").alias("title"))


@query("x12_message", r"""
select conv_id, turn, md5(nullif(trim(concat_ws(e'\n\n', case when role = 'user' then text end, nullif(case when turn > 2 then role else '' end, ''), case when turn = 1 then text end)), '')) as message_md5,
 from conversations""")
def x12(spark, sf):
    c = t(spark, sf, "conversations")
    m = tx.join_message(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("turn") > 2, F.col("role")).otherwise(F.lit("")),
                        F.when(F.col("turn") == 1, F.col("text")))
    return c.select("conv_id", "turn", F.md5(m).alias("message_md5"))


@query("x13_step_comment", r"""
select conv_id, turn, md5(nullif(concat_ws(e'\n\n', case when role = 'assistant' then e'**Actual result**\n' || trim(text) end,
       case when turn > 1 then e'**Comment**\n' || role end), '')) as comment_md5 from conversations""")
def x13(spark, sf):
    step = F.parse_json(F.to_json(F.expr(
        "named_struct('data', named_struct('actual', if(role = 'assistant', text, null)), 'execution', named_struct('message', if(turn > 1, role, null)))")))
    c = t(spark, sf, "conversations").withColumn("step", ov.flat_step(step))
    md = tx.step_comment(ov.step_text(F.col("step"), ov.ACTUAL), ov.step_text(F.col("step"), ov.COMMENT))
    return c.select("conv_id", "turn", F.md5(md).alias("comment_md5"))


@query("x14_standalone_description", rf"""
select hash, 'Imported by workspace migration (no mapped test case on target).' || case when l_returnflag <> 'N' then e'\nSource case_id: ' || l_partkey else '' end ||
       e'\nSource result hash: ' || hash as description from {LINES}""")
def x14(spark, sf):
    return result_lines(spark, sf).select("hash", tx.standalone_description(
        F.when(F.col("l_returnflag") != "N", F.col("l_partkey")), "hash").alias("description"))


@query("x15_file_name", r"""
select page_id, coalesce(nullif(regexp_extract(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]+)$', 1), ''),
       'attachment_' || left(md5(url), 8) || '.bin') as name from pages""")
def x15(spark, sf):
    return t(spark, sf, "pages").select("page_id", tx.file_name("url", F.md5("url")).alias("name"))


@query("x16_truncate", """
select doc_id, md5(case when length(text) > 800 then left(text, 800) || '...<truncated ' || (length(text) - 800) || ' chars>' else text end) as long_md5,
       left(text, 60) as short from documents""")
def x16(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.md5(sh.truncate("text", 800, "...<truncated {left} chars>")).alias("long_md5"),
                                            sh.truncate("text", 60).alias("short"))


@query("x17_row_identity", f"""
select hash, case when l_returnflag = 'R' then 'sig-' || l_orderkey else coalesce(case when l_linestatus = 'F' then l_partkey::varchar end, 'none')
       || case when l_quantity > 25 then ':a=' || l_linenumber || '|b=' || l_returnflag else '' end || ':' || hash end as signature from {LINES}""")
def x17(spark, sf):
    params = F.when(F.col("l_quantity") > 25, sh.param_entries(F.parse_json(F.to_json(F.expr(
        "named_struct('b', l_returnflag, 'a', l_linenumber)")))))
    r = result_lines(spark, sf).withColumn("p", params)
    row_id, sig = tx.row_identity("hash", F.when(F.col("l_returnflag") == "R", F.expr("concat(' sig-', l_orderkey)")),
                                  F.when(F.col("l_linestatus") == "F", F.col("l_partkey")), F.col("p"))
    return r.select(row_id.alias("hash"), sig.alias("signature"))


# ------------------------------------------------------------------ nested members


@query("n01_tags", "select p_partkey, p_brand || '|' || p_type || '|' || p_size as tags from part")
def n01(spark, sf):
    tags = F.parse_json(F.expr("concat('[{\"title\":\"', p_brand, '\"},{\"title\":\"\",\"name\":\"', p_type, '\"},', p_size, ']')"))
    return t(spark, sf, "part").select("p_partkey", F.array_join(sh.tag_titles(tags), "|").alias("tags"))


@query("n02_flatten_step", """
select event_id, case when event_type = 'error' then 'run ' || event_id else 'own' end as comment, case when value > 10 then 'from data' else 'step' end as action,
       case when event_type = 'view' then '5' else '1' end as status_id from events""")
def n02(spark, sf):
    step = F.parse_json(F.to_json(F.expr(
        "named_struct('comment', 'own', 'status_id', 1, 'action', if(value > 10, '', 'step'), 'data', named_struct('action', 'from data'),"
        " 'execution', named_struct('action', 'never', 'comment', if(event_type = 'error', concat('run ', event_id), ' '), 'status_id', if(event_type = 'view', 5, null)))")))
    ev = t(spark, sf, "events").withColumn("s", ov.flat_step(step))
    return ev.select("event_id", ov.step_text(F.col("s"), ov.COMMENT).alias("comment"), ov.step_text(F.col("s"), ov.ACTION).alias("action"),
                     sh.as_text(ov.step_member(F.col("s"), "status_id")).alias("status_id"))


@query("n03_promote_execution", """
select event_id::varchar as hash, case when event_type = 'error' then 'own' else 'run' end as comment,
       case when event_type = 'view' then event_id + 1 else floor(value)::bigint end as ms from events""")
def n03(spark, sf):
    from ..plans.project import enrich_results
    rows = entity_of(t(spark, sf, "events"), "result", None, hash="cast(event_id as string)", comment="if(event_type = 'error', 'own', ' ')",
                     time_spent_ms="if(event_type = 'view', event_id + 1, 0)",
                     execution="named_struct('comment', 'run', 'duration_ms', floor(value))")
    no_cases = entity_of(t(spark, sf, "nation"), "case", "n_name", id="cast(n_nationkey as bigint)")
    out = enrich_results(rows, None, no_cases)
    return out.select("hash", "comment", sh.as_type("time_spent_ms", "bigint").alias("ms"))


@query("n04_first_steps", """
select event_id, case when event_type = 'error' then 0 when value > 10 then 3 else 1 end as n_steps from events""")
def n04(spark, sf):
    ev = t(spark, sf, "events").where("event_id is not null")
    v = [F.parse_json(F.lit("[]")), F.when(F.col("event_type") == "error", F.parse_json(F.lit('{"a":1}'))),
         F.when((F.col("value") > 10) & (F.col("event_type") != "error"), F.parse_json(F.lit("[1,2,3]"))),
         F.when(F.col("event_type") != "error", F.parse_json(F.lit("[1]")))]
    return ev.select("event_id", F.coalesce(F.size(sh.first_list(*v)), F.lit(0)).alias("n_steps"))


@query("n05_params", """
select p_partkey, case when p_size > 30 then 'brand=' || p_brand || '|size=' || p_size when p_size > 10 then 'n=' || p_name else 'c=' || p_type end as params from part""")
def n05(spark, sf):
    own = F.expr("if(p_size > 30, parse_json(to_json(named_struct('size', p_size, 'brand', p_brand))), parse_json('{}'))")
    listed = F.expr("if(p_size > 10, parse_json(to_json(array(named_struct('title', 'n', 'value', 'old'), named_struct('title', ' n', 'value', p_name), named_struct('title', '', 'value', 'x')))), null)")
    nested = F.expr("parse_json(to_json(array(named_struct('name', 'c', 'selected', p_type))))")
    return t(spark, sf, "part").select("p_partkey", sh.joined_entries(sh.first_params(own, listed, nested)).alias("params"))


@query("n06_param_groups", """
select p_partkey, p_name || ';' || p_brand || ',' || p_type || ';' || p_type as groups from part""")
def n06(spark, sf):
    raw = F.expr("parse_json(concat('[\"', p_name, '\",\" \",[\"', p_brand, '\",null,\"', p_type, '\"],{\"items\":[{\"title\":\"', p_type, '\"},{\"x\":1}]},[]]'))")
    joined = F.array_join(F.transform(sh.param_groups(raw), lambda g: F.array_join(g, ",")), ";")
    return t(spark, sf, "part").select("p_partkey", joined.alias("groups"))


@query("n07_shared_parameter_values", """
select p_partkey, p_name || '=' || p_brand || ',' || p_type || ';' || 'size=' || p_size as clean from part""")
def n07(spark, sf):
    raw = F.expr("parse_json(to_json(named_struct('l', array(named_struct('title', p_name, 'values', parse_json(to_json(array(p_brand, p_type)))),"
                 " named_struct('title', '', 'values', parse_json('[1]')), named_struct('title', 'none', 'values', parse_json('[]')),"
                 " named_struct('title', 'size', 'values', parse_json(cast(p_size as string)))))))")
    clean = sh.clean_parameters(F.try_variant_get(raw, "$.l", "variant"))
    out = F.array_join(F.transform(clean, lambda p: F.concat(p["title"], F.lit("="), F.array_join(p["values"], ","))), ";")
    return t(spark, sf, "part").select("p_partkey", out.alias("clean"))


@query("n08_shared_step_content", """
select p_partkey, case when p_size > 25 then p_name else 'No action' end || '>' || p_type || ';' || p_brand || '>' as steps from part""")
def n08(spark, sf):
    raw = F.parse_json(F.to_json(F.expr("array(named_struct('action', if(p_size > 25, concat(' ', p_name), ' '), 'expected', p_type), named_struct('action', p_brand, 'expected', ''))")))
    steps = sh.clean_shared_steps(raw)
    out = F.array_join(F.transform(steps, lambda s: F.concat(s["action"], F.lit(">"), F.coalesce(s["expected_result"], F.lit("")))), ";")
    return t(spark, sf, "part").select("p_partkey", out.alias("steps"))


@query("n10_cap_members", """
select doc_id, md5(case when length(text) > 300 then left(text, 300) || '...<truncated ' || (length(text) - 300) || ' chars>' else text end) as text_md5, '1' as cut_keys from documents""")
def n10(spark, sf):
    v = F.parse_json(F.to_json(F.expr("named_struct('a_text', text, 'b_lang', lang, 'c_source', source)")))
    m = sh.cap_members(v, max_keys=2, max_chars=300)
    return t(spark, sf, "documents").select("doc_id", F.md5(m["a_text"]).alias("text_md5"), m["_truncated_keys"].alias("cut_keys"))


@query("n10b_nested_caps", """
select p_partkey, case when p_size % 16 <= 12 then repeat('{"a":', p_size % 16) || '"' || p_name || '"' || repeat('}', p_size % 16)
  else repeat('{"a":', 13) || '"<max depth>"' || repeat('}', 13) end as capped from part""")
def n10b(spark, sf):
    text = F.expr("concat(repeat('{\"a\":', p_size % 16), '\"', p_name, '\"', repeat('}', p_size % 16))")
    return t(spark, sf, "part").select("p_partkey", sh.cap_nested(F.parse_json(text)).alias("capped"))


@query("n11_text_to_map", """select event_id, regexp_extract(props, '([0-9]+)', 1) as k from events""")
def n11(spark, sf):
    m = F.try_variant_get(F.parse_json("props"), "$", "map<string,string>")
    return t(spark, sf, "events").select("event_id", m["k"].alias("k"))


@query("n09_uuid_text", """
select c_custkey, left(md5(c_name), 8) || '-' || substr(md5(c_name), 9, 4) || '-' || substr(md5(c_name), 13, 4) as id, c_mktsegment as nested from customer""")
def n09(spark, sf):
    raw = F.parse_json(F.to_json(F.expr("named_struct('id', concat(left(md5(c_name), 8), '-', substr(md5(c_name), 9, 4), '-', substr(md5(c_name), 13, 4)), 'in', array(named_struct('s', c_mktsegment)))")))
    return t(spark, sf, "customer").select("c_custkey", sh.get(raw, "id").alias("id"), sh.get(raw, "in[0].s").alias("nested"))


@query("n12_response_hashes", """
select p_partkey, case when p_size > 30 then p_brand || ',-' when p_size > 20 then p_type || ',' || p_name when p_size > 10 then '-,-' else p_brand || ',-' end as hashes from part""")
def n12(spark, sf):
    body = F.expr("case when p_size > 30 then parse_json(concat('{\"status\":true,\"result\":{\"hash\":\"', p_brand, '\"}}'))"
                  " when p_size > 20 then parse_json(concat('{\"status\":true,\"result\":{\"entities\":[{\"hash\":\"', p_type, '\"},{\"hash\":\"', p_name, '\"},{\"hash\":\"z\"}]}}'))"
                  " when p_size > 10 then parse_json('{\"status\":false,\"result\":[{\"hash\":\"q\"}]}')"
                  " else parse_json(concat('{\"status\":true,\"result\":[{\"hash\":\"', p_brand, '\"},5]}')) end")
    return t(spark, sf, "part").select("p_partkey", F.array_join(sh.response_hashes(body, 2), ",", "-").alias("hashes"))


@query("n13_normal_keys", "select doc_id, md5(text) as key from documents")
def n13(spark, sf):
    k = F.expr("concat(' ', upper(left(md5(text), 8)), '-', substr(md5(text), 9))")
    return t(spark, sf, "documents").select("doc_id", tx.normal_key(k).alias("key"))
