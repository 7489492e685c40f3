"""Scans and sinks over landed pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..lineage import work_path
from ..operators import harvest
from ..operators.batching import payload_chunks
from ..operators.ranking import number_rows
from ..sinks import tables
from ..sources import entities as en, pages as pg, snapshots as sn
from .base import CASE_CW, LINES, case_cw, entity_of, linked_documents, page_per_row, query, result_lines, t, xw

EVENT = "event_id bigint, user_id bigint, event_type string, value double, props string"


def event_pages(spark, sf, rows=None):
    ev = t(spark, sf, "events") if rows is None else rows
    return pg.land(ev.withColumn("project_code", F.col("event_type")), "event", F.floor(F.col("event_id") / 100),
                   ["event_id", "user_id", "event_type", "value", "props"])


@query("s01_envelope_rows", "select event_id, user_id, event_type, value, props from events where event_type <> 'error'")
def s01(spark, sf):
    pages = event_pages(spark, sf)
    failed = F.regexp_replace("body", '"status":true', '"status":false')
    pages = pages.withColumn("body", F.when(F.col("project_code") == "error", failed)
                             .when(F.col("project_code") == "view", F.to_json(F.struct(
                                 F.lit(True).alias("status"),
                                 F.from_json(F.get_json_object("body", "$.result.entities"),
                                             "array<struct<event_id:bigint,user_id:bigint,event_type:string,value:double,props:string>>").alias("result"))))
                             .otherwise(F.col("body")))
    return pg.open_pages(pages, EVENT).select(F.inline("entities"))


@query("s02_projects", "select n_nationkey::bigint as id, n_name as code from nation where n_name in ('NATION_1', 'NATION_7', 'NATION_20')")
def s02(spark, sf):
    n = t(spark, sf, "nation")
    twice = n.unionByName(n.withColumn("n_nationkey", F.col("n_nationkey") + 100))
    pages = page_per_row(twice, "project", None, id="n_nationkey", code="n_name", title="n_name")
    return en.projects(pages, only=["NATION_1", "NATION_7", "NATION_20"]).select("id", "code")


@query("s03_users", """
select c_custkey as id, lower(c_name) || '@example.com' as email, c_acctbal > 0 as is_active, c_mktsegment as role
from customer where c_mktsegment <> 'MACHINERY'""")
def s03(spark, sf):
    pages = page_per_row(
        t(spark, sf, "customer"), "user", None, id="c_custkey", email="concat(lower(c_name), '@example.com')",
        name="c_name", is_active="c_acctbal > 0", role="c_mktsegment", uuid="md5(c_name)",
        type="if(c_mktsegment = 'MACHINERY', 'service', 'user')")
    return en.users(pages).select("id", "email", "is_active", "role")


@query("s04_authors", """
select md5(c_mktsegment || c_nationkey) as uuid, max(c_custkey) as id from customer where c_acctbal >= 0 group by 1""")
def s04(spark, sf):
    pages = page_per_row(t(spark, sf, "customer"), "author", None, id="c_custkey",
                         uuid="if(c_acctbal >= 0, md5(concat(c_mktsegment, c_nationkey)), null)")
    return en.authors(pages)


@query("s05_groups", """
select p_partkey::varchar as id, p_name as "displayName", (i - 1)::int as pos, string_split(p_name, ' ')[i] as member
from part, unnest(range(1, len(string_split(p_name, ' ')) + 1)) as u(i)""")
def s05(spark, sf):
    members = ("if(p_size > 25, parse_json(to_json(transform(split(p_name, ' '), x -> named_struct('value', x)))),"
               " parse_json(to_json(split(p_name, ' '))))")
    pages = page_per_row(t(spark, sf, "part"), "group", None, id="cast(p_partkey as string)", displayName="p_name",
                         members=members)
    return en.groups(pages).select("id", "displayName", F.posexplode("members").alias("pos", "member"))


@query("s06_custom_fields", """
select p_partkey as id, p_name as title, case when p_size > 25 then 'run' else '2' end as entity,
       lower(p_type) as type, p_size > 10 as is_required
from part""")
def s06(spark, sf):
    pages = page_per_row(
        t(spark, sf, "part"), "custom_field", None, id="p_partkey", title="p_name",
        entity="if(p_size > 25, parse_json('\"run\"'), parse_json('2'))", type="lower(p_type)",
        is_required="p_size > 10")
    from ..functions.shapes import as_text
    return en.custom_fields(pages).select("id", "title", as_text("entity").alias("entity"), as_text("type").alias("type"),
                                          "is_required")


@query("s07_shared_parameters", """
select md5(p_name || p_partkey) as id, p_name as title from part where p_brand = 'Brand#1' or p_type = 'ECONOMY' or p_size = 1""")
def s07(spark, sf):
    pages = page_per_row(t(spark, sf, "part"), "shared_parameter", None, id="md5(concat(p_name, p_partkey))", title="p_name",
                         is_enabled_for_all_projects="p_size = 1", project_codes="array(p_brand, p_type)")
    return en.shared_parameters(pages, ["Brand#1", "ECONOMY"]).select("id", "title")


@query("s08_milestones", """
select o_orderpriority as project_code, o_orderkey as id, o_orderpriority || ' ' || o_orderstatus as title,
       strftime(o_orderdate, '%Y-%m-%d') as due_date from orders""")
def s08(spark, sf):
    pages = page_per_row(t(spark, sf, "orders"), "milestone", "o_orderpriority", id="o_orderkey",
                         title="concat(o_orderpriority, ' ', o_orderstatus)", due_date="date_format(o_orderdate, 'yyyy-MM-dd')")
    return en.milestones(pages).select("project_code", "id", "title", "due_date")


def configuration_pages(spark, sf):
    words = "transform(split(p_name, ' '), (x, i) -> named_struct('id', p_partkey * 10 + i, 'title', x))"
    return page_per_row(
        t(spark, sf, "part"), "configuration_group", "p_brand", id="p_partkey", title="p_name",
        configs=f"if(p_size <= 20, {words}, null)", configurations=f"if(p_size > 20 and p_size <= 35, {words}, null)",
        entities=f"if(p_size > 35, {words}, null)")


CONFIGS = """(select p_brand as project_code, p_partkey as group_id, (i - 1)::int as pos, p_partkey * 10 + i - 1 as id,
       string_split(p_name, ' ')[i] as title from part, unnest(range(1, len(string_split(p_name, ' ')) + 1)) as u(i))"""


@query("s09_configurations", f"select * from {CONFIGS}")
def s09(spark, sf):
    return en.configurations(configuration_pages(spark, sf))[1]


@query("s10_environments", """
select 'NATION_' || s_nationkey as project_code, s_suppkey as id, s_name as title, lower(s_name) as slug,
       'https://' || s_suppkey || '.example' as host from supplier""")
def s10(spark, sf):
    pages = page_per_row(t(spark, sf, "supplier"), "environment", F.expr("concat('NATION_', s_nationkey)"), id="s_suppkey",
                         title="s_name", slug="lower(s_name)", host="concat('https://', s_suppkey, '.example')")
    return en.environments(pages).select("project_code", "id", "title", "slug", "host")


@query("s11_shared_steps", "select p_brand as project_code, md5(p_partkey::varchar) as hash, p_name as title from part where p_size > 2")
def s11(spark, sf):
    pages = page_per_row(t(spark, sf, "part"), "shared_step", "p_brand", title="p_name",
                         hash="if(p_size > 2, md5(cast(p_partkey as string)), null)")
    return en.shared_steps(pages).select("project_code", "hash", "title")


@query("s12_suites", """
select p_brand as project_code, p_partkey as id, case when p_partkey >= 3 then p_partkey // 3 end as parent_id, p_name as title from part""")
def s12(spark, sf):
    pages = page_per_row(t(spark, sf, "part"), "suite", "p_brand", id="p_partkey", title="p_name",
                         parent_id="if(p_partkey >= 3, p_partkey div 3, null)")
    return en.suites(pages).select("project_code", "id", "parent_id", "title")


@query("s13_cases", """
select p_brand as project_code, p_partkey as id,
       case when p_size <= 20 and p_retailprice > 950 then 'full ' || p_name else p_name end as title,
       case when p_size > 20 then 1 when p_retailprice > 950 then 2 else 0 end as n_steps
from part""")
def s13(spark, sf):
    from ..functions.shapes import items
    p = t(spark, sf, "part")
    pages = page_per_row(p, "case", "p_brand", id="p_partkey", title="p_name",
                         steps="if(p_size > 20, parse_json('[{\"action\":\"a\"}]'), null)")
    detail = entity_of(p.where("p_retailprice > 950"), "case", "p_brand", id="p_partkey", title="concat('full ', p_name)",
                       steps="parse_json('[{\"action\":\"a\"},{\"action\":\"b\"}]')")
    return en.cases(pages, detail).select("project_code", "id", "title", F.size(items("steps")).alias("n_steps"))


@query("s14_plans", """
select p_brand as project_code, p_partkey as id, p_name as title,
       case when p_retailprice > 950 then 'about ' || p_type else p_type end as description from part""")
def s14(spark, sf):
    p = t(spark, sf, "part")
    pages = page_per_row(p, "plan", "p_brand", id="p_partkey", title="p_name", description="p_type")
    detail = entity_of(p.where("p_retailprice > 950"), "plan", "p_brand", id="p_partkey", description="concat('about ', p_type)")
    return en.plans(pages, detail).select("project_code", "id", "title", "description")


RUN = {
    "id": "o_orderkey", "title": "concat('Run ', o_orderkey)", "user_id": "o_custkey",
    "start_time": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "status": "if(o_orderstatus = 'F', 'Finished', o_orderstatus)",
}


@query("s15_runs", """
select o_orderpriority as project_code, o_orderkey as id, 'Run ' || o_orderkey as title, o_custkey::varchar as user_id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as start_time from orders""")
def s15(spark, sf):
    from ..functions.shapes import as_text
    rows = en.runs(page_per_row(t(spark, sf, "orders"), "run", "o_orderpriority", **RUN))
    return rows.select("project_code", "id", "title", as_text("user_id").alias("user_id"), "start_time")


@query("s16_run_details", "select o_orderpriority as project_code, o_orderkey as id, 'Run ' || o_orderkey as title from orders")
def s16(spark, sf):
    o = t(spark, sf, "orders")
    late = F.to_date("o_orderdate") >= "1997-01-01"
    twice = page_per_row(o, "run", "o_orderpriority", **RUN).unionByName(
        page_per_row(o.where(late), "run", "o_orderpriority", **RUN))
    return en.run_details(twice).select("project_code", "id", "title")


@query("s17_run_case_links", f"""
with links as (
  select o_orderpriority as project_code, o_orderkey as run_id, pos, case_id from orders,
    unnest([{{'pos': 0, 'case_id': o_custkey}}, {{'pos': 1, 'case_id': o_custkey + 1}}, {{'pos': 2, 'case_id': o_custkey}}]) as u(x),
    lateral (select x.pos as pos, x.case_id as case_id) where o_orderstatus = 'P' and case_id <> 0
  union all
  select o_orderpriority, o_orderkey, l_linenumber, l_partkey from orders join lineitem on l_orderkey = o_orderkey
  where o_orderstatus <> 'P' and l_partkey <> 0)
select project_code, run_id, target_key::varchar as target_case from links join {CASE_CW} on case_id = source_key
group by all""")
def s17(spark, sf):
    o = t(spark, sf, "orders")
    listed = ("if(o_orderstatus = 'P', parse_json(concat('[', o_custkey, ',{\"id\":', o_custkey + 1, '},{\"case_id\":', o_custkey, '}]')),"
              " parse_json('[]'))")
    runs = entity_of(o, "run", "o_orderpriority", id="o_orderkey", cases=listed)
    tests = result_lines(spark, sf).select("project_code", F.col("l_orderkey").alias("run_id"),
                                           F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("case_id"))
    links = en.run_links(runs, tests)
    return en.mapped_run_links(links, case_cw(spark, sf), scope=None).select("project_code", "run_id", "target_case")


def result_pages(spark, sf):
    return page_per_row(result_lines(spark, sf), "result", "project_code", run_id="l_orderkey", hash="hash",
                        case_id="l_partkey", status="l_returnflag")


@query("s18_results", f"""
select project_code, l_orderkey as run_id, hash, l_partkey as case_id, l_returnflag as status from {LINES}""")
def s18(spark, sf):
    rows = en.results(result_pages(spark, sf))
    return rows.select("project_code", "run_id", "hash", F.try_variant_get("case_id", "$", "bigint").alias("case_id"), "status")


@query("s19_result_details", f"""
select project_code, hash, count(distinct l_orderkey)::bigint as n_runs from {LINES} group by all""")
def s19(spark, sf):
    rows = en.result_details(result_pages(spark, sf))
    return rows.groupBy("project_code", "hash").agg(F.count("*").alias("n_runs"))


@query("s20_defects", """
select o_orderpriority as project_code, o_orderkey as id, o_orderstatus as status, 'Order ' || o_orderkey as title from orders""")
def s20(spark, sf):
    from ..functions.shapes import as_text
    pages = page_per_row(t(spark, sf, "orders"), "defect", "o_orderpriority", id="o_orderkey", title="concat('Order ', o_orderkey)",
                         status="o_orderstatus")
    return en.defects(pages).select("project_code", "id", as_text("status").alias("status"), "title")


@query("s21_page_completeness", """
with landed as (select event_type, count(*) as landed, count(distinct event_id // 100) as n_pages
                from events where ts >= timestamp '2024-01-02' group by 1)
select 'event' as entity, event_type as project_code, coalesce(landed, 0) as landed, count(*) as declared,
       coalesce(n_pages, 0) as n_pages, 0 as n_bad, coalesce(landed, 0) >= count(*) as complete
from events left join landed using (event_type) group by event_type, landed, n_pages""")
def s21(spark, sf):
    ev = t(spark, sf, "events")
    kept = event_pages(spark, sf, ev.where("ts >= timestamp_ntz'2024-01-02'"))
    totals = ev.groupBy(F.col("event_type").alias("project_code")).agg(F.count("*").alias("_t"))
    declared = kept.join(totals, "project_code").withColumn("body", F.regexp_replace(
        "body", F.lit(r'"total":\d+'), F.concat(F.lit('"total":'), F.col("_t").cast("string"))))
    return pg.audit_pages(declared)


def damaged_pages(spark, sf):
    """Pages of 100 events each, by type: every 7th never landed, every 9th can't be read, every 11th landed twice (first unreadable), every
    5th delivers ten rows of the page before it once more."""
    ev = t(spark, sf, "events")
    ranked = number_rows(ev.select(F.col("event_type").alias("project_code"), "event_id"), ["project_code"], ["event_id"], "rn")
    page = ranked.withColumn("p", F.floor((F.col("rn") - 1) / 100)).groupBy("project_code", "p").agg(F.count("*").alias("n"))
    totals = ranked.groupBy("project_code").agg(F.count("*").alias("total"))
    page = page.join(totals, "project_code").where("p % 7 <> 3").withColumn("back", F.expr("if(p % 5 = 2, 10, 0)"))
    page = page.withColumn("good", F.expr(
        "concat('{\"status\":true,\"result\":{\"total\":', total, ',\"entities\":[', array_join(transform(sequence(1, n + back), i -> concat('{\"id\":', i, '}')), ','), ']}}')"))
    fetches = F.expr("case when p % 9 = 4 then array(named_struct('body', '<html>busy', 'fetched_at', 1)) when p % 11 = 6 then array("
                     "named_struct('body', '{\"status\":false}', 'fetched_at', 1), named_struct('body', good, 'fetched_at', 2)) "
                     "else array(named_struct('body', good, 'fetched_at', 1)) end")
    return page.select(F.lit("event").alias("entity"), "project_code", (F.col("p") * 100 - F.col("back")).alias("page_offset"), F.explode(fetches).alias("f")).select(
        "entity", "project_code", "page_offset", "f.*")


DAMAGED = """ranked as (select event_type, row_number() over (partition by event_type order by event_id) as rn from events),
page as (select *, p * 100 - back as start, sum(n) over (partition by event_type) as total from
  (select event_type, (rn - 1) // 100 as p, count(*) as n, case when (rn - 1) // 100 % 5 = 2 then 10 else 0 end as back from ranked group by all)),
landed as (select *, start + n + back as stop, p % 9 = 4 as bad from page where p % 7 <> 3),
cover as (select event_type, start, stop, coalesce(max(stop) over (partition by event_type order by start rows between unbounded preceding and 1 preceding), 0) as before
  from landed where not bad),
hole as (select event_type, before as a, start as b from cover where start > before
  union all select event_type, max(stop), max(total) from landed where not bad group by event_type having max(stop) < max(total)),
req as (select event_type, o, least(100, b - o) as n from (select *, unnest(range(a::bigint, b::bigint, 100)) as o from hole))"""


@query("s21b_refetch_list", f"""
with {DAMAGED}
select r.event_type as project_code, r.o::bigint as page_offset, r.n::bigint as n, case when l.start is null then 'never fetched' else 'unreadable' end as reason
from req r left join landed l on l.event_type = r.event_type and l.bad and l.start = r.o""")
def s21b(spark, sf):
    return pg.page_coverage(damaged_pages(spark, sf))["refetch"].select(F.col("scope").alias("project_code"), "page_offset", "n", "reason")


@query("s21c_page_coverage", f"""
with {DAMAGED}, missing as (select event_type, sum(n) as m from req group by 1), again as (select event_type, sum(least(before, stop) - start) as r from cover where start < before group by 1),
tot as (select event_type, count(*) as n_pages, max(total) filter (where not bad) as declared from landed group by 1)
select event_type as project_code, declared::bigint as declared, coalesce(m, 0)::bigint as n_missing, coalesce(r, 0)::bigint as n_repeated, n_pages::bigint as n_pages, coalesce(m, 0) = 0 as complete
from tot left join missing using (event_type) left join again using (event_type)""")
def s21c(spark, sf):
    out = pg.page_coverage(damaged_pages(spark, sf))["summary"]
    return out.select(F.col("scope").alias("project_code"), "declared", "n_missing", "n_repeated", "n_pages", "complete")


@query("s01b_page_rejects", f"""
with {DAMAGED} select event_type as project_code, 'page not parsable' as reason, count(*) as n from landed where bad group by 1
union all select event_type, 'page reports failure', count(*) from landed where not bad and p % 11 = 6 group by 1""")
def s01b(spark, sf):
    out = pg.page_rejects(damaged_pages(spark, sf))
    return out.groupBy(F.col("scope").alias("project_code"), "reason").agg(F.count("*").alias("n"))


@query("s22_crosswalk_load", """
select 'users' as entity, '*' as scope, c_custkey::varchar as source_key, (c_custkey + 100000)::varchar as target_key from customer
union all
select 'cases', 'NATION_' || c_nationkey, c_custkey::varchar, 'c' || c_custkey from customer""")
def s22(spark, sf):
    docs = t(spark, sf, "customer").select(F.expr(
        "concat('{\"users\":{\"', c_custkey, '\":', c_custkey + 100000, '},\"cases\":{\"NATION_', c_nationkey,"
        " '\":{\"', c_custkey, '\":\"c', c_custkey, '\"}}}')").alias("body"))
    return sn.bucket_rows(docs, "body")


TRACE_ROWS = ("event_type as event", "ts", "cast(user_id as string) as project_source", "event_id as source_run_id",
              "cast(value as int) as http_status")


@query("s23_trace_scan", """
select event_type as event, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, user_id::varchar as project_source,
       event_id as source_run_id, trunc(value)::int as http_status from events""")
def s23(spark, sf):
    path = work_path(spark, "trace")
    tables.append_trace(t(spark, sf, "events").selectExpr(*TRACE_ROWS), path)
    return sn.read_trace(spark, path).select("event", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "project_source",
                                             "source_run_id", "http_status")


@query("s24_existing_rows", """
select lower(trim(p_name)) as natural_key, max(p_partkey)::varchar as target_key from part group by 1""")
def s24(spark, sf):
    part = t(spark, sf, "part").withColumn("p_name", F.concat(F.lit(" "), F.initcap("p_name"), F.lit(" ")))
    return sn.existing_rows(part, "p_name", "p_partkey")


@query("s25_existing_attachments", "select md5(doc_id::varchar) as key from documents")
def s25(spark, sf):
    d = linked_documents(spark, sf)
    first = harvest.harvest_refs(d, "lang", [harvest.text_refs("text")], 0, "doc_id")
    second = harvest.harvest_refs(d, "source", [harvest.text_refs("text")], 2, "doc_id")
    return sn.existing_keys(first, second)


def nation_cw(spark, sf):
    return xw(t(spark, sf, "customer"), "case", "c_custkey", "c_custkey + 1", "concat('N', c_nationkey)")


@query("k01_crosswalk_save", """
select 'case' as entity, 'N' || c_nationkey as scope, c_custkey::varchar as source_key, (c_custkey + 1)::varchar as target_key from customer""")
def k01(spark, sf):
    path = work_path(spark, "crosswalk")
    tables.save_crosswalk(nation_cw(spark, sf), path)
    return sn.read_crosswalk(spark, path).select("entity", "scope", "source_key", "target_key")


@query("k02_replace_scope", """
select 'N' || c_nationkey as scope, c_custkey::varchar as source_key,
       case when c_nationkey = 3 then 'new' || c_custkey else (c_custkey + 1)::varchar end as target_key
from customer where c_nationkey <> 3 or c_acctbal > 0""")
def k02(spark, sf):
    path = work_path(spark, "crosswalk")
    tables.save_crosswalk(nation_cw(spark, sf), path)
    worker = xw(t(spark, sf, "customer").where("c_acctbal > 0"), "case", "c_custkey", "concat('new', c_custkey)",
                "concat('N', c_nationkey)")
    tables.replace_scope(worker, path, "N3")
    return sn.read_crosswalk(spark, path).select("scope", "source_key", "target_key")


@query("k03_payload_chunks", """
with r as (select p_brand, p_partkey, p_name, (row_number() over (partition by p_brand order by p_partkey) - 1) // 20 as chunk from part)
select p_brand, chunk::bigint as chunk, count(*) as n_rows, string_agg(p_partkey::varchar, ',' order by p_partkey) as ids,
       string_agg(p_name, ',' order by p_partkey) as names
from r group by 1, 2""")
def k03(spark, sf):
    out = payload_chunks(t(spark, sf, "part"), ["p_brand"], ["p_partkey"], 20, ["p_partkey", "p_name"])
    body = F.from_json("payload", "array<struct<p_partkey:bigint,p_name:string>>")
    return out.select("p_brand", "chunk", "n_rows", F.array_join(body["p_partkey"].cast("array<string>"), ",").alias("ids"),
                      F.array_join(body["p_name"], ",").alias("names"))


@query("k04_trace_append", "select event_type as event, 2 * count(*) as n from events group by 1")
def k04(spark, sf):
    path = work_path(spark, "trace")
    rows = t(spark, sf, "events").selectExpr(*TRACE_ROWS)
    tables.append_trace(rows, path)
    tables.append_trace(rows, path)
    return sn.read_trace(spark, path).groupBy("event").agg(F.count("*").alias("n"))


@query("k05_payload_columns", """
select p_brand as project_code, p_partkey as id, p_name as title, p_type as description, '' as preconditions,
       case when p_partkey >= 3 then p_partkey // 3 end as parent_id from part""")
def k05(spark, sf):
    rows = t(spark, sf, "part").selectExpr(
        "p_brand as project_code", "p_partkey as id", "p_name as title", "p_type as description", "'' as preconditions",
        "if(p_partkey >= 3, p_partkey div 3, null) as parent_id", "p_size as extra")
    return tables.payload(rows, "suite", ["project_code", "id"])
