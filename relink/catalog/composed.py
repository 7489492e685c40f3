"""Whole-entity plans and the audits built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as pr, shapes as sh
from ..lineage import cut
from ..operators import audit as au, harvest as hv
from ..plans import project as pj, whole, workspace as ws
from ..sources import entities as en
from .base import (
    LINES, NEW_WS, OLD_WS, USER_CW, crosswalk_of, entity_of, linked_documents, query, result_lines, t, user_cw,
    xw,
)
from .lookups import RECONCILE, USERS, planned_users, reconciled
from .ordered import TREE, WALK, tree
from .scans import CONFIGS, configuration_pages


@query("e01_projects", """
select n_name as source_code, n_name as target_code, case when n_regionkey > 1 then 'matched' else 'to_create' end as outcome
from nation where n_name <> 'NATION_3'""")
def e01(spark, sf):
    n = t(spark, sf, "nation")
    source = entity_of(n, "project", None, id="n_nationkey", code="n_name", title="n_name")
    target = n.where("n_regionkey > 1").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("code"))
    return ws.projects(source, target, skip=["NATION_3"])["projects"]


@query("e02_users", f"""
select c_custkey as source_id, email, 'Customer' as first_name, substr(c_name, 10) as last_name, 'Member' as role, true as is_active
from {USERS} join customer using (c_custkey) where outcome = 'to_create'""")
def e02(spark, sf):
    c = t(spark, sf, "customer")
    named = c.withColumn("c_name", F.replace("c_name", F.lit("#"), F.lit(" ")))
    source = entity_of(named, "user", None, id="c_custkey", email="if(c_mktsegment = 'MACHINERY', '', concat(c_mktsegment, '.', c_nationkey, '@x.example'))",
                       name="c_name", is_active="c_acctbal > 0", role="''")
    target = c.where("c_mktsegment = 'BUILDING'").select((F.col("c_custkey") + 100000).alias("id"),
                                                         F.lower(F.expr("concat(c_mktsegment, '.', c_nationkey, '@x.example')")).alias("email"))
    return ws.users(source, target)["payload"]


@query("e02b_user_crosswalk", f"select c_custkey::varchar as source_key, target_key from {USERS} where target_key is not null")
def e02b(spark, sf):
    return planned_users(spark, sf)["crosswalk"].select("source_key", "target_key")


GROUP_NAME = "p_name || ' ' || p_type || ' ' || p_size"


@query("e03_group_members", f"""
with s as (select p_partkey::varchar as id, lower({GROUP_NAME}) as nk, p_partkey, p_size from part),
  tg as (select nk, max(id) as tid from s where p_size > 25 group by 1), f as (select nk, min(id) as cf from s group by 1),
  m as (select id, nk, 0 as pos, p_partkey as member from s union all select id, nk, 1, p_size from s)
select m.id as group_id, coalesce('g' || tid, 'new:' || cf) as target_group, pos, target_key::varchar as target_user
from m left join tg using (nk) left join f using (nk) join {USER_CW} on member = source_key""")
def e03(spark, sf):
    p = t(spark, sf, "part").withColumn("gname", F.expr("concat(p_name, ' ', p_type, ' ', p_size)"))
    pages_like = entity_of(p, "group", None, id="cast(p_partkey as string)", displayName="initcap(gname)",
                           members="parse_json(concat('[{\"value\":', p_partkey, '},', p_size, ',\"abc-1\"]'))")
    source = pages_like.withColumn("members", sh.member_keys("members"))
    target = p.where("p_size > 25").select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("id"), F.upper("gname").alias("displayName"))
    return ws.groups(source, target, user_cw(spark, sf))["members"].select("group_id", "target_group", "pos", "target_user")


@query("e04_custom_fields", """
select min(p_partkey) as source_id, case when min(p_partkey) is null then 0 else 2 end as entity, 3 as type,
       p_brand || '|' || p_type || '|' || p_brand || ' (1)' as options
from part where p_size <= 25 and not exists (select 1 from part q where q.p_size > 25 and q.p_brand = part.p_brand and q.p_type = part.p_type and q.p_retailprice > 1000)
group by p_brand, p_type""")
def e04(spark, sf):
    p = t(spark, sf, "part").withColumn("title", F.expr("concat(p_brand, ' ', p_type)"))
    source = entity_of(p.where("p_size <= 25"), "custom_field", None, id="p_partkey", title="title", entity="'Defect'", type="'SelectBox'",
                       value="parse_json(concat('[{\"title\":\"', p_brand, '\"},\"', p_type, '\",{\"value\":\"', p_brand, '\"}]'))")
    target = p.where("p_size > 25 and p_retailprice > 1000").select(F.col("p_partkey").alias("id"), F.upper(F.concat("title", F.lit(" "))).alias("title"))
    out = ws.custom_fields(source, target)["payload"]
    return out.select("source_id", "entity", "type", F.array_join("value.title", "|").alias("options"))


@query("e05_shared_parameters", """
select min(id) as source_id, arg_min(p_brand, id) as first_value, 'Brand#1' as project_codes
from (select *, md5(p_partkey::varchar) as id from part where p_retailprice > 950 and p_type <> 'SMALL') group by p_name, p_size
having not bool_or(false) and (p_name, p_size) not in (select (p_name, p_size) from part where p_size > 40)""")
def e05(spark, sf):
    p = t(spark, sf, "part").withColumn("title", F.expr("concat(p_name, ' ', p_size)")).withColumn("id", F.md5(F.col("p_partkey").cast("string")))
    source = entity_of(p, "shared_parameter", None, id="id", title="title", type="'single'", project_codes="array('Brand#1')",
                       parameters="if(p_type <> 'SMALL', parse_json(to_json(array(named_struct('title', p_name, 'values', array(p_brand))))), parse_json('[]'))")
    done = xw(p.where("p_retailprice <= 950"), "shared_parameter", "id", "concat('x', id)")
    target = p.where("p_size > 40").select("id", F.upper("title").alias("title"))
    out = ws.shared_parameters(source, target, done)["payload"]
    return out.select("source_id", F.col("parameters")[0]["values"][0].alias("first_value"), F.array_join("project_codes", ",").alias("project_codes"))


E06 = """(with k as (select md5(doc_id::varchar) as key, source as scope, lang, text from documents),
  o as (select key, min(substr(scope, 4)::int) as ordinal from k group by 1)
 select k.key, 'T' || ordinal as target_code, lang, ordinal from k join o using (key))"""


def attachment_plan(spark, sf):
    d = linked_documents(spark, sf)
    refs = hv.all_refs(hv.harvest_refs(d, "source", [hv.text_refs("text")], 0, "doc_id"),
                       hv.harvest_refs(d, "source", [hv.text_refs("text")], 2, "doc_id"))
    order = d.select(F.col("source").alias("scope")).distinct().select(
        "scope", F.expr("cast(substr(scope, 4) as int)").alias("ordinal"), F.expr("concat('T', substr(scope, 4))").alias("target_code"))
    key = F.md5(F.col("doc_id").cast("string")).alias("key")
    done = xw(d.where("lang = 'en'"), "attachment", "md5(cast(doc_id as string))", "md5(concat('t', doc_id))", "source")
    return ws.attachments(refs, d.where("lang = 'es'").select(key), done, order, d.select(key, F.lit(100).cast("bigint").alias("n_bytes")))


@query("e06_attachment_plan", f"""
select key, target_code, (row_number() over (partition by target_code order by key) - 1) // 20 as batch
from {E06} where lang not in ('en', 'es')""")
def e06(spark, sf):
    return attachment_plan(spark, sf)["payload"].select("key", "target_code", "batch")


@query("e06b_attachment_maps", """
select source as scope, md5(doc_id::varchar) as source_key, case when lang = 'en' then md5('t' || doc_id) else md5(doc_id::varchar) end as target_key
from documents where lang in ('en', 'es')""")
def e06b(spark, sf):
    return attachment_plan(spark, sf)["crosswalk"].select("scope", "source_key", "target_key")


@query("e07_milestones", f"""
with {WALK} select t.id as source_id, coalesce(t.p_name, '') as title, 'active' as status, '2024-05-0' || least(depth + 1, 9) as due_date, depth
from {TREE} t join walk using (id)""")
def e07(spark, sf):
    rows = entity_of(tree(spark, sf), "milestone", None, id="id", parent_id="parent_id", title="p_name", due_date="'2024-05-01T00:00:00'")
    out = pj.milestones(rows)["payload"]
    return out.select("source_id", "title", "status", F.concat(F.left("due_date", F.lit(9)), F.least(F.col("depth") + 1, F.lit(9)).cast("string")).alias("due_date"), "depth")


@query("e08_configurations", f"""
select project_code, group_id, id as source_id, title from {CONFIGS} where title <> 'red' and id not in (select p_partkey * 10 from part where p_size > 30)""")
def e08(spark, sf):
    groups, nested = en.configurations(configuration_pages(spark, sf))
    nested = nested.withColumn("title", F.when(F.col("title") != "red", F.col("title")))
    done = xw(t(spark, sf, "part").where("p_size > 30"), "configuration", "p_partkey * 10", "p_partkey", "p_brand")
    return pj.configurations(groups, nested, done)["payload"]


@query("e09_environments", """
select 'N' || s_nationkey as project_code, s_suppkey as source_id, s_name as title, case when s_acctbal > 0 then lower(s_name) else '' end as slug,
       '' as host, case when s_acctbal > 100 then 'd' end as description from supplier where s_acctbal <= 5000 and s_suppkey <> 1""")
def e09(spark, sf):
    s = t(spark, sf, "supplier").withColumn("project", F.expr("concat('N', s_nationkey)"))
    rows = entity_of(s, "environment", "project", id="s_suppkey", title="if(s_suppkey = 1, '', s_name)", slug="if(s_acctbal > 0, lower(s_name), null)",
                     description="if(s_acctbal > 100, 'd', '')")
    return pj.environments(rows, xw(s.where("s_acctbal > 5000"), "environment", "s_suppkey", "s_suppkey", "project"))["payload"]


@query("e10_shared_steps", """
select p_brand as project_code, md5(p_partkey::varchar) as source_hash, p_name as title, 'No action>' || p_type as steps from part where p_size > 2""")
def e10(spark, sf):
    rows = entity_of(t(spark, sf, "part"), "shared_step", "p_brand", hash="if(p_size > 2, md5(cast(p_partkey as string)), null)", title="p_name",
                     steps="array(named_struct('action', '  ', 'expected', p_type))")
    out = pj.shared_steps(rows)["payload"]
    return out.select("project_code", "source_hash", "title", F.array_join(F.transform("steps", lambda s: F.concat(s["action"], F.lit(">"), s["expected_result"])), ";").alias("steps"))


@query("e11_suites", f"""
with {WALK} select t.id as source_id, case when t.id % 2 = 0 then t.p_name else 'Suite ' || t.id end as title, t.parent_id, p.p_partkey + 7 as parent_target, depth,
  array_to_string(path, '/') as path from {TREE} t join walk using (id) left join part p on p.p_partkey = t.parent_id and p.p_size > 5""")
def e11(spark, sf):
    rows = entity_of(tree(spark, sf), "suite", None, id="id", parent_id="parent_id", title="if(id % 2 = 0, p_name, '')")
    cw = xw(t(spark, sf, "part").where("p_size > 5"), "suite", "p_partkey", "p_partkey + 7")
    out = pj.suites(rows, cw)["payload"]
    return out.select("source_id", "title", "parent_id", F.col("parent_target").cast("bigint").alias("parent_target"), "depth",
                      F.array_join(F.col("order_path").cast("array<string>"), "/").alias("path"))


def sent_suites(spark, sf):
    rows = entity_of(tree(spark, sf), "suite", None, id="id", parent_id="parent_id", title="p_name")
    known = xw(t(spark, sf, "part").where("p_size > 45"), "suite", "p_partkey", "p_partkey + 7")

    def send(wave):  # the other side refuses a quarter of the second level, and never answers for some others
        refused = F.expr("(wave = 1 and id % 4 = 0) or id % 101 = 0")
        return wave.withColumn("target_key", F.when(~refused, F.concat(F.lit("s"), F.col("id").cast("string")))).where("id % 101 <> 0")

    return pj.suite_waves(rows, known, send)


WAVES = f"""known as (select p_partkey from part where p_size > 45),
n as (select t.*, k.p_partkey is not null as is_known from {TREE} t left join known k on k.p_partkey = t.id),
loaded as (select id, 0 as depth, null::varchar as parent_target, case when is_known then 'resumed' when id % 101 = 0 then 'not created' else 'sent' end as outcome,
    case when is_known then (id + 7)::varchar when id % 101 <> 0 then 's' || id end as target from n where parent_id is null
  union all select c.id, p.depth + 1, p.target,
    case when c.is_known then 'resumed' when p.target is null then 'an ancestor was not created' when (p.depth = 0 and c.id % 4 = 0) or c.id % 101 = 0 then 'not created' else 'sent' end,
    case when c.is_known then (c.id + 7)::varchar when p.target is null or (p.depth = 0 and c.id % 4 = 0) or c.id % 101 = 0 then null else 's' || c.id end
  from n c join loaded p on c.parent_id = p.id)"""


@query("e11b_suite_waves", f"""
with recursive {WAVES}
select id, outcome, case when outcome in ('sent', 'not created') then depth end as wave, case when outcome in ('sent', 'not created') then parent_target end as parent_target from loaded
union all select id, 'parent never reached', null, null from n where id not in (select id from loaded)""")
def e11b(spark, sf):
    plan = sent_suites(spark, sf)
    gone = plan["rejects"].select(F.col("source_key").cast("int").alias("id"), "reason")
    sent = plan["payload"].select("id", F.lit("sent").alias("outcome"), "wave", "parent_target").join(gone, "id", "left")
    sent = sent.select("id", F.coalesce("reason", "outcome").alias("outcome"), "wave", "parent_target")
    never = gone.join(plan["payload"].select("id"), "id", "left_anti").withColumnRenamed("reason", "outcome")
    known = plan["resumed"].select("id", F.lit("resumed").alias("outcome"))
    return sent.unionByName(never, allowMissingColumns=True).unionByName(known, allowMissingColumns=True)


@query("e11c_suite_waves_crosswalk", f"""
with recursive {WAVES} select id::varchar as source_key, target as target_key from loaded where target is not null
union all select id::varchar, (id + 7)::varchar from n where is_known and id not in (select id from loaded)""")
def e11c(spark, sf):
    return sent_suites(spark, sf)["crosswalk"].select("source_key", "target_key")


def case_rows(spark, sf):
    step = ("array(named_struct('action', concat('do /attachment/', md5(p_name), '/'), 'shared', null, 'attachments', array(md5(p_name))),"
            " named_struct('action', null, 'shared', p_type, 'attachments', null), named_struct('action', p_name, 'shared', null, 'attachments', null))")
    return entity_of(
        t(spark, sf, "part"), "case", "p_brand", id="p_partkey", suite_id="p_size", milestone_id="if(p_type <> 'SMALL', p_size, null)", title="p_name",
        description="concat('see ![x](https://h/public/team/', '" + OLD_WS + "', '/attachment/', md5(p_name), '/f.png) end')",
        severity="if(p_size > 25, p_size, null)", member_id="if(p_type = 'LARGE', 'abc', cast(p_partkey as string))", tags="array(p_brand, p_type)",
        attachments="array(named_struct('hash', upper(md5(p_name))))", custom_field="map(p_type, concat('v /attachment/', md5(p_name), '/'), 'none', 'x')",
        steps=step, created_at="'2024-01-01 00:00:00'")


def case_crosswalk(spark, sf):
    p = t(spark, sf, "part")
    sizes = p.select("p_brand", "p_size").distinct()
    types = p.select("p_brand", "p_type").distinct()
    names = p.select("p_brand", "p_name").distinct()
    return crosswalk_of(
        user_cw(spark, sf), xw(sizes.where("p_size > 10"), "suite", "p_size", "p_size + 1000", "p_brand"),
        xw(sizes.where("p_size > 15"), "milestone", "p_size", "p_size + 2000", "p_brand"),
        xw(types.where("p_type <> 'SMALL'"), "shared_step", "p_type", "md5(p_type)", "p_brand"),
        xw(p.select("p_type").distinct().where("p_type <> 'ECONOMY'"), "custom_field", "p_type", "concat('T', p_type)"),
        xw(names.where("p_name not like '%e%'"), "attachment", "md5(p_name)", "md5(concat('t', p_name))", "p_brand"))


CASES = f"""(with b as (select *, p_name not like '%e%' as hit, md5(p_name) as k, md5('t' || p_name) as tk from part left join {USER_CW} on p_partkey = source_key)
select p_brand as project_code, p_partkey as source_id, p_partkey as id, p_name as title, case when p_size > 10 then (p_size + 1000)::varchar end as suite_id,
  case when p_type <> 'SMALL' and p_size > 15 then (p_size + 2000)::varchar end as milestone_id,
  case when p_type = 'LARGE' or p_partkey = 0 then 1 else coalesce(target_key, 1) end as author_id,
  'see ![x](https://h/public/team/' || case when hit then '{NEW_WS}' else '{OLD_WS}' end || '/attachment/' || case when hit then tk else k end || '/f.png) end' as description,
  case when p_size > 25 then p_size else 2 end as severity, p_brand || '|' || p_type as tags, case when hit then tk else '' end as attachments,
  case when p_type <> 'ECONOMY' then 'T' || p_type || '=v /attachment/' || case when hit then tk else k end || '/' else '' end as custom_field,
  'do /attachment/' || case when hit then tk else k end || '/@1' || case when p_type <> 'SMALL' then ';' || md5(p_type) else '' end || ';' || p_name || '@' ||
    case when p_type <> 'SMALL' then 3 else 2 end as steps,
  (row_number() over (partition by p_brand order by p_partkey) - 1) // 20 as chunk from b)"""


@query("e12_cases", f"select * from {CASES}")
def e12(spark, sf):
    out = pj.cases(case_rows(spark, sf), case_crosswalk(spark, sf), new_workspace=NEW_WS)["payload"]
    steps = F.transform("steps", lambda s: F.coalesce(s["shared"], F.concat(s["action"], F.lit("@"), s["position"].cast("string"))))
    custom = F.transform("custom_field", lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select("project_code", "source_id", "id", "title", "suite_id", "milestone_id", "author_id", "description", "severity",
                      F.array_join("tags", "|").alias("tags"), F.array_join("attachments", "|").alias("attachments"),
                      F.array_join(custom, ";").alias("custom_field"), F.array_join(steps, ";").alias("steps"), "chunk")


@query("e12b_cases_at_root", """
select 'case' as entity, p_brand as scope, p_partkey::varchar as source_key, 'suite unknown, created at root' as reason from part where p_size <= 10""")
def e12b(spark, sf):
    return pj.cases(case_rows(spark, sf), case_crosswalk(spark, sf))["at_root"]


def plan_rows(spark, sf):
    return entity_of(t(spark, sf, "orders"), "plan", "o_orderpriority", id="o_orderkey", title="if(o_orderstatus = 'P', '', 'Plan')", description="o_orderstatus",
                     cases="parse_json(concat('[{\"case_id\":', o_custkey, '},{\"case_id\":', o_custkey + 1, '}]'))")


def project_case_cw(spark, sf):
    """Case crosswalk per project: every case a project's results refer to, if the case has a target."""
    p = t(spark, sf, "part").where("p_size > 5").select("p_partkey")
    used = result_lines(spark, sf).select("project_code", "l_partkey").distinct()
    return xw(used.join(p, F.col("l_partkey") == F.col("p_partkey"), "left_semi"), "case", "l_partkey", "l_partkey + 500000", "project_code")


PROJECT_CASES = f"(select distinct project_code, l_partkey as case_id, (l_partkey + 500000)::varchar as target_case from {LINES} join part on p_partkey = l_partkey where p_size > 5)"
PLAN_LINKS = f"""(select o_orderpriority as project_code, o_orderkey as plan_id, pos, o_custkey + pos as case_id, target_case
 from orders, (values (0), (1)) v(pos), {PROJECT_CASES} c where o_orderstatus <> 'P' and c.project_code = o_orderpriority and c.case_id = o_custkey + pos and o_custkey + pos <> 0
 and o_totalprice <= 400000)"""


def planned_plans(spark, sf):
    done = xw(t(spark, sf, "orders").where("o_totalprice > 400000"), "plan", "o_orderkey", "o_orderkey", "o_orderpriority")
    return pj.plans(plan_rows(spark, sf), crosswalk_of(project_case_cw(spark, sf), done))


@query("e13_plans", f"""
select o_orderpriority as project_code, o_orderkey as source_id, 'Plan' as title, o_orderstatus as description
from orders where (o_orderpriority, o_orderkey) in (select (project_code, plan_id) from {PLAN_LINKS})""")
def e13(spark, sf):
    return planned_plans(spark, sf)["payload"]


@query("e13b_plan_links", f"select project_code, plan_id, case_id, target_case from {PLAN_LINKS}")
def e13b(spark, sf):
    return planned_plans(spark, sf)["links"].select("project_code", "plan_id", "case_id", "target_case")


def milestone_rows(spark, sf):
    per = t(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.max("o_orderkey").alias("id"))
    return entity_of(per, "milestone", "o_orderpriority", id="id", title="concat('M ', o_orderstatus)")


def run_rows(spark, sf):
    return entity_of(
        t(spark, sf, "orders"), "run", "o_orderpriority", id="o_orderkey", title="concat('Run ', o_orderkey)", user_id="o_custkey",
        start_time="date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss+00:00\")", end_time="if(o_orderstatus = 'F', '2024-01-01', null)",
        milestone="if(o_orderstatus = 'F', named_struct('title', 'M F'), null)", milestone_id="o_orderkey", plan_id="if(o_orderstatus = 'O', o_custkey, null)",
        environment_id="o_custkey", configurations="parse_json(concat('[', o_custkey, ',{\"id\":', o_custkey + 1, '}]'))")


def run_crosswalk(spark, sf):
    o = t(spark, sf, "orders")
    seen = o.where("o_totalprice > 250000").select("o_orderpriority", "o_custkey").distinct()
    ms = milestone_rows(spark, sf)
    return crosswalk_of(
        user_cw(spark, sf), project_case_cw(spark, sf), xw(ms, "milestone", "id", "concat('m', id)", "project_code"),
        *[xw(seen, e, "o_custkey", f"concat('{e[0]}', o_custkey)", "o_orderpriority") for e in ("configuration", "environment", "plan")])


def run_links(spark, sf):
    return result_lines(spark, sf).select("project_code", F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("pos"),
                                          F.col("l_partkey").alias("case_id"))


def planned_runs(spark, sf):
    return pj.runs(run_rows(spark, sf), run_links(spark, sf), milestone_rows(spark, sf), run_crosswalk(spark, sf))


RUN_SQL = f"""with seen as (select distinct o_orderpriority, o_custkey from orders where o_totalprice > 250000),
ms as (select o_orderpriority, o_orderstatus, max(o_orderkey) as id from orders group by all)
select o.o_orderpriority as project_code, o.o_orderkey as source_id, 'Run ' || o.o_orderkey as title, case when o.o_custkey = 0 then 1 else coalesce(target_key, 1) end as author_id,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as start_time, case when o.o_orderstatus = 'F' then '2024-01-01 00:00:00' end as end_time,
  concat_ws('|', case when a.o_custkey <> 0 then 'c' || a.o_custkey end, 'c' || b.o_custkey) as configurations,
  'm' || case when o.o_orderstatus = 'F' then mf.id else md.id end as milestone_id, 'e' || a.o_custkey as environment_id,
  case when o.o_orderstatus = 'O' then 'p' || a.o_custkey end as mapped_plan_id, o.o_orderstatus = 'F' as finished
from orders o left join {USER_CW} on o.o_custkey = source_key left join seen a on a.o_orderpriority = o.o_orderpriority and a.o_custkey = o.o_custkey
left join seen b on b.o_orderpriority = o.o_orderpriority and b.o_custkey = o.o_custkey + 1
left join ms mf on mf.o_orderpriority = o.o_orderpriority and mf.o_orderstatus = 'F' left join ms md on md.o_orderpriority = o.o_orderpriority and md.id = o.o_orderkey"""


@query("e14_runs", RUN_SQL)
def e14(spark, sf):
    out = planned_runs(spark, sf)["payload"]
    return out.select("project_code", "source_id", "title", "author_id", "start_time", "end_time",
                      F.array_join("configurations", "|").alias("configurations"), "milestone_id", "environment_id", "mapped_plan_id", "finished")


@query("e14b_run_links", f"""
select project_code, l_orderkey as run_id, target_case, min(l_linenumber) as pos from {LINES} join {PROJECT_CASES} c using (project_code)
where l_partkey = c.case_id group by all""")
def e14b(spark, sf):
    return planned_runs(spark, sf)["links"].select("project_code", "run_id", "target_case", "pos")


def source_results(spark, sf):
    """(results, details, cases) of line items; some rows have no steps, some texts come from details."""
    lines = result_lines(spark, sf)
    url = "concat('![s](https://h/public/team/" + OLD_WS + "/attachment/', md5(cast(l_partkey as string)), '/s.png)')"
    rows = entity_of(
        lines, "result", "project_code", run_id="l_orderkey", hash="hash", case_id="l_partkey", status_id="l_linenumber", status="l_returnflag",
        comment=f"if(l_returnflag = 'A', {url}, null)", member_id="o_custkey", time="if(l_quantity > 25, cast(l_quantity as int), null)",
        attachments="array(named_struct('hash', md5(cast(l_partkey as string))))", params="named_struct('n', l_linenumber)",
        steps="if(l_returnflag <> 'N', array(named_struct('action', '.', 'status', parse_json('2'), 'comment', l_linestatus), named_struct('action', 'own', 'status', parse_json('\"skip\"'), 'comment', cast(null as string))), null)")
    details = entity_of(lines.where("l_returnflag = 'R'"), "result", "project_code", hash="hash", comment="concat('detail ', l_linenumber)",
                        execution="named_struct('stacktrace', concat('at ', l_suppkey))")
    p = t(spark, sf, "part")
    used = lines.select("project_code", "l_partkey").distinct().join(p.where("p_size > 3"), F.col("l_partkey") == F.col("p_partkey"))
    cases = entity_of(used, "case", "project_code", id="p_partkey", title="p_name", suite_title="concat(p_brand, '\\n', p_type)",
                      steps="array(named_struct('action', p_name, 'expected_result', p_type, 'steps', array(named_struct('action', 'inner'))))")
    return rows, details, cases


def result_crosswalk(spark, sf):
    used = result_lines(spark, sf).select("project_code", "l_partkey").distinct()
    keys = used.join(t(spark, sf, "part").where("p_name not like '%e%'"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    return crosswalk_of(user_cw(spark, sf), project_case_cw(spark, sf),
                        xw(keys, "attachment", "md5(cast(l_partkey as string))", "md5(concat('t', l_partkey))", "project_code"))


RESULTS = f"""(with b as (select *, p_name not like '%e%' as hit, md5(l_partkey::varchar) as k, md5('t' || l_partkey) as tk, p_size > 5 as mapped from {LINES} join part on p_partkey = l_partkey
  left join {USER_CW} on o_custkey = source_key)
select project_code, l_orderkey as run_id, hash, case when mapped then l_partkey + 500000 end as target_case_id, 'Automated Test ' || l_partkey as title,
  case l_linenumber when 1 then 'passed' when 2 then 'blocked' when 3 then 'skipped' when 4 then 'blocked' when 5 then 'failed' else 'skipped' end as status,
  case when l_quantity > 25 then l_quantity::bigint * 1000 end as duration_ms, case when l_returnflag = 'R' then 'at ' || l_suppkey end as stacktrace,
  case l_returnflag when 'A' then '![s](https://h/public/team/' || case when hit then '{NEW_WS}' else '{OLD_WS}' end || '/attachment/' || case when hit then tk else k end || '/s.png)'
    when 'R' then 'detail ' || l_linenumber end as message, case when hit then tk else '' end as attachments, 'n=' || l_linenumber as params,
  case when mapped then (l_partkey + 500000)::varchar else 'none' end || ':n=' || l_linenumber || ':' || hash as signature,
  case when p_size > 3 then p_brand || '/' || p_type end as suite_path,
  case when not mapped then case when o_custkey = 0 then '1' else coalesce(target_key::varchar, '1') end end as author, (row_number() over (partition by project_code, l_orderkey order by hash) - 1) // 500 as chunk from b)"""


@query("e15_results", f"select * from {RESULTS}")
def e15(spark, sf):
    rows, details, cases = source_results(spark, sf)
    out = pj.results(rows, details, cases, result_crosswalk(spark, sf), NEW_WS, with_steps=False)["payload"]
    return out.select("project_code", "run_id", "hash", "target_case_id", "title", "status", "duration_ms", "stacktrace", "message",
                      F.array_join("attachments", "|").alias("attachments"), sh.joined_entries(F.col("params")).alias("params"), "signature",
                      F.array_join("suite_path", "/").alias("suite_path"), "author", "chunk")


@query("p11b_result_summary", f"""
select project_code, hash, l_linenumber as status_id, case when l_returnflag <> 'N' then 2 else 0 end as n_steps, 1 as n_attachments_coalesced, 0 as n_files,
  false as has_execution_block, case when l_returnflag = 'A' then length('![s](https://h/public/team/{OLD_WS}/attachment/' || md5(l_partkey::varchar) || '/s.png)') else 0 end as comment_len
from {LINES}""")
def p11b(spark, sf):
    return au.result_summary(source_results(spark, sf)[0]).select(
        "project_code", "hash", "status_id", F.greatest("n_steps", F.lit(0)).alias("n_steps"), "n_attachments_coalesced", F.greatest("n_files", F.lit(0)).alias("n_files"),
        F.coalesce("has_execution_block", F.lit(False)).alias("has_execution_block"), "comment_len")


def sent_results(spark, sf):
    rows, details, cases = source_results(spark, sf)
    return au.sent_summary(pj.results(rows, details, cases, result_crosswalk(spark, sf), NEW_WS, with_steps=False)["payload"])


@query("p11c_sent_summary", f"""
select project_code, hash, target_case_id, title, case when attachments = '' then 0 else 1 end as n_attachments, status as execution_status,
  duration_ms as execution_duration_ms, length(coalesce(message, '')) as message_len from {RESULTS}""")
def p11c(spark, sf):
    return sent_results(spark, sf).select("project_code", "hash", "target_case_id", "title", "n_attachments", "execution_status", "execution_duration_ms", "message_len")


@query("p11d_chunk_summary", f"""
select project_code, run_id, chunk, count(*) as count, string_agg(status, ',' order by hash) as statuses from {RESULTS} group by 1, 2, 3""")
def p11d(spark, sf):
    return au.chunk_summary(sent_results(spark, sf)).select("project_code", "run_id", "chunk", "count", F.array_join("items.execution_status", ",").alias("statuses"))


@query("j12b_apply_created", f"""
select c_custkey::varchar as source_key, (cf + 700000)::varchar as target_key from {USERS} u join (select email, min(c_custkey) filter (where outcome = 'to_create') as cf from {USERS} group by 1) using (email)
where outcome in ('to_create', 'reuse_new') and cf % 5 <> 0""")
def j12b(spark, sf):
    from ..operators import crosswalk as cx
    rows = cut(planned_users(spark, sf)["rows"])
    made = rows.where("outcome = 'to_create' and cast(id as bigint) % 5 <> 0").select(F.col("id").alias("source_id"), (F.col("id").cast("bigint") + 700000).alias("target_key"))
    return cx.apply_created(rows, made, "user").select("source_key", "target_key")


@query("e15b_result_steps", f"""
with b as (select * from {LINES} join part on p_partkey = l_partkey),
r as (select hash, '0' as path, case when p_size > 3 then p_name else '.' end as action, case when p_size > 3 then p_type end as expected_result,
        '**Comment**' || chr(10) || l_linestatus as comment, 'failed' as status, 'result' as origin from b where l_returnflag <> 'N'
      union all select hash, '1', 'own', null, null, 'skipped', 'result' from b where l_returnflag <> 'N'),
c as (select hash, '0' as path, p_name as action, p_type as expected_result, null as comment,
        case l_linenumber when 2 then 'failed' when 3 then 'blocked' when 5 then 'skipped' when 7 then 'in_progress' else 'passed' end as status, 'synthetic' as origin
      from b where l_returnflag = 'N' and p_size > 3
      union all select hash, '0.0', 'inner', null, null, case l_linenumber when 2 then 'failed' when 3 then 'blocked' when 5 then 'skipped' when 7 then 'in_progress' else 'passed' end, 'synthetic' from b where p_size > 3)
select * from r union all select * from c""")
def e15b(spark, sf):
    rows, details, cases = source_results(spark, sf)
    out = pj.result_steps(pj.enrich_results(rows, details, cases), result_crosswalk(spark, sf), NEW_WS)
    return out.select("hash", F.array_join(F.col("path").cast("array<string>"), ".").alias("path"), "action", "expected_result", "comment", "status", "origin")


@query("e16_completion_queue", """
select o_orderpriority as project_code, o_orderkey as source_run_id, (o_orderkey + 9)::varchar as target_run_id,
       case when o_orderstatus = 'F' then 'list' else 'detail' end as found_in from orders where o_totalprice > 50000 and (o_orderstatus = 'F' or o_totalprice > 300000)""")
def e16(spark, sf):
    o = t(spark, sf, "orders")
    runs = entity_of(o, "run", "o_orderpriority", id="o_orderkey", is_completed="o_orderstatus = 'F'")
    detail = entity_of(o.where("o_totalprice > 100000"), "run", "o_orderpriority", id="o_orderkey", state="named_struct('slug', if(o_totalprice > 300000, 'Ended', 'active'))")
    flags = detail.select("project_code", "id", pr.run_finished(detail).alias("by_detail"))
    joined = runs.join(flags, ["project_code", "id"], "left")
    cw = xw(o.where("o_totalprice > 50000"), "run", "o_orderkey", "o_orderkey + 9", "o_orderpriority")
    return au.completion_queue(joined, cw, pr.run_finished(runs), F.coalesce("by_detail", F.lit(False)))


def defect_rows(spark, sf):
    return entity_of(
        t(spark, sf, "orders"), "defect", "o_orderpriority", id="o_orderkey", title="concat('D ', o_orderkey)",
        actual_result="concat('x /attachment/', md5(cast(o_custkey as string)), '/ y')", severity="if(o_orderstatus = 'F', 'Major', null)",
        status="if(o_orderstatus = 'P', 'Closed', 'open')", author_id="if(o_totalprice > 100000, o_custkey, 0)", member_id="o_custkey",
        milestone_id="o_orderkey", attachments="array(upper(md5(cast(o_custkey as string))))")


def defect_crosswalk(spark, sf):
    seen = t(spark, sf, "orders").where("o_totalprice > 250000").select("o_orderpriority", "o_custkey").distinct()
    return crosswalk_of(user_cw(spark, sf), xw(milestone_rows(spark, sf), "milestone", "id", "concat('m', id)", "project_code"),
                        xw(seen, "attachment", "md5(cast(o_custkey as string))", "md5(concat('t', o_custkey))", "o_orderpriority"))


@query("e17_defects", f"""
with seen as (select distinct o_orderpriority, o_custkey from orders where o_totalprice > 250000),
ms as (select o_orderpriority, max(o_orderkey) as id from orders group by o_orderpriority, o_orderstatus)
select o.o_orderpriority as project_code, o_orderkey as source_id, 'x /attachment/' || case when s.o_custkey is not null then md5('t' || o.o_custkey) else md5(o.o_custkey::varchar) end || '/ y' as actual_result,
  case when o_orderstatus = 'F' then 3 else 0 end as severity, case when o.o_custkey = 0 then 1 else coalesce(target_key, 1) end as author_id, 'm' || ms.id as milestone_id,
  case when s.o_custkey is not null then md5('t' || o.o_custkey) else '' end as attachments, o_orderstatus = 'P' as resolve
from orders o left join seen s on s.o_orderpriority = o.o_orderpriority and s.o_custkey = o.o_custkey left join ms on ms.o_orderpriority = o.o_orderpriority and ms.id = o_orderkey
left join {USER_CW} on o.o_custkey = source_key""")
def e17(spark, sf):
    out = pj.defects(defect_rows(spark, sf), defect_crosswalk(spark, sf))["payload"]
    return out.select("project_code", "source_id", "actual_result", "severity", "author_id", "milestone_id", F.array_join("attachments", "|").alias("attachments"), "resolve")


#: The same number as `whole.digest`, in SQL.
DIGEST = "sum(('0x' || substr(md5(concat_ws('|', {})), 1, 8))::bigint)::bigint"
SHARED = "project_code, source_hash, title, 'No action>' || p_type as steps"


def _contents():
    """What is compared of each project entity's payload."""
    steps = F.transform("steps", lambda s: F.coalesce(s["shared"], F.concat(s["action"], F.lit("@"), s["position"].cast("string"))))
    shared = F.transform("steps", lambda s: F.concat(s["action"], F.lit(">"), s["expected_result"]))
    custom = F.transform("custom_field", lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return {
        "milestone": ["source_id", "title", "status", "depth"], "configuration": ["group_id", "source_id", "title"],
        "environment": ["source_id", "title", "slug", "description"], "shared_step": ["source_hash", "title", F.array_join(shared, ";")],
        "suite": ["source_id", "title", "parent_id", "parent_target", "depth", F.array_join(F.col("order_path").cast("array<string>"), "/")],
        "case": ["source_id", "title", "suite_id", "milestone_id", "author_id", "description", "severity", F.array_join("tags", "|"),
                 F.array_join("attachments", "|"), F.array_join(custom, ";"), F.array_join(steps, ";"), "chunk"],
        "plan": ["source_id", "title", "description"],
        "run": ["source_id", "title", "author_id", "start_time", "end_time", F.array_join("configurations", "|"), "milestone_id", "environment_id", "finished"],
        "result": ["run_id", "hash", "target_case_id", "title", "status", "duration_ms", "signature", F.array_join("suite_path", "/"), "author", "chunk"],
        "defect": ["source_id", "severity", "author_id", "milestone_id", "resolve"]}


E18_PLANS = PLAN_LINKS.replace(" and o_totalprice <= 400000", "")
#: entity -> (landed rows with their scope, planned rows with their scope, columns compared)
E18 = {
    "milestone": ("select distinct o_orderpriority as scope, o_orderstatus from orders",
                  "select o_orderpriority as scope, max(o_orderkey) as source_id, 'M ' || o_orderstatus as title, 'active' as status, 0 as depth from orders group by o_orderpriority, o_orderstatus",
                  "source_id, title, status, depth"),
    "configuration": (f"select project_code as scope from {CONFIGS}",
                      f"select project_code as scope, * from {CONFIGS} where id not in (select p_partkey * 10 from part where p_size > 30)", "group_id, id, title"),
    "environment": ("select 'N' || s_nationkey as scope from supplier",
                    "select 'N' || s_nationkey as scope, s_suppkey, s_name, lower(s_name) as slug, 'd' as description from supplier where s_acctbal <= 5000", "s_suppkey, s_name, slug, description"),
    "shared_step": ("select p_brand as scope from part", "select p_brand as scope, md5(p_partkey::varchar) as h, p_name, 'No action>' || p_type as steps from part where p_size > 2", "h, p_name, steps"),
    "suite": (f"select '*' as scope from {TREE}",
              f"""select '*' as scope, t.id as source_id, case when t.id % 2 = 0 then t.p_name else 'Suite ' || t.id end as title, t.parent_id, p.p_partkey + 7 as parent_target, depth,
                array_to_string(path, '/') as path from {TREE} t join walk using (id) left join part p on p.p_partkey = t.parent_id and p.p_size > 5""",
              "source_id, title, parent_id, parent_target, depth, path"),
    "case": ("select p_brand as scope from part", f"select project_code as scope, * from {CASES}",
             "source_id, title, suite_id, milestone_id, author_id, description, severity, tags, attachments, custom_field, steps, chunk"),
    "plan": ("select o_orderpriority as scope from orders",
             f"""select o_orderpriority as scope, o_orderkey as source_id, 'Plan' as title, o_orderstatus as description from orders where (o_orderpriority, o_orderkey) in
               (select (project_code, plan_id) from {E18_PLANS}) and (o_orderpriority, o_orderkey) not in (select (o_orderpriority, o_custkey) from orders where o_totalprice > 250000)""",
             "source_id, title, description"),
    "run": ("select o_orderpriority as scope from orders", f"select project_code as scope, * from ({RUN_SQL})",
            "source_id, title, author_id, start_time, end_time, configurations, milestone_id, environment_id, finished"),
    "result": (f"select project_code as scope from {LINES}", f"select project_code as scope, * from {RESULTS}",
               "run_id, hash, target_case_id, title, status, duration_ms, signature, suite_path, author, chunk"),
    "defect": ("select o_orderpriority as scope from orders",
               f"""select o.o_orderpriority as scope, o_orderkey as source_id, case when o_orderstatus = 'F' then 3 else 0 end as severity,
                 case when o.o_custkey = 0 then 1 else coalesce(target_key, 1) end as author_id, 'm' || ms.id as milestone_id, o_orderstatus = 'P' as resolve
                 from orders o left join (select o_orderpriority, max(o_orderkey) as id from orders group by o_orderpriority, o_orderstatus) ms
                 on ms.o_orderpriority = o.o_orderpriority and ms.id = o_orderkey left join {USER_CW} on o.o_custkey = source_key""",
               "source_id, severity, author_id, milestone_id, resolve"),
}


def summary_sql(parts: dict, more: str = "") -> str:
    """Counts and digests of landed and planned rows, by scope and entity."""
    rows = [f"select scope, '{e}' as entity, count(*) as l, 0 as n, 0::bigint as d from ({landed}) group by scope" for e, (landed, _, _) in parts.items()]
    rows += [f"select scope, '{e}', 0, count(*), {DIGEST.format(columns)} from ({planned}) group by scope" for e, (_, planned, columns) in parts.items()]
    return f"""with {more} every as ({' union all '.join(rows)}), total as (select scope, entity, sum(l)::bigint as landed, sum(n)::bigint as planned, sum(d)::bigint as digest,
grouping(scope) as s, grouping(entity) as e from every group by rollup (scope, entity))
select case when s = 1 then '(all)' else scope end as scope, case when e = 1 then '(all)' else entity end as entity, landed, planned, digest from total"""


@query("e18_project_plan", summary_sql(E18, f"{WALK},"))
def e18(spark, sf):
    results, details, cases = source_results(spark, sf)
    s = t(spark, sf, "supplier").withColumn("project", F.expr("concat('N', s_nationkey)"))
    p = t(spark, sf, "part")
    groups, nested = en.configurations(configuration_pages(spark, sf))
    landed = {
        "milestone": milestone_rows(spark, sf), "configuration_group": groups, "configuration": nested,
        "environment": entity_of(s, "environment", "project", id="s_suppkey", title="s_name", slug="lower(s_name)", description="'d'"),
        "shared_step": entity_of(p, "shared_step", "p_brand", hash="if(p_size > 2, md5(cast(p_partkey as string)), null)", title="p_name",
                                 steps="array(named_struct('action', '  ', 'expected', p_type))"),
        "suite": entity_of(tree(spark, sf), "suite", None, id="id", parent_id="parent_id", title="if(id % 2 = 0, p_name, '')"),
        "case": case_rows(spark, sf), "plan": plan_rows(spark, sf), "run": run_rows(spark, sf), "run_link": run_links(spark, sf),
        "result": results, "result_detail": details, "defect": defect_rows(spark, sf)}
    # The scopes of the tables these stand for are disjoint, so one crosswalk serves all; results look their cases up among
    # their own projects' cases.
    known = crosswalk_of(
        run_crosswalk(spark, sf), case_crosswalk(spark, sf).where("entity <> 'user'"), xw(p.where("p_size > 30"), "configuration", "p_partkey * 10", "p_partkey", "p_brand"),
        xw(s.where("s_acctbal > 5000"), "environment", "s_suppkey", "s_suppkey", "project"), xw(p.where("p_size > 5"), "suite", "p_partkey", "p_partkey + 7"))
    landed["result_case"] = cases
    return whole.plan_summary(landed, whole.project_entities(landed, known, NEW_WS), contents=_contents())


@query("e18b_project_rejects", f"""
select 'plan' as entity, o_orderpriority as scope, o_orderkey::varchar as source_key, case when o_orderstatus = 'P' then 'no id or title' else 'no mapped case' end as reason
from orders where o_orderstatus = 'P' or (o_orderpriority, o_orderkey) not in (select (project_code, plan_id) from {PLAN_LINKS.replace(" and o_totalprice <= 400000", "")})
union all select 'environment', 'N' || s_nationkey, s_suppkey::varchar, 'no id or title' from supplier where s_acctbal <= 0""")
def e18b(spark, sf):
    s = t(spark, sf, "supplier").withColumn("project", F.expr("concat('N', s_nationkey)"))
    landed = {"environment": entity_of(s, "environment", "project", id="s_suppkey", title="if(s_acctbal > 0, s_name, '')"), "plan": plan_rows(spark, sf)}
    return whole.all_rejects(whole.project_entities(landed, run_crosswalk(spark, sf).where("entity = 'case'")))


#: Who a customer becomes: found by mail, created just now (a fifth of the calls fail: the key of an earlier run stays), or the default user.
E19_USERS = """(select c_custkey as k, case when c_mktsegment = 'BUILDING' then c_custkey::varchar when c_acctbal > 0 and c_custkey % 5 <> 0 then (c_custkey + 700000)::varchar
  when c_acctbal > 0 then (c_custkey + 100000)::varchar else '1' end as target_user from customer)"""
E19 = {
    "project": ("select '*' as scope from nation", "select '*' as scope, n_name from nation where n_regionkey <= 1", "n_name"),
    "user": ("select '*' as scope from customer", "select '*' as scope, c_custkey, lower(c_name || '@x.example') as mail from customer where c_mktsegment <> 'BUILDING' and c_acctbal > 0", "c_custkey, mail"),
    "group": ("select '*' as scope from part", f"select '*' as scope, min(p_partkey::varchar) as id from part group by lower({GROUP_NAME}) having max(p_size) <= 25", "id"),
    "custom_field": ("select '*' as scope from part", "select '*' as scope, min(p_partkey) as id, p_brand || ' ' || p_type || ' ' || p_size as title from part where p_size <= 25 group by p_brand, p_type, p_size", "id, title"),
    "shared_parameter": ("select '*' as scope from part", """select '*' as scope, min(id) as id, arg_min(p_brand, id) as v from (select *, md5(p_partkey::varchar) as id from part where p_retailprice > 950 and p_type <> 'SMALL')
       group by p_name, p_size having (p_name, p_size) not in (select (p_name, p_size) from part where p_size > 40)""", "id, v"),
    "attachment": ("select '*' as scope from documents, (values (0), (1)) v(twice), (values (0), (1)) l(link)",
                   f"select '*' as scope, key, target_code, (row_number() over (partition by target_code order by key) - 1) // 20 as batch from {E06} where lang not in ('en', 'es')", "key, target_code, batch"),
}


def workspace_plan(spark, sf):
    n, c, p = (t(spark, sf, x) for x in ("nation", "customer", "part"))
    p = p.withColumn("title", F.expr("concat(p_brand, ' ', p_type, ' ', p_size)")).withColumn("gname", F.expr("concat(p_name, ' ', p_type, ' ', p_size)"))
    p = p.withColumn("pid", F.md5(F.col("p_partkey").cast("string"))).withColumn("ptitle", F.expr("concat(p_name, ' ', p_size)"))
    d = linked_documents(spark, sf)
    refs = hv.all_refs(hv.harvest_refs(d, "source", [hv.text_refs("text")], 0, "doc_id"), hv.harvest_refs(d, "source", [hv.text_refs("text")], 2, "doc_id"))
    order = d.select(F.col("source").alias("scope")).distinct().select(
        "scope", F.expr("cast(substr(scope, 4) as int)").alias("ordinal"), F.expr("concat('T', substr(scope, 4))").alias("target_code"))
    key = F.md5(F.col("doc_id").cast("string")).alias("key")
    group = entity_of(p, "group", None, id="cast(p_partkey as string)", displayName="initcap(gname)", members="parse_json(concat('[{\"value\":', p_partkey, '},', p_size, ',\"abc-1\"]'))")
    landed = {"project": entity_of(n, "project", None, id="n_nationkey", code="n_name"),
              "user": entity_of(c, "user", None, id="c_custkey", email="concat(c_name, '@x.example')", name="c_name", is_active="c_acctbal > 0"),
              "group": group.withColumn("members", sh.member_keys("members")), "custom_field": entity_of(p, "custom_field", None, id="p_partkey", title="title"),
              "shared_parameter": entity_of(p, "shared_parameter", None, id="pid", title="ptitle", type="'single'", project_codes="array('Brand#1')",
                                            parameters="if(p_type <> 'SMALL', parse_json(to_json(array(named_struct('title', p_name, 'values', array(p_brand))))), parse_json('[]'))"),
              "attachment": refs, "project_order": order, "attachment_size": d.select(key, F.lit(100).cast("bigint").alias("n_bytes"))}
    target = {"project": n.where("n_regionkey > 1").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("code")),
              "user": c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("@x.example")).alias("email")),
              "group": p.where("p_size > 25").select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("id"), F.upper("gname").alias("displayName")),
              "custom_field": p.where("p_size > 25").select(F.col("p_partkey").alias("id"), "title"),
              "shared_parameter": p.where("p_size > 40").select(F.col("pid").alias("id"), F.upper("ptitle").alias("title")),
              "attachment": d.where("lang = 'es'").select(key)}
    landed = {k: v.drop("project_code") for k, v in landed.items()}
    done = crosswalk_of(user_cw(spark, sf), xw(p.where("p_retailprice <= 950"), "shared_parameter", "pid", "concat('x', pid)"),
                        xw(d.where("lang = 'en'"), "attachment", "md5(cast(doc_id as string))", "md5(concat('t', doc_id))", "source"))
    made = c.where("c_mktsegment <> 'BUILDING' and c_acctbal > 0 and c_custkey % 5 <> 0").select(F.col("c_custkey").alias("source_id"), (F.col("c_custkey") + 700000).alias("target_key"))
    return landed, whole.workspace_entities(landed, target, done, created={"user": made})


@query("e19_workspace_plan", f"""
{summary_sql(E19)} where s = 0 or e = 1""")
def e19(spark, sf):
    landed, plans = workspace_plan(spark, sf)
    contents = {"project": ["code"], "user": ["source_id", "email"], "group": ["source_id"], "custom_field": ["source_id", "title"],
                "shared_parameter": ["source_id", F.col("parameters")[0]["values"][0]], "attachment": ["key", "target_code", "batch"]}
    return whole.plan_summary(landed, plans, contents=contents)


@query("e19b_members_of_created_users", f"""
with s as (select p_partkey::varchar as id, lower({GROUP_NAME}) as nk, p_partkey, p_size from part),
  tg as (select nk, max(id) as tid from s where p_size > 25 group by 1), f as (select nk, min(id) as cf from s group by 1),
  m as (select id, nk, 0 as pos, p_partkey as member from s union all select id, nk, 1, p_size from s)
select m.id as group_id, coalesce('g' || tid, 'new:' || cf) as target_group, pos, u.target_user from m left join tg using (nk) left join f using (nk) join {E19_USERS} u on member = u.k""")
def e19b(spark, sf):
    return workspace_plan(spark, sf)[1]["group"]["members"].select("group_id", "target_group", "pos", "target_user")


@query("e20_scope_audit", f"""
with s as (select l_orderkey, count(distinct l_partkey) as sent from lineitem where l_returnflag <> 'A' group by 1),
p as (select l_orderkey, count(distinct l_partkey) as plan_size from lineitem group by 1),
a as (select o_orderkey, o_orderstatus, o_orderpriority, coalesce(sent, 0) as sent, coalesce(plan_size, 0) as plan_size from orders left join s on s.l_orderkey = o_orderkey left join p on p.l_orderkey = o_orderkey),
b as (select *, case o_orderpriority when '1-URGENT' then plan_size when '2-HIGH' then sent + 100 else sent end as actual from a)
select o_orderkey, sent, actual, case when o_orderstatus = 'P' then 'not judged (no plan)' when sent = 0 then 'not judged (no cases)' when actual = sent then 'honoured'
  when actual = plan_size then 'expanded' else 'unexpected' end as label,
  case when actual = sent and o_orderstatus = 'F' then 'preserved and attached' when actual = sent then 'preserved, not attached' when actual = plan_size then 'expanded after update' else 'unexpected' end as after_update
from b""")
def e20(spark, sf):
    links = t(spark, sf, "lineitem")
    sent = links.where("l_returnflag <> 'A'").groupBy("l_orderkey").agg(F.count_distinct("l_partkey").alias("sent"))
    size = links.groupBy("l_orderkey").agg(F.count_distinct("l_partkey").alias("plan_size"))
    o = t(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey").join(sent, "l_orderkey", "left").join(size, "l_orderkey", "left")
    o = o.fillna(0, ["sent", "plan_size"]).withColumn("actual", F.expr("case o_orderpriority when '1-URGENT' then plan_size when '2-HIGH' then sent + 100 else sent end"))
    return o.select(F.col("l_orderkey").alias("o_orderkey"), "sent", "actual",
                    au.scope_label("sent", "plan_size", "actual", F.col("o_orderstatus") != "P").alias("label"),
                    au.scope_after_update("sent", "plan_size", "sent", "actual", F.col("o_orderstatus") == "F").alias("after_update"))


@query("e21_reconcile_report", f"""
select scope, count(*) as compared, count(*) filter (where outcome = 'match') as matching, count(*) filter (where outcome = 'mismatch') as mismatching,
  count(*) filter (where outcome = 'missing') as missing, count(*) filter (where src_plan <> 0) as plan_runs,
  count(*) filter (where src_plan <> 0 and outcome = 'match') as plan_runs_match from {RECONCILE} group by 1""")
def e21(spark, sf):
    return au.reconcile_summary(reconciled(spark, sf), ["scope"])
