"""Order-dependent operators, sorts and limits, hierarchies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import shapes as sh, text as tx
from ..operators import audit as au, batching as ba, hierarchy as hi, ranking as rk, rate
from .base import LINES, query, result_lines, t, xw
from .lookups import RECONCILE, entity_rows, reconciled, ENTITY_ROWS


@query("w01_chunk_index", f"""
select project_code, hash, (rn - 1) // 500 as chunk, (rn - 1) % 500 as pos
from (select project_code, hash, row_number() over (partition by project_code order by hash) as rn from {LINES})""")
def w01(spark, sf):
    rows = result_lines(spark, sf).select("project_code", "hash")
    return rk.chunk_index(rows, ["project_code"], ["hash"], 500)


@query("w01b_chunk_index_by_id", """
select o_orderpriority, o_orderkey, (rn - 1) // 20 as chunk, (rn - 1) % 20 as pos
from (select o_orderpriority, o_orderkey, row_number() over (partition by o_orderpriority order by o_orderkey) as rn from orders)""")
def w01b(spark, sf):
    rows = t(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return rk.chunk_index(rows, ["o_orderpriority"], ["o_orderkey"], 20)


@query("w02_first_wins", """
with k as (select p_partkey, case when p_size > 5 then p_name end as code from part)
select p_partkey, code from k where code is null
union all select min(p_partkey), code from k where code is not null group by code""")
def w02(spark, sf):
    rows = t(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") > 5, F.col("p_name")).alias("code"))
    return rk.first_wins(rows, "code", ["p_partkey"])


@query("w03_last_wins", "select user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type from events group by 1")
def w03(spark, sf):
    return rk.last_per_key(t(spark, sf, "events"), ["user_id"], ["event_id"]).select("user_id", "event_id", "event_type")


@query("w04_uniquify_labels", """
with recursive w as (select conv_id, turn, list_transform(string_split(text, ' '), lambda x: left(x, 2)) || ['th (1)', 'th', 'an (2)', 'an', 'an', 'an (2)'] as ws from conversations),
  g as (select conv_id, turn, ws, 1 as i, [ws[1]] as seen from w
        union all
        select conv_id, turn, ws, i + 1, seen || [case when not list_contains(seen, ws[i + 1]) then ws[i + 1] else ws[i + 1] || ' (' ||
          list_min(list_filter(range(1, i + 2), lambda k: not list_contains(seen, ws[i + 1] || ' (' || k || ')'))) || ')' end]
        from g where i < len(ws))
select conv_id, turn, md5(array_to_string(seen, '|')) as labels_md5 from g where i = len(ws)""")
def w04(spark, sf):
    words = F.concat(F.transform(F.split("text", " "), lambda w: F.left(w, F.lit(2))), F.array(*[F.lit(x) for x in ("th (1)", "th", "an (2)", "an", "an", "an (2)")]))
    out = F.array_join(ba.uniquify(words), "|")
    return t(spark, sf, "conversations").select("conv_id", "turn", F.md5(out).alias("labels_md5"))


@query("w05_step_positions", """
select p_partkey, case when p_size > 25 then '7' else '1' end || ',' || 2 as positions from part""")
def w05(spark, sf):
    steps = F.parse_json(F.expr("if(p_size > 25, '[{\"position\":7},{\"a\":1}]', '[{\"a\":1},{\"position\":null}]')"))
    out = ba.positions(sh.items(steps), lambda s: sh.get(s, "position", "int"))
    return t(spark, sf, "part").select("p_partkey", F.array_join(out.cast("array<string>"), ",").alias("positions"))


@query("w06_capped_batches", """
with recursive q as (select source, doc_id, length(text) as b, row_number() over (partition by source order by doc_id) as i from documents),
g as (select source, i, 0 as batch, 1 as n, b as total, b > 9000 as lone, doc_id from q where i = 1
      union all
      select q.source, q.i, g.batch + case when s.fresh then 1 else 0 end, case when s.fresh then 1 else g.n + 1 end, case when s.fresh then q.b else g.total + q.b end, q.b > 9000, q.doc_id
      from g join q on q.source = g.source and q.i = g.i + 1, lateral (select g.lone or q.b > 9000 or g.n >= 5 or g.total + q.b > 20000 as fresh) s)
select source, doc_id, batch::bigint as batch from g""")
def w06(spark, sf):
    docs = t(spark, sf, "documents").select("source", "doc_id", F.length("text").cast("bigint").alias("n_bytes"))
    out = ba.cap_batches(docs, ["source"], ["doc_id"], "n_bytes", max_n=5, max_bytes=20000, lone_bytes=9000)
    return out.select("source", "doc_id", "batch")


@query("w07_rolling_rate", """
select event_id, user_id, count(*) over (partition by user_id order by ts range between interval 6 hours preceding and current row) as calls from events""")
def w07(spark, sf):
    return rate.rolling_count(t(spark, sf, "events").select("event_id", "user_id", "ts"), "user_id", "ts", 6 * 3600).select("event_id", "user_id", "calls")


@query("w07b_quota_audit", """
select user_id, max(calls) as peak, count(*) filter (where calls > 2) as n_over, count(*) as n_calls
from (select user_id, count(*) over (partition by user_id order by ts range between interval 6 hours preceding and current row) as calls from events) group by 1""")
def w07b(spark, sf):
    return rate.over_quota(t(spark, sf, "events"), "user_id", "ts", 6 * 3600, 2)


@query("w08_trailing", """
select user_id, event_id, (n - rn)::bigint as pos from (select user_id, event_id, row_number() over (partition by user_id order by event_id desc) as rn,
  least(5, count(*) over (partition by user_id)) as n from events) where rn <= 5""")
def w08(spark, sf):
    return rk.trailing(t(spark, sf, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], 5)


@query("w09_upload_queues", """
with r as (select lang as target_code, doc_id, row_number() over (partition by lang order by doc_id) - 1 as i from documents),
 q as (select target_code, row_number() over (order by target_code) - 1 as turn from (select distinct lang as target_code from documents))
select r.target_code, doc_id, i // 20 as batch, turn from r join q using (target_code)""")
def w09(spark, sf):
    docs = t(spark, sf, "documents").select(F.col("lang").alias("target_code"), "doc_id", F.lit(1024).alias("n_bytes"))
    return ba.upload_plan(docs, "target_code", ["doc_id"], "n_bytes").select("target_code", "doc_id", "batch", "turn")


# ------------------------------------------------------------------ sorts and limits


@query("o01_summary_order", f"""
select row_number() over (order by lower(project)) as place, project, processed from (select project, count(*) as processed from {ENTITY_ROWS} group by 1)""")
def o01(spark, sf):
    per = au.stats(entity_rows(spark, sf), ["project"], "target").select("project", "processed", F.lower("project").alias("k"))
    return rk.number_rows(per, [], ["k"], "place").select("place", "project", "processed")


@query("o02_users_by_email", """
select lower(c_name) || '@x.example' as email, row_number() over (order by lower(c_name) || '@x.example') as place from customer""")
def o02(spark, sf):
    c = t(spark, sf, "customer").select(F.lower(F.concat("c_name", F.lit("@X.example"))).alias("email"))
    return rk.number_rows(c, [], ["email"], "place")


@query("o03_pairs_by_numeric_id", """
select o_orderkey::varchar as source_key, row_number() over (order by o_orderkey) as place from orders where o_totalprice > 50000""")
def o03(spark, sf):
    cw = xw(t(spark, sf, "orders").where("o_totalprice > 50000"), "run", "o_orderkey", "o_orderkey + 1")
    return rk.number_rows(cw.withColumn("n", F.col("source_key").cast("bigint")), [], ["n"], "place").select("source_key", "place")


@query("o04_first_mismatches", f"""
select scope, source_key, src_n, tgt_n from {RECONCILE} where outcome = 'mismatch' order by scope, source_key::bigint limit 15""")
def o04(spark, sf):
    bad = reconciled(spark, sf).where("outcome = 'mismatch'")
    return rk.keep_smallest(bad, ["scope", F.col("source_key").cast("bigint")], 15).select("scope", "source_key", "src_n", "tgt_n")


@query("o05_sorted_params", """
select p_partkey, 'brand=' || p_brand || '|name=' || p_name || '|size=' || p_size as params from part""")
def o05(spark, sf):
    e = sh.param_entries(F.parse_json(F.to_json(F.expr("named_struct('size', p_size, 'name', p_name, 'brand', p_brand)"))))
    return t(spark, sf, "part").select("p_partkey", sh.joined_entries(e).alias("params"))


@query("o06_capped_key_list", "select doc_id, 'a' || n_chars || ',' || 'lang' as keys from documents")
def o06(spark, sf):
    m = F.expr("map('source', 1, 'lang', 2, concat('a', n_chars), 3)")
    return t(spark, sf, "documents").select("doc_id", F.array_join(sh.capped_keys(m, 2), ",").alias("keys"))


# ------------------------------------------------------------------ hierarchies


def tree(spark, sf):
    """Parts as a forest: the parent is a third of the key; keys of one size lose their parent, two
    small ones form a cycle."""
    return t(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), "p_name",
        F.expr("case when p_partkey < 3 then null when p_partkey = 4 then 5 when p_partkey = 5 then 4 when p_size = 13 then p_partkey + 1000000000"
               " else p_partkey div 3 end").alias("parent_id"))


TREE = """(select p_partkey as id, p_name, case when p_partkey < 3 then null when p_partkey = 4 then 5 when p_partkey = 5 then 4
  when p_size = 13 then p_partkey + 1000000000 else p_partkey // 3 end as parent_id from part)"""
WALK = f"""recursive walk as (select id, 0 as depth, [id] as path, [p_name] as titles from {TREE} where parent_id is null
  union all select c.id, w.depth + 1, list_append(w.path, c.id), list_append(w.titles, c.p_name) from {TREE} c join walk w on c.parent_id = w.id)"""


@query("h01_expand", f"with {WALK} select t.id, coalesce(depth, -1) as depth, case when walk.id is null then 'unreachable' else 'reached' end as state from {TREE} t left join walk using (id)")
def h01(spark, sf):
    out = hi.expand(tree(spark, sf), "id", "parent_id")
    return out.select("id", F.coalesce("depth", F.lit(-1)).alias("depth"), "state")


@query("h02_unreachable", f"with {WALK} select id from {TREE} where id not in (select id from walk)")
def h02(spark, sf):
    return hi.unreachable(hi.expand(tree(spark, sf), "id", "parent_id")).select("id")


@query("h03_load_order", f"with {WALK} select id, array_to_string(path, '/') as path from walk")
def h03(spark, sf):
    out = hi.load_order(hi.expand(tree(spark, sf), "id", "parent_id"))
    return out.select("id", hi.path_text("order_path").alias("path"))


@query("h04_parent_remap", f"select t.id, p.p_partkey + 7 as parent_target from {TREE} t left join part p on p.p_partkey = t.parent_id and p.p_size > 5")
def h04(spark, sf):
    cw = xw(t(spark, sf, "part").where("p_size > 5"), "suite", "p_partkey", "p_partkey + 7")
    out = hi.remap_parent(tree(spark, sf), cw, "suite", "parent_id", "parent_target", None)
    return out.select("id", F.col("parent_target").cast("bigint").alias("parent_target"))


@query("h05_title_path", f"with {WALK} select id, array_to_string(titles, ' > ') as titles from walk")
def h05(spark, sf):
    out = hi.expand(tree(spark, sf), "id", "parent_id", label="p_name").where("state = 'reached'")
    return out.select("id", F.array_join("titles", " > ").alias("titles"))


@query("h05b_suite_path", """
select p_partkey, case when p_size > 30 then p_brand || '/' || p_name when p_size > 15 then p_name else p_type || '/' || p_brand end as path from part""")
def h05b(spark, sf):
    title = F.expr("if(p_size > 30, concat(' ', p_brand, '\\t\\n ', p_name, '\\n'), ' ')")
    suite = F.parse_json(F.expr("if(p_size > 15, concat('{\"name\":\"', p_name, '\"}'), '{}')"))
    suites = F.parse_json(F.expr("concat('[{\"title\":\"', p_type, '\"},\" ', p_brand, ' \",{}]')"))
    return t(spark, sf, "part").select("p_partkey", F.array_join(tx.suite_path(title, suite, suites), "/").alias("path"))


@query("h06_short_titles", """
select doc_id, md5(case when length(trim(text)) > 500 then left(trim(text), 497) || '...' else trim(text) end || '|' || source) as titles_md5 from documents""")
def h06(spark, sf):
    titles = tx.short_titles(F.array("text", F.lit("  "), "source"))
    return t(spark, sf, "documents").select("doc_id", F.md5(F.array_join(titles, "|")).alias("titles_md5"))


@query("h07_title_fallback", """
select p_partkey, case when p_size > 30 then p_name when p_size > 15 then p_brand else 'Suite ' || p_partkey end as title from part""")
def h07(spark, sf):
    return t(spark, sf, "part").select("p_partkey", tx.suite_title(
        F.expr("if(p_size > 30, p_name, '')"), F.expr("if(p_size > 15, p_brand, null)"), "p_partkey").alias("title"))
