"""Operators against brute force and hand-written rows."""

import random

import pytest
from pyspark.sql import functions as F

from relink.operators import batching as ba, crosswalk as cx, hierarchy as hi, links as lk, overlay as ov, pairing as pa, ranking as rk, rate
from relink.plans import project as pj
from relink.schemas import CROSSWALK


def greedy(sizes, max_n, max_bytes, lone):
    out, batch, n, total, alone = [], -1, 0, 0, False
    for s in sizes:
        if batch < 0 or alone or s > lone or n >= max_n or total + s > max_bytes:
            batch, n, total = batch + 1, 0, 0
        n, total, alone = n + 1, total + s, s > lone
        out.append(batch)
    return out


@pytest.mark.parametrize("block", [7, 25, 1000])
def test_cap_batches_equals_sequential_walk(spark, block):
    rnd = random.Random(block)
    queues = {q: [rnd.choice([1, 5, 9, 30, 120]) for _ in range(n)] for q, n in (("hot", 400), ("a", 3), ("b", 1), ("c", 61))}
    rows = [(q, i * 3, s) for q, sizes in queues.items() for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "q string, i bigint, s bigint")
    out = ba.cap_batches(df, ["q"], ["i"], "s", max_n=6, max_bytes=100, lone_bytes=50, block=block).collect()
    got = {(r.q, r.i): r.batch for r in out}
    assert len(got) == len(rows)
    for q, sizes in queues.items():
        assert [got[(q, i * 3)] for i in range(len(sizes))] == greedy(sizes, 6, 100, 50)


def test_cap_batches_example(spark):
    mib = 1024 * 1024
    df = spark.createDataFrame([("t", i, s * mib) for i, s in enumerate([30] * 5 + [33, 1])], "q string, i bigint, s bigint")
    out = ba.cap_batches(df, ["q"], ["i"], "s").orderBy("i").collect()
    assert [r.batch for r in out] == [0, 0, 0, 0, 1, 2, 3]


def test_number_rows_on_a_hot_scope(spark):
    rows = [("hot" if i % 3 else None, (i * 7919) % 5000) for i in range(5000)]
    df = spark.createDataFrame(rows, "s string, i bigint")
    out = rk.number_rows(df, ["s"], ["i"], "n", piece=300).collect()
    for scope in ("hot", None):
        ids = sorted(i for s, i in rows if s == scope)
        assert {r.i: r.n for r in out if r.s == scope} == {i: k + 1 for k, i in enumerate(ids)}


def test_first_wins_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, None), (4, None)], "id int, code string")
    assert sorted(r.id for r in rk.first_wins(df, "code", ["id"]).collect()) == [1, 3, 4]


def test_row_limits_reach_the_map_side(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    plan = rk.last_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def crosswalk(spark, rows):
    return spark.createDataFrame(rows, CROSSWALK)


def test_salted_lookup_equals_plain(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    cw = crosswalk(spark, [("e", "*", str(k), f"t{k}") for k in range(0, 5000, 2)] + [("e", "*", "7", "t7")])
    plain = cx.lookup(df, cw, "e", "k", "t").collect()
    salted = cx.lookup(df, cw, "e", "k", "t", spread=F.col("id")).collect()
    assert sorted(map(tuple, plain), key=str) == sorted(map(tuple, salted), key=str) and len(plain) == 5000


def test_match_or_create(spark):
    source = spark.createDataFrame([(1, " Env "), (2, "new"), (3, "NEW "), (4, " "), (5, None)], "id bigint, title string")
    target = spark.createDataFrame([(10, "env"), (11, "ENV")], "id bigint, title string")
    out = cx.match_or_create(source, target, "id", cx.natural_key("title"), cx.natural_key("title"), "id", ["id"], ["id"]).orderBy("id").collect()
    assert [(r.outcome, r.target_key, r.created_from) for r in out] == [
        ("matched", "11", None), ("to_create", None, 2), ("reuse_new", None, 2), ("invalid", None, None), ("invalid", None, None)]
    untrimmed = cx.natural_key("title", trim=False)
    out = cx.match_or_create(source, target, "id", untrimmed, untrimmed, "id", ["id"], ["id"]).orderBy("id").first()
    assert out.outcome == "to_create"


def test_attribution(spark):
    cw = crosswalk(spark, [("author", "*", "u1", "5"), ("user", "*", "5", "50"), ("user", "*", "7", "70")])
    rows = spark.createDataFrame([(1, "u1", "7", None), (2, "zz", "7", None), (3, None, "0", "7"), (4, None, "abc", "7"), (5, None, None, None)],
                                 "i int, uuid string, member string, other string")
    out = cx.attribute(rows, cw, "uuid", ["member", "other"], "user").orderBy("i").collect()
    assert [r.user for r in out] == [50, 70, 1, 70, 1]


def test_resume_creates_nothing_twice(spark):
    df = spark.createDataFrame([("P", 1), ("P", 2), ("Q", 1)], "project_code string, id bigint")
    done = cx.build_crosswalk(cx.pairs(df, "plan", "id", F.concat(F.lit("t"), "id"), scope="project_code"))
    assert cx.resume(df, done, "plan", "id", "project_code").count() == 0
    assert [tuple(r) for r in cx.resume(df, done.where("scope = 'P'"), "plan", "id", "project_code").collect()] == [("Q", 1)]


def test_hierarchy(spark):
    rows = [(1, None), (2, 1), (3, 2), (4, 99), (5, 6), (6, 5), (7, 6), (8, 4), (9, 0)] + [(i, i - 1) for i in range(100, 140)]
    rows = [(a, None if a == 100 else b) for a, b in rows]
    df = spark.createDataFrame(rows, "id bigint, parent bigint")
    out = {r.id: r for r in hi.expand(df, "id", "parent").collect()}
    assert len(out) == len(rows)
    assert {i for i, r in out.items() if r.state == "unreachable"} == {4, 5, 6, 7, 8, 9}
    assert out[3].path == [1, 2, 3] and out[139].depth == 39
    zero = {r.id: r.state for r in hi.expand(df, "id", "parent", zero_is_root=True).collect()}
    assert zero[9] == "reached"
    order = [r.id for r in hi.load_order(hi.expand(df, "id", "parent")).collect()]
    assert order[:3] == [1, 2, 3]


def test_rolling_count(spark):
    rnd = random.Random(1)
    rows = [(i, "hot" if rnd.random() < 0.7 else "b", rnd.randrange(0, 900)) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, a string, s bigint").withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,s)"))
    out = {r.i: r.calls for r in rate.rolling_count(df, "a", "ts", 60).collect()}
    assert out == {i: sum(1 for _, b, u in rows if b == a and s - 60 <= u <= s) for i, a, s in rows}


def brute_greedy(sent, fresh):
    used, out = set(), {}
    for _, source, case, title in sorted(sent):
        for _, target, tcase, ttitle in sorted(fresh):
            if target in used:
                continue
            if case is not None:
                if tcase != case:
                    continue
            elif title and ttitle and title != ttitle:
                continue
            used.add(target)
            out[source] = target
            break
    return out


def test_pair_greedily_equals_brute_force(spark):
    rnd = random.Random(4)
    for n, m in ((12, 9), (5, 60)):
        sent = [(p, f"s{p}", rnd.choice([1, 2, None]), rnd.choice(["x", "y", ""])) for p in range(n)]
        fresh = [(o, f"t{o:03d}", rnd.choice([1, 2, 3]), rnd.choice(["x", "y", ""])) for o in range(m)]
        a = spark.createDataFrame([("c",) + r for r in sent], "c string, pos int, src string, case_id bigint, title string")
        b = spark.createDataFrame([("c",) + r for r in fresh], "c string, at bigint, tgt string, case_id bigint, title string")
        got = {r.source_key: r.target_key for r in pa.pair_greedily(a, b, ["c"], "pos", "src", "at", "tgt").collect()}
        assert got == brute_greedy(sent, fresh)


def test_pairing_of_many_chunks_equals_brute_force(spark):
    """Chunks that come to a join by rank, and chunks that must be walked, side by side."""
    rnd = random.Random(8)
    sent, fresh, want, plain = [], [], {}, set()
    for c in range(40):
        kind = rnd.choice(["cases", "titles", "apart", "any"])
        cases = {"cases": [1, 2], "titles": [None], "apart": [1, 2, None], "any": [1, 2, None]}[kind]
        titles = {"titles": ["x", "y"], "apart": ["x", "y"]}.get(kind, ["x", "y", ""])
        mine = [(p, f"{c}s{p:03d}", rnd.choice(cases), rnd.choice(titles)) for p in range(rnd.randint(1, 15))]
        if kind == "apart":  # keys of wanted cases have titles that nobody asks for, and the other way round
            keys = [(o, f"{c}t{o:03d}", *rnd.choice([(1, "q"), (2, "q"), (8, "x"), (9, "y")])) for o in range(rnd.randint(0, 25))]
        else:
            keys = [(o, f"{c}t{o:03d}", rnd.choice([1, 2, 3]), rnd.choice(titles)) for o in range(rnd.randint(0, 25))]
        plain |= {c} if kind != "any" else set()
        sent += [(c, *r) for r in mine]
        fresh += [(c, *r) for r in keys]
        want |= brute_greedy(mine, keys)
    a = spark.createDataFrame(sent, "c int, pos int, src string, case_id bigint, title string")
    b = spark.createDataFrame(fresh, "c int, at bigint, tgt string, case_id bigint, title string")
    got = {r.source_key: r.target_key for r in pa.pair_greedily(a, b, ["c"], "pos", "src", "at", "tgt").collect()}
    assert got == want
    s = a.selectExpr("c", "case_id as _case", "title as _title")
    found = {r.c for r in pa.plain_chunks(s, b.selectExpr("c", "case_id as _case", "title as _title"), ["c"]).collect()}
    assert plain & found and len(found) < 40


def test_step_trees_of_eight_levels(spark):
    """One table for any depth; numbers and texts come through unchanged; layers below `data` and `execution` are found."""
    deep = '{"action": "a8", "actual": 0.12345678901234567890}'
    for level in range(7, 0, -1):
        holder = [f'"steps": [{deep}]', f'"steps": [], "data": {{"steps": [{deep}]}}', f'"execution": {{"steps": [{deep}], "comment": "c{level}"}}'][level % 3]
        deep = f'{{"action": "a{level}", {holder}}}'
    df = spark.createDataFrame([("r", f'[{deep}, "just text", {{"actual": 1.50, "title": "\u00e9 \\"q\\""}}]'), ("n", None), ("o", '{"steps": []}'), ("e", "[]")], "id string, j string")
    out = ov.explode_steps(df.withColumn("t", F.parse_json("j")), ["id"], "t").collect()
    paths = {tuple(r.path): r for r in out}
    assert len(out) == 10 and [paths[(0,) * n].action for n in range(1, 9)] == [f"a{n}" for n in range(1, 9)]
    assert paths[(0,) * 8].actual == "0.1234567890123456789" and paths[(2,)].actual.startswith("1.5") and paths[(2,)].action == 'é "q"'
    assert paths[(1,)].action is None and paths[(0,) * 2].comment == "c2"


def test_pair_by_delta(spark):
    sent = spark.createDataFrame([(c, i, f"{c}{i}") for c in ("eq", "more", "less") for i in range(3)], "c string, pos int, src string")
    fresh = spark.createDataFrame([("eq", i, f"e{i}") for i in range(3)] + [("more", i, f"m{i}") for i in range(4)] + [("less", i, f"l{i}") for i in range(2)],
                                  "c string, at bigint, tgt string")
    out = {r.source_key: (r.target_key, r.method) for r in pa.pair_by_delta(sent, fresh, ["c"], "pos", "src", "at", "tgt").collect()}
    assert out["eq0"] == ("e0", "delta") and out["more0"] == ("m1", "delta") and out["less0"] == (None, "fallback")


def test_short_return_leaves_the_tail(spark):
    sent = spark.createDataFrame([(0, 0), (0, 1), (0, 2)], "chunk int, pos int")
    back = spark.createDataFrame([(0, ["a", "b"])], "chunk int, ids array<string>")
    out = pa.pair_returned(sent, back, ["chunk"], "pos", "ids").orderBy("pos").collect()
    assert [r.target_key for r in out] == ["a", "b", None]


def test_steps_of_any_depth(spark):
    df = spark.sql("""select 'r' as id, parse_json('[{"action":".","status":5,"steps":[{"action":"n"}]},{"comment":"only"}]') as mine, parse_json(
        '[{"action":"open","expected":"ok"},{"action":"go","steps":[{"action":"deep","steps":[{"action":"deeper"}]}]},{"action":"last"}]') as theirs, 2 as parent_status""")
    own = ov.explode_steps(df, ["id"], "mine")
    case = ov.explode_steps(df, ["id", "parent_status"], "theirs")
    assert own.count() == 3 and case.count() == 5
    out = {tuple(r.path): r for r in ov.zip_steps(own, case, ["id"]).withColumn("sid", F.try_variant_get("status_id", "$", "int")).collect()}
    assert out[(0,)].action == "open" and out[(0,)].expected_result == "ok" and out[(1,)].action == "go"
    assert out[(2,)].origin == "case" and out[(2,)].sid is None
    assert out[(1, 0)].origin == "synthetic" and out[(1, 0)].sid == 2 and out[(1, 0, 0)].action == "deeper"


def test_rewrite_text_with_hot_key(spark):
    key, new = "a" * 40, "b" * 40
    df = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, F.lit(f"x /attachment/{key}/ y")).otherwise(F.lit("plain")).alias("t"))
    cw = crosswalk(spark, [("attachment", "*", key, new)])
    out = lk.rewrite_text(df, cw, ["id"], ["t"]).collect()
    assert len(out) == 300 and sum(new in r.t for r in out) == 200 and not any(key in r.t for r in out)
    none = lk.rewrite_text(df, cw.where("false"), ["id"], ["t"]).collect()
    assert sum(key in r.t for r in none) == 200


def test_overlay_lists(spark):
    s = spark.sql("select 1 as id, array(1,2) as steps, array(1,2) as files, 'a' as x")
    d = spark.sql("select 1 as id, array(3,4) as steps, array(3,4) as files, cast(null as string) as x, 9 as extra")
    r = ov.overlay(s, d, ["id"], ("steps",), ("files",), size=F.size).first()
    assert (r.steps, r.files, r.x, r.extra) == ([3, 4], [1, 2], "a", 9)


def test_unmapped_plan_is_rejected(spark):
    rows = spark.sql("select 'P' as project_code, 1L as id, 't' as title, '' as description, parse_json('[{\"case_id\":5}]') as cases union all"
                     " select 'P', 2L, 't', '', parse_json('[{\"case_id\":6}]')")
    out = pj.plans(rows, crosswalk(spark, [("case", "P", "6", "60")]))
    assert [r.source_id for r in out["payload"].collect()] == [2]
    assert [(r.source_key, r.reason) for r in out["rejects"].collect()] == [("1", "no mapped case")]


def test_no_python_rows_and_no_cartesian_in_plans(spark):
    df = spark.range(10).select("id", F.lit("x").alias("t"))
    cw = crosswalk(spark, [("attachment", "*", "a" * 40, "b" * 40)])
    plan = lk.rewrite_text(df, cw, ["id"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# what must not be lost, and what must not be created twice


def test_users_sharing_an_email(spark):
    from relink.plans import workspace as ws

    rows = [(1, "A@x", False), (2, "a@x", True), (3, "b@x", True), (4, "b@x", False), (5, "c@x", False), (6, None, True), (7, "d@x", None)]
    source = spark.createDataFrame(rows, "id long, email string, is_active boolean").selectExpr(
        "*", "'n' as name", "'' as role", "'' as uuid", "'' as author_uuid")
    target = spark.createDataFrame([], "id long, email string")
    plan = ws.users(source, target)
    got = {r.id: (r.outcome, r.created_from, r.target_key) for r in plan["rows"].collect()}
    assert got == {1: ("defaulted", None, "1"), 2: ("to_create", 2, None), 3: ("to_create", 3, None), 4: ("reuse_new", 3, None),
                   5: ("defaulted", None, "1"), 6: ("invalid", None, None), 7: ("to_create", 7, None)}
    made = spark.createDataFrame([(2, 92), (3, 93), (3, 93)], "source_id long, target_key long")
    from relink.operators import crosswalk as cx
    added = cx.apply_created(plan["rows"], made, "user")
    assert {(r.source_key, r.target_key) for r in added.collect()} == {("2", "92"), ("3", "93"), ("4", "93")}
    whole = cx.extend(plan["crosswalk"], added)
    assert {r.source_key: r.target_key for r in whole.collect()} == {"1": "1", "2": "92", "3": "93", "4": "93", "5": "1"}


def test_shared_parameters_without_values(spark):
    from pyspark.sql import functions as F
    from relink.plans import workspace as ws

    rows = [("1", "T", "[]"), ("2", "t ", '[{"title":"a","values":["x"]}]'), ("3", "T", "[]"), ("4", "U", "[]"), ("5", "", '[{"title":"a","values":["x"]}]')]
    source = spark.createDataFrame(rows, "id string, title string, p string").select(
        "id", "title", F.lit("single").alias("type"), F.parse_json("p").alias("parameters"), F.lit(True).alias("is_enabled_for_all_projects"),
        F.array(F.lit("P")).alias("project_codes"))
    none = spark.createDataFrame([], "entity string, scope string, source_key string, target_key string")
    plan = ws.shared_parameters(source, spark.createDataFrame([], "id string, title string"), none)
    assert [r.source_id for r in plan["payload"].collect()] == ["2"]
    assert {(r.source_key, r.reason) for r in plan["rejects"].collect()} == {("1", "no usable values"), ("4", "no usable values"), ("5", "no id or title")}
    assert {r.id: r.created_from for r in plan["rows"].where("outcome = 'reuse_new'").collect()} == {"3": "2"}


def test_steps_of_any_depth(spark):
    from pyspark.sql import functions as F
    from relink.operators import overlay as ov

    tree = '[{"action":"a","steps":[{"action":"b","steps":[{"action":"c","steps":[{"action":"d"}]}]}]}]'
    df = spark.createDataFrame([(1, tree), (2, None), (3, "[]")], "id int, s string").select("id", F.parse_json("s").alias("s"))
    got = {(r.id, tuple(r.path), r.action) for r in ov.explode_steps(df, ["id"], "s").collect()}
    assert got == {(1, (0,), "a"), (1, (0, 0), "b"), (1, (0, 0, 0), "c"), (1, (0, 0, 0, 0), "d")}


def test_batches_keep_rows_without_queue_or_size(spark):
    from relink.operators import batching as ba

    rows = [(None, 1, 5), (None, 2, 5), ("q", 1, None), ("q", 2, 3), ("q", 3, 3), ("q", 4, 99)]
    df = spark.createDataFrame(rows, "queue string, k int, n long")
    out = ba.upload_plan(df, "queue", ["k"], "n", max_n=10, max_bytes=50, lone_bytes=50)
    got = {(r.queue, r.k): (r.batch, r.turn) for r in out.collect()}
    assert got == {(None, 1): (0, 0), (None, 2): (0, 0), ("q", 1): (0, 1), ("q", 2): (1, 1), ("q", 3): (1, 1), ("q", 4): (2, 1)}


def test_attachments_list_what_cannot_move(spark):
    from relink.operators import harvest as hv
    from relink.plans import workspace as ws

    keys = [("a" * 31 + str(i)) for i in range(4)]
    docs = spark.createDataFrame([("S1", keys[0]), ("S1", keys[1]), ("S2", keys[2]), ("S1", keys[3])], "source string, k string").selectExpr(
        "source", "concat('see /attachment/', k, '/ x') as text", "k as doc_id")
    refs = hv.all_refs(hv.harvest_refs(docs, "source", [hv.text_refs("text")], 0, "doc_id"))
    order = spark.createDataFrame([("S1", 1, "T1")], "scope string, ordinal int, target_code string")
    sizes = spark.createDataFrame([(keys[0], 10), (keys[1], None), (keys[2], 10)], "key string, n_bytes long")
    none = spark.createDataFrame([], "entity string, scope string, source_key string, target_key string")
    plan = ws.attachments(refs, spark.createDataFrame([], "key string"), none, order, sizes)
    sent = {r.key for r in plan["payload"].collect()}
    back = {r.source_key: r.reason for r in plan["rejects"].collect()}
    assert sent == {keys[0]} and back == {keys[1]: "size unknown", keys[2]: "no listed project", keys[3]: "size unknown"}


def test_completeness_counts_keys_and_bad_pages(spark):
    from relink.sources import pages as pg

    def body(ids, total):
        return '{"status":true,"result":{"total":%d,"entities":[%s]}}' % (total, ",".join('{"id":%d}' % i for i in ids))

    rows = [("case", "A", body([1, 2], 4)), ("case", "A", body([1, 2], 4)), ("case", "B", body([1], 1)), ("case", "C", body([1], 1)), ("case", "C", "not json"),
            ("case", "D", '{"status":false}'), ("case", "E", body([], 0))]
    pages = spark.createDataFrame(rows, "entity string, project_code string, body string")
    expected = spark.createDataFrame([("case", "A"), ("case", "F")], "entity string, project_code string")
    got = {r.project_code: (r.landed, r.declared, r.n_pages, r.n_bad, r.complete) for r in pg.audit_pages(pages, expected=expected).collect()}
    assert got == {"A": (2, 4, 2, 0, False), "B": (1, 1, 1, 0, True), "C": (1, 1, 2, 1, False), "D": (0, None, 1, 1, False), "E": (0, 0, 1, 0, True), "F": (0, None, 0, 0, False)}
    assert {(r.scope, r.reason) for r in pg.page_rejects(pages).collect()} == {("C", "page not parsable"), ("D", "page reports failure")}


def test_numbering_by_pieces(spark):
    from pyspark.sql import functions as F
    from relink.operators import ranking as rk

    n = 20_000
    df = spark.range(n).select(F.concat(F.lit("a common prefix of some length/"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(10 ** 12)).cast("string"), 12, "0")).alias("k"),
                               F.when(F.col("id") % 10 == 0, F.lit("small")).when(F.col("id") % 10 == 1, None).otherwise(F.lit("big")).alias("s"), "id")
    out = rk.number_rows(df, ["s"], ["k", "id"], piece=1000)
    plain = out.selectExpr("rank", "row_number() over (partition by s order by k, id) as want").where("rank <> want").count()
    assert plain == 0 and out.count() == n
    bounds = rk._bounds(df.selectExpr("coalesce(s, '\\0') as _scope", "k", "id"), F.struct("k", "id"), 1000)
    assert set(bounds) == {"big", "small", "\0"} and len(bounds["big"]) == 15
    tens = df.where("s = 'big'").rdd.map(lambda r: sum(b.k <= r.k for b in bounds["big"])).countByValue()
    assert max(tens.values()) < 2500


def test_greedy_pairing_keeps_few_keys(spark):
    from relink.operators import pairing as pa

    sent = spark.createDataFrame([("c", 0, "s0", 7, "x"), ("c", 1, "s1", None, "T"), ("c", 2, "s2", None, " "), ("d", 0, "s3", 1, "y")],
                                 "chunk string, pos int, hash string, case_id long, title string")
    fresh = [("c", 5, "k5", 9, "T"), ("c", 1, "k1", 8, "U"), ("c", 3, "k3", 7, "x"), ("c", 4, "k4", 7, None), ("c", 2, "k2", 6, "")] + [("d", i, f"z{i}", i, "t") for i in range(2000)]
    keys = spark.createDataFrame(fresh, "chunk string, at int, target string, case_id long, title string")
    got = {r.source_key: r.target_key for r in pa.pair_greedily(sent, keys, ["chunk"], "pos", "hash", "at", "target").collect()}
    assert got == {"s0": "k3", "s1": "k2", "s2": "k1", "s3": "z1"}


def test_duplicate_crosswalk_rows_end_no_job(spark):
    from pyspark.sql import functions as F
    from relink.operators import links as lk

    cw = spark.createDataFrame([("e", "*", "1", "a"), ("e", "*", "1", "b"), ("e", "*", "2", "c")], "entity string, scope string, source_key string, target_key string")
    df = spark.createDataFrame([(1, ["1", "2", "3"])], "id int, ks array<string>")
    out = lk.resolve_refs(df, cw, ["id"], {"e": F.col("ks")}, out="m")
    assert out.select(lk.remap_list("ks", "m", "e").alias("x")).first().x == ["b", "c"]


def test_emptied_slices_and_late_files(spark, tmp_path):
    from relink.sinks import tables
    from relink.sources import snapshots as sn
    from relink.streaming import trace

    rows = [("case", "P", "1", "a"), ("plan", "P", "1", "b"), ("case", "Q", "1", "c")]
    kind = "entity string, scope string, source_key string, target_key string"
    tables.save_crosswalk(spark.createDataFrame(rows, kind), str(tmp_path / "cw"))
    tables.replace_scope(spark.createDataFrame([("case", "P", "2", "d")], kind), str(tmp_path / "cw"), "P")
    got = {tuple(r) for r in sn.read_crosswalk(spark, str(tmp_path / "cw")).select("entity", "scope", "source_key", "target_key").collect()}
    assert got == {("case", "P", "2", "d"), ("case", "Q", "1", "c")}

    ddl = f"{kind}, at long"
    for turn, at, target in ((0, 9, "new"), (1, 3, "old")):
        spark.createDataFrame([("user", "*", "1", target, at), ("user", "*", str(turn + 5), "x", at)], ddl).write.json(str(tmp_path / f"in/{turn}"))
        stream = spark.readStream.schema(ddl).json(str(tmp_path / "in/*"))
        trace.upsert_crosswalk(stream, str(tmp_path / "up"), str(tmp_path / f"progress{turn}"), ["at"])
    got = {(r.source_key, r.target_key) for r in sn.read_crosswalk(spark, str(tmp_path / "up")).collect()}
    assert got == {("1", "new"), ("5", "x"), ("6", "x")}


def test_results_known_by_result_hash_only(spark):
    from pyspark.sql import functions as F
    from relink.catalog.base import entity_of
    from relink.plans import project as pj

    base = spark.createDataFrame([(1, "h1"), (2, "h2")], "i int, h string")
    rows = entity_of(base, "result", F.lit("P"), run_id="cast(1 as bigint)", hash="if(i = 1, h, null)", result_hash="if(i = 2, h, null)", case_id="5", comment="concat('c', i)")
    details = entity_of(base, "result", F.lit("P"), result_hash="h", comment="concat('detail ', i)")
    cases = entity_of(base.where("i = 1"), "case", F.lit("P"), id="cast(5 as bigint)", title="'t'")
    cw = spark.createDataFrame([("case", "P", "5", "55")], "entity string, scope string, source_key string, target_key string")
    out = pj.results(rows, details, cases, cw)["payload"]
    assert {(r.hash, r.target_case_id, r.message) for r in out.collect()} == {("h1", 55, "detail 1"), ("h2", 55, "detail 2")}


def test_entities_see_what_came_before(spark):
    from relink.catalog.base import entity_of
    from relink.plans import whole

    users = spark.createDataFrame([(1, "a@x"), (2, "b@x")], "i long, e string")
    groups = spark.createDataFrame([("7", "G", ["1", "2"])], "id string, displayName string, members array<string>")
    landed = {"user": entity_of(users, "user", None, id="i", email="e", is_active="true", name="e"),
              "group": groups}
    target = {"user": spark.createDataFrame([(91, "a@x")], "id long, email string"), "group": spark.createDataFrame([], "id long, displayName string")}
    none = spark.createDataFrame([], CROSSWALK)
    made = {"user": spark.createDataFrame([(2, 92)], "source_id long, target_key long")}
    plans = whole.workspace_entities(landed, target, none, created=made)
    assert {(r.member, r.target_user) for r in plans["group"]["members"].collect()} == {("1", "91"), ("2", "92")}
    assert {(r.entity, r.source_key, r.target_key) for r in plans["crosswalk"]["crosswalk"].collect()} == {("user", "1", "91"), ("user", "2", "92")}
    assert whole.workspace_entities(landed, target, none)["group"]["members"].count() == 1
