"""What stays on disk and what is shuffled: files of ended jobs go, rows that belong together meet once."""

import glob
import re

from pyspark.sql import functions as F

from relink import lineage
from relink.catalog.base import entity_of
from relink.functions import text as tx
from relink.operators import links as lk, pairing as pa
from relink.plans import project as pj, whole


def shuffle_files(spark) -> int:
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def exchanges(df) -> int:
    """Shuffles of a plan; one that is read twice counts once."""
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]))


def test_a_cut_leaves_no_shuffle_files(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    for make in (lineage.cut, lineage.stored):
        before = shuffle_files(spark)
        got = make(df.groupBy("k").agg(F.sum("id").alias("n")))
        assert sorted(map(tuple, got.collect())) == [(k, sum(range(k, 1000, 7))) for k in range(7)]
        assert shuffle_files(spark) <= before
    assert spark.conf.get(lineage.FREE_CONF) == "false"


def test_a_brief_table_is_deleted(spark):
    with lineage.briefly(spark.range(10)) as kept:
        path = kept.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        assert kept.count() == 10
    at = spark._jvm.java.io.File(path)
    assert not at.exists()


def test_packed_keys_come_back(spark, col):
    texts = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "abc", "ab", "a", "", "no key", "\u00e9", "\x01ab", "ab\x00", None, "0g"]
    assert col(texts, tx.unpacked(tx.packed("v"))) == texts
    made = col(texts, F.hex(tx.packed("v")))
    assert len({m for m in made if m is not None}) == len(texts) - 1 and len(made[0]) == 34


def test_new_keys_travel_as_bytes(spark):
    digest = [f"{i:032x}" for i in range(4)]
    before = spark.createDataFrame([(digest[0],), ("x",), (None,)], "k string")
    after = spark.createDataFrame([(1, digest[0]), (2, digest[1]), (3, digest[1]), (4, "x"), (5, "X"), (6, None)], "n int, k string")
    got = pa.new_keys(before, after, ["k"])
    assert sorted(tuple(r[c] for c in ("n", "k")) for r in got.collect()) == [(2, digest[1]), (3, digest[1]), (5, "X"), (6, None)]
    assert "unhex(k" in got._jdf.queryExecution().optimizedPlan().toString()


def test_greedy_pairing_shuffles_once(spark):
    """Rows and keys meet once, and a chunk whose rows take any key comes to a join by rank, whatever its size."""
    sent = spark.createDataFrame([("c", p, f"s{p}", None, " ") for p in range(5)] + [("d", p, f"u{p}", None, "") for p in range(2)], "c string, pos int, src string, case_id long, title string")
    keys = [("c", 9 - o, f"t{o}", o, "x") for o in range(4)] + [("d", 1, "v", 1, "x"), ("d", 2, "v", 2, "x"), ("d", 3, "w", 3, "x")]
    fresh = spark.createDataFrame(keys, "c string, at int, tgt string, case_id long, title string")
    got = pa.pair_greedily(sent, fresh, ["c"], "pos", "src", "at", "tgt")
    pairs = got.collect()
    assert {r.source_key: r.target_key for r in pairs if r.c == "c"} == {"s0": "t3", "s1": "t2", "s2": "t1", "s3": "t0"}
    assert [(r.source_key, r.target_key) for r in pairs if r.c == "d"] == [("u0", "v")]  # a key that comes twice is used once
    assert exchanges(got) <= 2
    both = pa._marked(sent.selectExpr("c", "0 as _side", "src as _key", "case_id as _case", "'' as _title").unionByName(
        fresh.selectExpr("c", "1 as _side", "tgt as _key", "case_id as _case", "title as _title")), ["c"])
    assert {(r.c, r._any_key) for r in both.collect()} == {("c", True), ("d", False)}


def landed_results(spark):
    """A row that comes twice, one without a hash, one whose steps and texts come from its detail and its case."""
    base = spark.createDataFrame([(1, "h1", 5), (1, "h1", 5), (1, None, 5), (2, "0" * 31 + "a", 6)], "run long, h string, c long")
    key = "a" * 32
    rows = entity_of(base, "result", F.lit("P"), run_id="run", hash="h", case_id="c", status_id="1", comment=f"concat('see /attachment/{key}/ ', run)",
                     member_id="7", steps="array(named_struct('action', concat('own', run)))", params="named_struct('n', run)")
    details = entity_of(base.where("run = 2"), "result", F.lit("P"), hash="h", stacktrace="'at x'", steps="array(named_struct('action', 'a'), named_struct('action', 'b'))")
    cases = entity_of(base.select("c").distinct(), "case", F.lit("P"), id="c", suite_title="'S'", steps="array(named_struct('action', 'x', 'steps', array(named_struct('action', 'y'))))")
    cw = spark.createDataFrame([("case", "P", "5", "55"), ("user", "*", "7", "77"), ("attachment", "P", key, "b" * 32)], "entity string, scope string, source_key string, target_key string")
    return rows, details, cases, cw


def written_columns(spark, label: str) -> list[str]:
    path = max(glob.glob(f"{lineage.run_path(spark).removeprefix('file:')}/{label}-*"), key=lambda p: spark._jvm.java.io.File(p).lastModified())
    return spark.read.parquet(path).columns


def test_results_write_what_is_sent_only(spark):
    rows, details, cases, cw = landed_results(spark)
    plan = pj.results(rows, details, cases, cw)
    kept = written_columns(spark, "results")
    assert not {"steps", "_steps", "_case_steps", "execution", "attachments", "params", "case"} & set(kept) and len(kept) < 30
    got = sorted(((r.run_id, r.hash, r.target_case_id, r.title, r.author, r.message, r.stacktrace, r.attachments) for r in plan["payload"].collect()), key=str)
    new, old = "see /attachment/" + "b" * 32 + "/ 1", "see /attachment/" + "a" * 32 + "/ 1"
    assert got == sorted([(1, "h1", 55, "Automated Test 5", None, new, None, [])] * 2 + [(1, None, None, "Automated Test 5", "1", old, None, [])] + [
        (2, "0" * 31 + "a", None, "Automated Test 6", "77", new[:-1] + "2", "at x", [])], key=str)


def test_result_steps_write_two_slim_tables(spark):
    rows, details, cases, cw = landed_results(spark)
    got = pj.results(rows, details, cases, cw)["steps"]
    assert written_columns(spark, "enriched") == ["project_code", "_hash", "_ps", "_steps", "_case_steps"]
    mine = sorted((tuple(r.path), r.action, r.origin) for r in got.collect() if r.hash == "0" * 31 + "a")
    assert mine == [((0,), "a", "result"), ((0, 0), "y", "synthetic"), ((1,), "b", "result")]
    assert got.where("hash = 'h1' and size(path) = 1").count() == 4 and got.where("hash is null").count() == 3


def test_references_travel_as_bytes(spark):
    digest = "0123456789abcdef" * 2
    cw = spark.createDataFrame([("e", "*", digest, digest[::-1]), ("e", "*", digest, "zz"), ("e", "*", "AB", "x")], "entity string, scope string, source_key string, target_key string")
    df = spark.createDataFrame([(1, [digest, "ab"]), (2, ["AB"]), (3, None)], "id int, ks array<string>")
    got = lk.resolve_refs(df, cw, ["id"], {"e": F.col("ks")}, out="m")
    assert {r.id: r.m for r in got.collect()} == {1: {f"e\u001f{digest}": "zz"}, 2: {"e\u001fAB": "x"}, 3: None}
    assert "unhex" in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_project_plan_that_reads_no_steps_writes_none(spark):
    rows, details, cases, cw = landed_results(spark)
    tables = lambda: set(glob.glob(f"{lineage.run_path(spark).removeprefix('file:')}/*"))
    before = tables()
    plans = whole.project_entities({"result": rows, "result_detail": details, "result_case": cases, "case": cases}, cw)
    got = whole.plan_summary({"result": rows}, {"result": plans["result"]}, contents={"result": ["hash", "target_case_id"]}).collect()
    assert {(r.scope, r.entity, r.landed, r.planned) for r in got} == {("P", "result", 4, 4), ("P", "(all)", 4, 4), ("(all)", "(all)", 4, 4)}
    made = {p.rsplit("/", 1)[1].split("-")[0] for p in tables() - before}
    assert made == {"results"}
