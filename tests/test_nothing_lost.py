"""Rows that were landed twice, lack a scope or tie: nothing is lost, doubled or overwritten."""

import random

import pytest
from pyspark.sql import functions as F

from relink.operators import hierarchy, links, overlay as ov, ranking
from relink.plans import project as pj
from relink.sources import entities as en, pages as pg

PAIRS = "entity string, scope string, source_key string, target_key string"


def test_repeated_details_change_nothing(spark):
    rows = spark.createDataFrame([("P", "a", "s", None), (None, "b", "s", None), ("P", "c", "s", None)], "scope string, key string, v string, w string")
    detail = spark.createDataFrame([("P", "a", 1, "old"), ("P", "a", 2, "new"), ("P", "a", 2, "new"), (None, "b", 1, "x"), (None, None, 1, "no")],
                                   "scope string, key string, at int, w string")
    got = ov.overlay(rows, detail, ["scope", "key"], latest=("at",)).select("key", "v", "w").collect()
    assert sorted(map(tuple, got), key=str) == [("a", "s", "new"), ("b", "s", "x"), ("c", "s", None)]


def test_null_scopes_keep_their_references(spark):
    cw = spark.createDataFrame([("user", "*", "1", "11"), ("case", "P", "5", "55"), ("case", None, "5", "66")], PAIRS)
    df = spark.createDataFrame([("P", 1, 1, 5), (None, 2, 1, 5), (None, None, 1, 5), ("Q", 3, 1, 5)], "p string, id int, u int, c int")
    refs = {"user": F.array(F.col("u").cast("string")), "case": F.array(F.col("c").cast("string"))}
    got = links.resolve_refs(df, cw, ["p", "id"], refs, "p", workspace=("user",))
    assert got.columns == ["p", "id", "u", "c", "targets"]
    out = [(r.id, *(dict(r.targets or {}).get(f"{e}\u001f{k}") for e, k in (("user", "1"), ("case", "5")))) for r in got.collect()]
    assert sorted(out, key=str) == [(1, "11", "55"), (2, "11", "66"), (3, "11", None), (None, None, None)]


def test_repeated_nodes_are_walked_once(spark):
    rows = [("P", 1, None), ("P", 2, 1), ("P", 3, 2), ("P", 4, 3), ("P", 1, None), ("P", 2, 1), (None, 1, None), (None, 2, 1), ("P", None, 1), ("P", 9, 8)]
    got = hierarchy.expand(spark.createDataFrame(rows, "p string, id int, up int"), "id", "up", ["p"])
    assert sorted(((r.p, r.id, r.state, r.depth) for r in got.collect()), key=str) == sorted(
        [("P", 1, "reached", 0), ("P", 2, "reached", 1), ("P", 3, "reached", 2), ("P", 4, "reached", 3), (None, 1, "reached", 0), (None, 2, "reached", 1),
         ("P", None, "unreachable", None), ("P", 9, "unreachable", None)], key=str)


def test_overlapping_pages_give_each_row_once(spark):
    body = '{"status": true, "result": {"total": 3, "entities": [%s]}}'
    pages = spark.createDataFrame([
        ("suite", "P", 0, "2024-01-01", body % '{"id": 1, "title": "a"}, {"id": 2, "title": "b"}'),
        ("suite", "P", 2, "2024-01-02", body % '{"id": 2, "title": "b, moved"}, {"id": 3}, {"title": "no id"}, {"title": "no id"}'),
        ("suite", None, 0, "2024-01-01", body % '{"id": 2, "title": "other"}')], "entity string, project_code string, page_offset int, fetched_at string, body string")
    got = sorted(((r.project_code, r.id, r.title) for r in en.suites(pages).collect()), key=str)
    assert got == sorted([("P", 1, "a"), ("P", 2, "b, moved"), ("P", 3, None), ("P", None, "no id"), ("P", None, "no id"), (None, 2, "other")], key=str)
    assert pg.entity_rows(pages, "suite", dedupe=False).count() == 7


@pytest.mark.parametrize("kind", ["one key", "equal rows", "distinct"])
def test_numbers_survive_ties(spark, kind):
    """One scope of 60,000 rows in pieces of 2,000: gapless numbers in order, no piece much larger than asked, few rows collected."""
    n = 60_000
    key = {"one key": F.lit(7), "equal rows": F.lit(7), "distinct": F.xxhash64("id")}[kind]
    df = spark.range(n).select(F.lit("s").alias("s"), key.alias("k"), *([] if kind == "equal rows" else ["id"]))
    out = ranking.number_rows(df, ["s"], ["k"], piece=2_000)
    rows = [(r["rank"], r.k) for r in out.collect()]
    assert sorted(r for r, _ in rows) == list(range(1, n + 1))
    assert [k for _, k in sorted(rows)] == sorted(k for _, k in rows)
    tasks = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) > 1


def test_pieces_of_one_key_are_small(spark):
    n, piece = 200_000, 5_000
    df = spark.range(n).select(F.lit("s").alias("_scope"), F.lit(1).alias("k"), "id")
    key = F.struct("k", F.xxhash64("k", "id").alias("_tie"))
    bounds = ranking._bounds(df, key, piece)["s"]
    assert len(bounds) == n // piece - 1 and len(set(bounds)) == len(bounds)
    ties = sorted(r[0] for r in df.select(F.xxhash64("k", "id")).collect())
    cuts = [0] + [sum(t < b["_tie"] for t in ties) for b in bounds] + [n]
    assert max(b - a for a, b in zip(cuts, cuts[1:])) < 2 * piece


def test_number_rows_of_many_scopes(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "b", "b"]), rng.choice([None, *range(40)])) for _ in range(3_000)]
    got = ranking.number_rows(spark.createDataFrame(rows, "s string, k int"), ["s"], ["k"], piece=200).collect()
    for s in (None, "a", "b"):
        mine = sorted((r["rank"], -1 if r.k is None else r.k) for r in got if r.s == s)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and [m[1] for m in mine] == sorted(m[1] for m in mine)


def test_suites_plan_accounts_for_every_row(spark):
    rows = spark.createDataFrame([("P", 1, None, "a"), ("P", 1, None, "a"), (None, 5, None, "b"), ("P", None, None, "c"), ("P", 3, 99, "d"), ("P", 4, 1, "e")],
                                 "project_code string, id long, parent_id long, title string")
    rows = rows.selectExpr("*", "cast(null as string) as name", "cast(null as string) as description", "cast(null as string) as preconditions")
    cw = spark.createDataFrame([], PAIRS)
    plan = pj.suites(rows, cw)
    sent = [(r.project_code, r.source_id) for r in plan["payload"].collect()]
    gone = [(r.scope, r.source_key) for r in plan["rejects"].collect()]
    assert sorted(sent, key=str) == sorted([("P", 1), (None, 5), ("P", 4)], key=str) and sorted(gone, key=str) == sorted([("P", None), ("P", "3")], key=str)
