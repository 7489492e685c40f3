"""Streams that lose nothing, ids of their own, nested caps, page coverage and load waves."""

import json
import random

import pytest
from pyspark.sql import functions as F

from relink.functions import shapes as sh
from relink.operators import crosswalk as cx, hierarchy, waves
from relink.operators.coverage import gaps, overlaps
from relink.sources import pages as pg
from relink.streaming import trace as tr

ROW = "ts timestamp, event string, event_id bigint"


def land(spark, path, turn, rows):
    df = spark.createDataFrame(rows, "ts string, event string, event_id bigint").withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(1).write.parquet(f"{path}/turn={turn}")


def stream(spark, path):
    return spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(f"{path}/turn=*")


def test_late_rows_are_listed_and_nothing_is_lost(spark, tmp_path):
    src, out, progress = (str(tmp_path / x) for x in ("src", "out", "progress"))
    land(spark, src, 0, [("2024-01-01 00:10:00", "a", 1), ("2024-01-01 02:30:00", "a", 2), (None, "a", 3)])
    tr.counts_and_late(stream(spark, src), out, progress)
    land(spark, src, 1, [("2024-01-01 00:20:00", "a", 4), ("2024-01-01 02:40:00", "b", 5), ("2024-01-01 02:25:00", "a", 6)])
    land(spark, src, 2, [("2024-01-01 09:00:00", "a", 7)])
    tr.counts_and_late(stream(spark, src), out, progress)  # a second run goes on where the first one ended
    counts = {(r.window_start.strftime("%H"), r.event, r.closed): r.n for r in tr.read_counts(spark, out).collect()}
    assert counts == {("00", "a", True): 1, ("02", "a", True): 2, ("02", "b", True): 1, ("09", "a", False): 1}
    late = sorted((r.event_id, r.reason) for r in tr.read_late(spark, out, ROW).collect())
    assert late == [(3, "no time"), (4, "window closed")] and sum(counts.values()) + len(late) == 7


def test_a_row_sent_again_later_passes_once(spark, tmp_path):
    src, out, progress = (str(tmp_path / x) for x in ("src", "out", "progress"))
    first = [("2024-01-01 00:10:00", "a", 1), ("2024-01-01 00:10:00", "a", 1), ("2024-01-02 00:10:00", "a", 2), ("2024-01-01 05:00:00", "x", None), (None, "n", 9)]
    land(spark, src, 0, first)
    tr.once_ever(stream(spark, src), out, progress, "event_id")
    land(spark, src, 1, [*first, ("2024-01-01 00:11:00", "late", 3)])
    land(spark, src, 2, [("2024-01-05 00:00:00", "b", 4), ("2024-01-01 00:11:00", "late", 3)])
    tr.once_ever(stream(spark, src), out, progress, "event_id")
    got = sorted(((r.event_id, r.event) for r in spark.read.schema(f"{ROW}, batch bigint, day string").parquet(out).collect()), key=str)
    assert got == sorted([(1, "a"), (2, "a"), (None, "x"), (None, "x"), (9, "n"), (3, "late"), (4, "b")], key=str)


def test_ids_are_never_given_twice(spark):
    first = [("P", i) for i in range(300)] + [("Q", i) for i in range(40)] + [("P", None), ("P", 5)]
    df = spark.createDataFrame(first, "p string, o long")
    one = cx.assign_ids(df, "o", 10, 349, by=["p"]).collect()
    assert len(one) == 340 == len({(r.p, r.made) for r in one}) and all(10 <= r.made <= 349 for r in one)
    again = cx.assign_ids(df, "o", 10, 349, by=["p"]).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))
    taken = spark.createDataFrame(one)
    more = spark.createDataFrame([("P", i) for i in range(340)], "p string, o long")  # fills the range to the last id
    two = {(r.p, r.o): r.made for r in cx.assign_ids(more, "o", 10, 349, taken, ["p"]).collect()}
    assert all(two[r.p, r.o] == r.made for r in one) and sorted(v for (p, _), v in two.items() if p == "P") == list(range(10, 350))
    alone = cx.assign_ids(more.select("o"), "o", 0, 339).collect()
    assert sorted(r.made for r in alone) == list(range(340))
    with pytest.raises(ValueError):
        cx.assign_ids(more, "o", 10, 348, by=["p"])


def nest(n, leaf='"x"'):
    return '{"a":' * n + leaf + "}" * n


def test_nested_caps(spark):
    texts = [nest(3), nest(12), nest(13), nest(30), None, "7", '"' + "y" * 30 + '"', json.dumps(list(range(9))), json.dumps({str(i): i for i in range(6)}),
             '[[["é", null, true, 1.5]]]']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("v", F.parse_json("t"))
    got = [r.c for r in df.select("i", sh.cap_nested("v", max_keys=4, max_items=5, max_chars=10).alias("c")).sort("i").collect()]
    deep = nest(13, '"<max depth>"')
    assert got == [nest(3), nest(12), deep, deep, None, "7", '"yyyyyyyyyy...<truncated 20 chars>"', '[0,1,2,3,4,"...<truncated 4 items>"]',
                   '{"0":0,"1":1,"2":2,"3":3,"_truncated_keys":2}', '[[["é",null,true,1.5]]]']


def test_gaps_and_overlaps_equal_brute_force(spark):
    rnd = random.Random(2)
    rows, totals = [], []
    for g in (None, "a", "b", "c"):
        totals.append((g, rnd.randint(50, 120)))
        rows += [(g, s, s + rnd.randint(1, 9)) for s in (rnd.randint(0, 110) for _ in range(0 if g == "c" else 14))]
    df, tot = spark.createDataFrame(rows, "g string, start long, end long"), spark.createDataFrame(totals, "g string, total long")
    import relink.operators.coverage as cov
    for span in (5, 1_000_000):
        cov.reached_before.__defaults__ = (*cov.reached_before.__defaults__[:-1], span)
        holes = {g: {x for r in gaps(df, tot, ["g"]).where(F.col("g").eqNullSafe(F.lit(g))).collect() for x in range(r.start, r.end)} for g, _ in totals}
        again = overlaps(df, ["g"]).groupBy("g").agg(F.sum(F.col("end") - F.col("start")).alias("n")).collect()
        for g, total in totals:
            covered = {x for h, s, e in rows if h == g for x in range(s, e)}
            assert holes[g] == set(range(max([total, *[x + 1 for x in covered]]))) - covered - set(range(total, 10**3))
        # what intervals cover in sum less what they cover at all
        for g, _ in totals:
            mine = [(s, e) for h, s, e in rows if h == g]
            want = sum(e - s for s, e in mine) - len({x for s, e in mine for x in range(s, e)})
            assert next((r.n for r in again if r.g == g), 0) == want


def test_coverage_of_every_kind_of_page(spark):
    def body(n, total, status="true"):
        return '{"status": %s, "result": {"total": %d, "entities": [%s]}}' % (status, total, ", ".join('{"id": %d}' % i for i in range(n)))

    pages = [("run", "P", 0, 1, body(10, 35)), ("run", "P", 10, 1, "oops"), ("run", "P", 10, 2, body(10, 45)), ("run", "P", 30, 1, body(10, 45)), ("run", "P", 25, 1, body(7, 45)),
             ("run", "Q", 0, 1, body(0, 0)), ("run", None, 0, 1, body(3, 3)), ("run", "R", 0, 1, "<html>"), ("run", "S", 0, 1, body(5, 9)), ("run", "S", 5, 1, body(2, 9, "false")),
             ("run", "S", None, 1, body(2, 9))]
    got = pg.page_coverage(spark.createDataFrame(pages, "entity string, project_code string, page_offset int, fetched_at int, body string"), limit=10)
    refetch = sorted((r.scope, r.page_offset, r.n, r.reason) for r in got["refetch"].collect())
    assert refetch == [("P", 20, 5, "never fetched"), ("P", 40, 5, "never fetched"), ("R", 0, 10, "unreadable"), ("S", 5, 4, "unreadable")]
    assert [(r.scope, r.start, r.end) for r in got["overlaps"].collect()] == [("P", 30, 32)]
    summary = {r.scope: (r.declared, r.n_missing, r.n_repeated, r.n_pages, r.complete) for r in got["summary"].collect()}
    assert summary == {"P": (45, 10, 2, 4, False), "Q": (0, 0, 0, 1, True), None: (3, 0, 0, 1, True), "R": (None, 10, 0, 1, False), "S": (9, 4, 0, 2, False)}


def test_waves_account_for_every_row_and_can_go_on(spark):
    rows = [("P", 1, None), ("P", 2, 1), ("P", 3, 2), ("P", 4, 3), ("P", 5, 1), ("P", 6, 5), (None, 1, None), (None, 2, 1), ("P", 9, 8), ("P", None, 1)]
    walked = hierarchy.expand(spark.createDataFrame(rows, "p string, id int, up int"), "id", "up", ["p"])
    none = spark.createDataFrame([("suite", "P", "5", "known")], "entity string, scope string, source_key string, target_key string")
    waves_seen = []

    def send(failing):
        def answer(wave):
            waves_seen.append(sorted((r.p or "", r.id, r.parent_target) for r in wave.collect()))
            made = wave.where(~F.col("id").isin(failing)).select("p", "id", F.concat(F.lit("t"), "id").alias("target_key"))
            return made.unionByName(made).unionByName(spark.createDataFrame([("P", 77, "stray"), ("P", failing[0], None)], "p string, id int, target_key string"))
        return answer

    plan = waves.load_waves(walked, none, "suite", "p", send([2]), parent="up")
    assert waves_seen == [[("", 1, None), ("P", 1, None)], [("", 2, "t1"), ("P", 2, "t1")], [("P", 6, "known")]]
    gone = sorted(((r.scope, r.source_key, r.reason) for r in plan["rejects"].collect()), key=str)
    assert gone == sorted([(None, "2", waves.REASONS["failed"]), ("P", "2", waves.REASONS["failed"]), ("P", "3", waves.REASONS["blocked"]), ("P", "4", waves.REASONS["blocked"]),
                           ("P", "9", waves.REASONS["lost"]), ("P", None, waves.REASONS["lost"])], key=str)
    never_sent = [g for g in gone if g[2] != waves.REASONS["failed"]]
    assert plan["payload"].count() + plan["resumed"].count() + len(never_sent) == 10
    waves_seen.clear()
    again = waves.load_waves(walked, plan["crosswalk"], "suite", "p", send([99]), parent="up")
    assert waves_seen == [[("", 2, "t1"), ("P", 2, "t1")], [("P", 3, "t2")], [("P", 4, "t3")]]
    assert sorted(r.reason for r in again["rejects"].collect()) == [waves.REASONS["lost"]] * 2
    empty = waves.load_waves(walked.limit(0), none, "suite", "p", send([1]), parent="up")
    assert empty["payload"].count() == 0 and empty["rejects"].count() == 0
