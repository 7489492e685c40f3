"""Streaming over the trace events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..lineage import work_path
from ..sources import snapshots as sn
from ..streaming import trace as tr
from .base import query

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def stream_of(spark, sf):
    """The events table as a file stream."""
    return spark.readStream.schema(EVENTS).parquet(f"{sf}/events*.parquet")


@query("t01_trace_ingest", "select event_type as event, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, event_id as source_run_id from events")
def t01(spark, sf):
    rows = stream_of(spark, sf).select(F.col("event_type").alias("event"), "ts", F.col("event_id").alias("source_run_id"))
    out = tr.run_to_table(rows, "ingest")
    return out.select("event", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "source_run_id")


@query("t02_windowed_counts", """
with w as (select time_bucket(interval 6 hours, ts) as s, event_type as event, count(*) as n from events group by 1, 2)
select strftime(s, '%Y-%m-%d %H:%M') as window_start, event, n from w where s + interval 6 hours <= (select max(ts) - interval 10 minutes from events)""")
def t02(spark, sf):
    rows = stream_of(spark, sf).select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("event"))
    out = tr.run_to_table(tr.event_counts(rows, "6 hours"), "counts")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event", "n")


@query("t03_replay_safe_ingest", "select user_id || ':' || event_type as id, count(distinct user_id) as n from events group by 1")
def t03(spark, sf):
    once = stream_of(spark, sf).select(F.expr("concat(user_id, ':', event_type)").alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    out = tr.run_to_table(tr.once_per_id(once, "id", late="60 days"), "once")
    return out.groupBy("id").agg(F.count("*").alias("n"))


@query("t04_crosswalk_upsert", """
select 'user' as entity, event_type as scope, user_id::varchar as source_key, max(event_id)::varchar as target_key from events group by 2, 3""")
def t04(spark, sf):
    path, progress = work_path(spark, "upsert"), work_path(spark, "upsert-progress")
    rows = stream_of(spark, sf).select(F.lit("user").alias("entity"), F.col("event_type").alias("scope"), F.col("user_id").cast("string").alias("source_key"),
                                       F.col("event_id").cast("string").alias("target_key"), F.col("event_id").alias("at"))
    tr.upsert_crosswalk(rows, path, progress, ["at"])
    return sn.read_crosswalk(spark, path).select("entity", "scope", "source_key", "target_key")


def landed_in_turns(spark, sf, turns):
    """The events as files that land one after the other: turn k holds the rows of expression k."""
    path = work_path(spark, "turns")
    rows = spark.read.schema(EVENTS).parquet(f"{sf}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("event"), "event_id")
    for k, where in enumerate(turns):
        rows.where(where).coalesce(1).write.parquet(f"{path}/turn={k}")
    return spark.readStream.schema("ts timestamp, event string, event_id bigint").option("maxFilesPerTrigger", 1).parquet(f"{path}/turn=*")


@query("t02b_counts_and_late", """
with b as (select *, event_id % 3 as turn, time_bucket(interval 6 hours, ts) as s from events),
seen as (select max(ts) filter (where turn = 0) - interval 10 minutes as m0, max(ts) filter (where turn <= 1) - interval 10 minutes as m1, max(ts) - interval 10 minutes as m2 from b),
j as (select b.*, s + interval 6 hours <= case turn when 1 then m0 when 2 then m1 end as is_late, s + interval 6 hours <= m2 as is_closed from b, seen)
select case when is_late then 'late' when is_closed then 'closed' else 'open' end as kind, strftime(s, '%Y-%m-%d %H:%M') as window_start, event_type as event, count(*) as n
from j group by all""")
def t02b(spark, sf):
    path = work_path(spark, "late")
    stream = landed_in_turns(spark, sf, [f"event_id % 3 = {k}" for k in range(3)])
    tr.counts_and_late(stream, path, work_path(spark, "late-progress"), "6 hours")
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start")
    counted = tr.read_counts(spark, path).select(F.when(F.col("closed"), "closed").otherwise("open").alias("kind"), start, "event", "n")
    late = tr.read_late(spark, path, "ts timestamp, event string, event_id bigint").groupBy(F.window("ts", "6 hours").alias("w"), "event").agg(F.count("*").alias("n"))
    return counted.unionByName(late.select(F.lit("late").alias("kind"), F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("window_start"), "event", "n"))


@query("t03b_once_ever", "select event_type as event, count(*) as n, sum(event_id)::bigint as ids from events group by 1")
def t03b(spark, sf):
    """All rows of the first half come again with the second half, and everything again at the end."""
    path = work_path(spark, "once")
    stream = landed_in_turns(spark, sf, ["event_id % 2 = 0", "true", "event_id % 3 = 0"])
    tr.once_ever(stream, path, work_path(spark, "once-progress"), "event_id")
    rows = spark.read.schema("event string, event_id bigint, batch bigint, day string").parquet(path)
    return rows.groupBy("event").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
