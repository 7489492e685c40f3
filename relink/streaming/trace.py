"""The append-only trace as a stream: ingest, windowed counts, replay-safe ingest, crosswalk upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..lineage import cut, work_path
from ..operators.ranking import first_per_key, orderable
from ..schemas import TRACE
from ..sinks import store


def trace_stream(spark: SparkSession, path: str, ddl: str = TRACE, fmt: str = "json", files: int = 1000) -> DataFrame:
    """New trace files as they land, at most ``files`` per batch."""
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", files).format(fmt).load(path)


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per tumbling window and type; rows later than ``late`` are dropped."""
    w = F.window("ts", width)
    return (events.withWatermark("ts", late).groupBy(w.alias("w"), "event")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event", "n"))


def once_per_id(rows: DataFrame, row_id: str, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Retried rows pass once: the id is the idempotency key."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([row_id])


def write_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has landed, then stop. Files and checkpoint live on shared storage."""
    (stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start(path).awaitTermination())


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Drain a stream into a table under the shared folder and read it back."""
    spark = stream.sparkSession
    path = work_path(spark, label)
    write_table(stream, path, work_path(spark, f"{label}-progress"))
    return spark.read.schema(stream.schema).parquet(path)


def upsert_crosswalk(stream: DataFrame, path: str, checkpoint: str, order: list[str]) -> None:
    """Fold each micro-batch of (entity, scope, source_key, target_key, order...) into the crosswalk.

    The order columns are stored with each pair, and of the stored and the new pair of a key the later in order stays, so
    files that land late change nothing. A batch writes its own pairs only (`sinks.store`); a replayed batch is known by
    its number and changes nothing either.
    """
    def fold(batch: DataFrame, number: int) -> None:
        store.upsert(batch, path, order, tag=(checkpoint, number))

    (stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


# Streams that lose nothing: each micro-batch writes a folder of its own below ``path``, again if it is run again, and reads
# what the batches before it wrote. A batch counts as done once its last folder is complete.

def _done(spark: SparkSession, path: str, before: int) -> int | None:
    """The last complete batch with a smaller number."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    done = [int(n[6:]) for n in names if n.startswith("batch=") and n[6:].isdigit()
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return max((n for n in done if n < before), default=None)


COUNT = "window_start timestamp, window_end timestamp, event string, n bigint"


def counts_and_late(stream: DataFrame, path: str, checkpoint: str, width: str = "1 hour", late: str = "10 minutes", ts: str = "ts", event: str = "event") -> None:
    """Events per tumbling window and type, and every event that came too late for its window, with the reason.

    After a batch the watermark is the greatest time seen less ``late``; windows that end by then are closed. Writes below ``path``:
    `closed` (final counts), `open` (counts of windows still open after a batch; the last batch's are current), `late` (the events
    of closed windows and events without a time, with `reason`) and `mark` (greatest time seen). Closed + open counts + late
    rows = all rows, after every batch. What is kept between batches is one row for each open window and type.
    """
    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = _done(spark, f"{path}/mark", number)
        mark = None if last is None else spark.read.schema("seen timestamp").parquet(f"{path}/mark/batch={last}").first()[0]
        at = F.coalesce(F.col(ts).cast("timestamp"), F.timestamp_seconds(F.lit(0)))  # a window of no time would drop the row
        rows = cut(batch.withColumn("_w", F.window(at, width)))
        limit = F.lit(mark).cast("timestamp") - F.expr(f"interval {late}")
        passed = F.coalesce(F.col("_w.end") <= limit, F.lit(False))
        reason = F.when(F.col(ts).isNull(), "no time").when(passed, "window closed")
        judged = rows.withColumn("reason", reason)
        judged.where("reason is not null").select(*batch.columns, "reason").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        fresh = judged.where("reason is null").groupBy(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), F.col(event).alias("event")).agg(
            F.count(F.lit(1)).alias("n"))
        if last is not None:
            fresh = fresh.unionByName(spark.read.schema(COUNT).parquet(f"{path}/open/batch={last}"))
        counts = cut(fresh.groupBy("window_start", "window_end", "event").agg(F.sum("n").alias("n")))
        seen = rows.agg(F.max(F.col(ts).cast("timestamp")).alias("seen")).select(F.greatest("seen", F.lit(mark).cast("timestamp")).alias("seen"))
        now = cut(seen)
        closes = F.coalesce(F.col("window_end") <= F.lit(now.first()[0]).cast("timestamp") - F.expr(f"interval {late}"), F.lit(False))
        counts.where(closes).write.mode("overwrite").parquet(f"{path}/closed/batch={number}")
        counts.where(~closes).write.mode("overwrite").parquet(f"{path}/open/batch={number}")
        now.coalesce(1).write.mode("overwrite").parquet(f"{path}/mark/batch={number}")

    (stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(window_start, window_end, event, n, closed) after the last complete batch."""
    last = _done(spark, f"{path}/mark", 1 << 62)
    if last is None:
        return spark.createDataFrame([], f"{COUNT}, closed boolean")
    closed = spark.read.schema(f"{COUNT}, batch bigint").parquet(f"{path}/closed").where(F.col("batch") <= last).drop("batch")
    return closed.withColumn("closed", F.lit(True)).unionByName(
        spark.read.schema(COUNT).parquet(f"{path}/open/batch={last}").withColumn("closed", F.lit(False)))


def read_late(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Late events with their reason; ``ddl`` has the stream's columns."""
    last = _done(spark, f"{path}/mark", 1 << 62)
    if last is None:
        return spark.createDataFrame([], f"{ddl}, reason string")
    return spark.read.schema(f"{ddl}, reason string, batch bigint").parquet(f"{path}/late").where(F.col("batch") <= last).drop("batch")


def once_ever(stream: DataFrame, path: str, checkpoint: str, row_id: str, ts: str = "ts") -> None:
    """Rows pass once by id, however much later they are sent again and across restarts.

    A row sent again carries its own time, so only rows of the same day can be it: passed rows are stored by day (`day`), and a batch
    is compared with the days it has, by an anti-join on the id. The batch's ids are the small side, from which Spark builds a
    Bloom filter for the stored ones where that pays. Rows of one batch with one id pass once, the first by time; rows without
    an id can't be told apart and all pass. Rows without a time form a day of their own.
    """
    day = F.coalesce(F.date_format(F.col(ts).cast("timestamp"), "yyyy-MM-dd"), F.lit("none"))

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = cut(batch.withColumn("day", day))
        lone = rows.where(F.col(row_id).isNull())
        fresh = first_per_key(rows.where(F.col(row_id).isNotNull()), [row_id, "day"], [ts, *orderable(rows, [row_id, ts, "day"])])
        days = [r[0] for r in rows.select("day").distinct().collect()]  # days of one batch
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            kind = rows.schema[row_id].dataType.simpleString()
            stored = spark.read.schema(f"`{row_id}` {kind}, batch bigint, day string").parquet(path)
            seen = stored.where(F.col("day").isin(days) & (F.col("batch") < number)).select(row_id, "day")
            met = seen.join(fresh.select(row_id, "day"), [row_id, "day"], "left_semi").distinct()
            fresh = fresh.join(met, [row_id, "day"], "left_anti")
        fresh.unionByName(lone).write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={number}")

    (stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
