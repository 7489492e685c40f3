"""Filter interaction audit: incremental retraction streaming.

Five filters fail a document: A under 100 words, B fewer than 80 % distinct words, C over 10 % characters A-Z, D any of
`#$%&*|`, E a text that stands under a smaller doc_id. The audit says for each order of the filters, step and part (lang)
what a filter removes, what it would have removed, and what only it fails.

Method. The documents' files are a stream, drained in available-now micro-batches. A text's digest (SHA-256) keys a state
that holds the least doc_id seen and the counts of its rows. A smaller id that arrives later takes the place over: the
earlier owner's counts are retracted from its part's counter of mask m and added to that of m with E. A batch's counters are
changes (part, mask, n, good, toxic); their sums over all batches are 32 numbers for each part at most, from which all
120 orders follow; the result does not depend on the order of files, nor on how they are dealt into batches.

The state is a table in the shared folder: each batch writes the owners of the texts it has met, below its own number, and
reads those that earlier batches wrote of its texts, the latest for each. A batch that is run again, after a failure at any
point, reads the same and writes over what it wrote.

Before the shuffle by digest every task folds its rows: of a text's rows only the least id is sent as a claim, the others
can be counted at once (a smaller id exists), so a text with a third of all rows sends one claim for each task and flush.
Labels are reduced to one row for each doc_id, and join without the texts.

Defined results: a null text is empty; a null lang is the part of the empty string, as is an empty lang; a null doc_id is
smaller than none and larger than none, so E never fails it and it fails no other row; rows that share doc_id and text do not
fail E by each other and all count; labels that stand twice count if any of them is 1; no documents give no rows. Only doc_id, text and lang (of
labels doc_id, quality, toxic) are read, so other columns can't clash. Texts are read in blocks, whatever their length.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..lineage import work_path
from .common import map_batches, raw, written

LETTERS = "ABCDE"
A, B, C, D, E = (1 << i for i in range(5))
#: Micro-batches that the files are dealt into, and rows that a task folds before it sends them.
BATCHES, FOLD = 4, 50_000
BLOCK = 1 << 20
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ODD = re.compile(rb"[#$%&*|]")
FACTS = "doc_id bigint, digest binary, mask int, part string, n bigint"
CLAIMS = "key binary, id bigint, mask int, part string, n bigint, good bigint, toxic bigint, claim boolean"
CHANGES = "part string, mask int, n bigint, good bigint, toxic bigint"
OWNERS = "key binary, id bigint, mask int, part string, n bigint, good bigint, toxic bigint"


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words [^\\x20\\x09-\\x0D]+ of a text, about BLOCK bytes at a time; a word is never cut."""
    a = 0
    while a < len(text):
        b = min(len(text), a + BLOCK)
        while b < len(text) and text[b] not in b" \t\n\x0b\x0c\r":
            b += 1
        yield text[a:b].split()
        a = b


def own_mask(text: bytes) -> int:
    """Filters A to D of one text."""
    n, distinct = 0, set()
    for words in words_of(text):
        n += len(words)
        distinct.update(words)
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text.decode("utf-8", "replace"))
    return (A * (n < 100) | B * (100 * len(distinct) < 80 * n) | C * (100 * upper > 10 * points) | D * bool(ODD.search(text)))


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, int] = {}

    def out():
        ids, digests, masks, parts = zip(*held)
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(masks, pa.int32()), pa.array(parts, pa.string()),
                                pa.array(held.values(), pa.int64())], names=["doc_id", "digest", "mask", "part", "n"])

    for batch in batches:
        for i, text, part in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("part").to_pylist()):
            text = text.as_py() or b""
            key = (i, hashlib.sha256(text).digest(), own_mask(text), part)
            held[key] = held.get(key, 0) + 1
        if len(held) >= FOLD:
            yield out()
            held.clear()
    if held:
        yield out()


def _claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold a task's rows: claims of the least ids, and counts that are settled already."""
    least: dict[bytes, list] = {}
    settled: dict[tuple, list] = {}

    def settle(mask, owners):
        for part, counts in owners.items():
            add(settled, (part, mask), counts)

    def out():
        rows = [(d, i, mask, part, *counts, True) for d, (i, mask, owners) in least.items() for part, counts in owners.items()]
        here = b"%d" % TaskContext.get().partitionId()
        rows += [(here, 0, mask, part, *counts, False) for (part, mask), counts in settled.items()]
        least.clear()
        settled.clear()
        kinds = [pa.binary(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        names = ["key", "id", "mask", "part", "n", "good", "toxic", "claim"]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for i, digest, mask, part, *counts in zip(*[c.to_pylist() for c in batch.columns]):
            if i is None:
                add(settled, (part, mask), counts)
                continue
            now = least.get(digest)
            if now is None:
                least[digest] = [i, mask, {part: list(counts)}]
            elif i == now[0]:
                add(now[2], part, counts)
            elif i > now[0]:
                add(settled, (part, mask | E), counts)
            else:
                settle(mask | E, now[2])
                least[digest] = [i, mask, {part: list(counts)}]
        if len(least) + len(settled) >= FOLD:
            yield out()
    if least or settled:
        yield out()


def add(counters: dict, key, counts, sign: int = 1) -> None:
    now = counters.setdefault(key, [0, 0, 0])
    for j, x in enumerate(counts):
        now[j] += sign * x


def fold(claims: DataFrame, owners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(changes, owners) that a batch's claims bring about beside the owners that their texts had before.

    Of a text's claims, old and new, those of the least id own it. What new owners count is added as it is, other new claims fail E;
    an old owner that is not the owner any more is taken back and added as failing E."""
    columns = ["key", "id", "mask", "part", "n", "good", "toxic"]
    every = claims.select(*columns, "claim", F.lit(False).alias("old")).unionByName(
        owners.select(*columns, F.lit(True).alias("claim"), F.lit(True).alias("old")))
    least = F.min(F.when(F.col("claim"), F.col("id"))).over(Window.partitionBy("key"))
    judged = every.withColumn("owns", F.col("claim") & (F.col("id") == least))
    lost = F.col("mask").bitwiseOR(F.lit(E))

    def changed(*pairs):
        return F.array(*[F.struct(F.lit(sign).alias("sign"), mask.alias("now")) for sign, mask in pairs])

    moves = (F.when(F.col("old"), F.when(~F.col("owns"), changed((-1, F.col("mask")), (1, lost))))
             .when(F.col("owns") | ~F.col("claim"), changed((1, F.col("mask")))).otherwise(changed((1, lost))))
    rows = judged.select("part", "n", "good", "toxic", F.explode(moves).alias("c"))
    changes = rows.groupBy("part", F.col("c.now").alias("mask")).agg(*[F.sum(F.col("c.sign") * F.col(c)).alias(c) for c in ("n", "good", "toxic")])
    kept = judged.where("owns").groupBy("key", "id", "mask", "part").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    return changes, kept


def claims_of(docs: DataFrame, flags: DataFrame) -> DataFrame:
    """Claims and settled counts of documents, folded in each task; ``flags`` has doc_id (unique), good and toxic."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), raw("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    facts = map_batches(slim, _facts, FACTS).join(flags, "doc_id", "left")
    facts = facts.select("doc_id", "digest", "mask", "part", "n", *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])
    return facts.mapInArrow(_claims, CLAIMS)


def count_masks(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES, progress: str | None = None, counters: str | None = None) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters they fail, all that has landed under ``path``.

    With ``progress`` and ``counters`` of an earlier call (folders on shared storage), only files that came since are read."""
    landed = spark.read.parquet(path)
    each = -(-len(landed.inputFiles()) // batches)
    counters, progress = counters or work_path(spark, "counters"), progress or work_path(spark, "progress")
    flags = written(labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("bigint")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("bigint")).alias("toxic")), "flags")
    for name, kind in (("owners", OWNERS), ("changes", CHANGES)):  # so that there is something to read before the first batch
        spark.createDataFrame([], kind).write.mode("ignore").parquet(f"{counters}/{name}/batch=-1")

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        claims_of(batch, flags).write.mode("overwrite").parquet(f"{counters}/claims/batch={number}")
        claims = spark.read.schema(CLAIMS).parquet(f"{counters}/claims/batch={number}")
        met = claims.where("claim").select("key").distinct()
        before = spark.read.schema(f"{OWNERS}, batch bigint").parquet(f"{counters}/owners").where(F.col("batch") < number).join(met, "key", "left_semi")
        latest = before.withColumn("_last", F.max("batch").over(Window.partitionBy("key"))).where("batch = _last")
        changes, owners = fold(claims, latest)
        owners.write.mode("overwrite").parquet(f"{counters}/owners/batch={number}")
        changes.write.mode("overwrite").parquet(f"{counters}/changes/batch={number}")

    # As a pattern the path may be one file or a folder of files. A file is read whatever its age beside others.
    path = path.rstrip("/")
    pattern = path if set(path) & set("*?[]{}") else f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", max(1, each)).option("maxFileAge", "36500d").parquet(pattern)
    stream.writeStream.foreachBatch(step).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    sums = spark.read.schema(f"{CHANGES}, batch bigint").parquet(f"{counters}/changes").groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    return sums.where("n <> 0")


def all_orders() -> list[dict]:
    """Every order and step: the filter's bit and those before it."""
    out = []
    for order in itertools.permutations(LETTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            out.append({"filter_order": "".join(order), "step": step, "before": before, "bit": bit})
            before |= bit
    return out


def audit(masks: DataFrame) -> DataFrame:
    """A row for each part, order and step from the counters of masks."""
    kind = "array<struct<filter_order: string, step: int, before: int, bit: int>>"
    rows = masks.select("*", F.explode(F.from_json(F.lit(json.dumps(all_orders())), kind)).alias("s")).select("*", "s.*")
    mask, before, bit = F.col("mask"), F.col("before"), F.col("bit")
    fails, earlier = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0

    def total(c, when):
        return F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0)).cast("bigint")

    share = F.call_function("div", F.lit(120), F.greatest(F.bit_count(mask), F.lit(1)))  # in so many orders each of a mask's filters comes first
    return rows.groupBy("part", "filter_order", "step").agg(
        total("n", ~fails & ~earlier).alias("kept"), total("n", fails & ~earlier).alias("removed"), total("n", fails & earlier).alias("redundant"),
        total("n", mask == bit).alias("unique_fails"), total("good", fails & ~earlier).alias("good_lost"),
        total("toxic", fails & ~earlier).alias("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, F.col("n") * share)), F.lit(0)).cast("bigint").alias("shapley"))


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    return audit(count_masks(spark, path, labels, batches))
