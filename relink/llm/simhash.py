"""SimHash near-duplicates with vantage-point trees.

A document's fingerprint sums the bits of its shingle hashes. Distinct fingerprints are dealt into shards: a fingerprint
stands in one shard for each of SEGMENTS bit segments, keyed by that segment's value, so two fingerprints that differ in
fewer bits than there are segments meet in a shard. A shard is divided further by its members' Hamming
distance to a vantage point: rings of width RING, and every member whose ball of the radius reaches over a ring's outer
edge is also sent to the next ring, which is the only other one the triangle inequality leaves. A ring that still is large
(distances may crowd) is dealt into chunks, and each two chunks are a group, so a task holds a bounded number of fingerprints
and a dense ring's quadratic work is spread over tasks. Inside a task a group is a vantage-point tree: each level splits at
the median distance, and only points within the radius of the boundary are compared across it. A tree emits a link from
each member to the least member it is connected with, never all pairs; the links' components are then found by Spark.

A vantage-point tree over all 64 bits prunes little at radius 4 (distances of unrelated fingerprints crowd around 32), so
the segments come first and the trees do the rest.

Defined results: null, empty and wordless texts have fingerprint zero; equal fingerprints link; a repeated row is a row of
its own; a null doc_id is a row but never a component's name unless all its ids are null; empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..lineage import cut
from .common import Forest, key_groups, map_batches, raw, space_words, written
from .components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
SEGMENTS = RADIUS + 1
#: Width of a ring; it must be no narrower than the radius.
RING = 4
#: Members from which a ring is dealt into chunks that are solved two by two.
PART = 8192
#: Members of a tree's leaf, which are compared with each other.
LEAF = 16


def fingerprint(words: list[bytes]) -> int:
    """Bit i is one if more than half of the shingles' hashes have it."""
    if not words:
        return 0
    line = b" ".join(words)
    k = len(words)
    if k <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    else:
        ends, at = [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends]]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:])), np.uint64, k - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, h, fp): fp is the fingerprint as a signed 64-bit number, h a hash of the text that tells rows of one id apart."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(space_words(t.as_py())) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], ["doc_id", "h", "fp"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), raw("text"))
    return map_batches(slim, rows, "doc_id long, h long, fp long")


def _bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _join_near(x: np.ndarray, left: np.ndarray, right: np.ndarray, forest: Forest) -> None:
    """Link every point of `left` with all points of `right` within the radius, a point's links at once."""
    near = _bits(x[left][:, None], x[right][None, :]) <= RADIUS
    if left is right:
        np.fill_diagonal(near, False)
    for i in np.flatnonzero(near.any(axis=1)).tolist():
        forest.link(np.append(right[near[i]], left[i]))


def vp_links(x: np.ndarray, forest: Forest) -> None:
    """Link all pairs within the radius, by a vantage-point tree over `x` (distinct unsigned fingerprints)."""
    todo: list[tuple[np.ndarray, np.ndarray | None]] = [(np.arange(len(x)), None)]
    while todo:
        left, right = todo.pop()
        if right is None:
            if len(left) <= LEAF:
                _join_near(x, left, left, forest)
                continue
        elif min(len(left), len(right)) == 0:
            continue
        elif len(left) * len(right) <= LEAF * LEAF:
            _join_near(x, left, right, forest)
            continue
        vantage = x[left[0]]
        d = _bits(x[left], vantage).astype(np.int64)
        half = int(np.median(d))
        if right is None:
            inner, outer = left[d <= half], left[d > half]
            if not len(outer):  # all at one distance or less: the points at exactly `half` part from the rest
                half -= 1
                inner, outer = left[d <= half], left[d > half]
            if not len(inner) or not len(outer):
                _blocks(x, left, left, forest)
                continue
            todo += [(inner, None), (outer, None), (left[(d <= half) & (d > half - RADIUS)], left[(d > half) & (d <= half + RADIUS)])]
        else:
            e = _bits(x[right], vantage).astype(np.int64)
            parts = [(left[d <= half], right[e <= half + RADIUS]), (left[d > half], right[e > half - RADIUS])]
            if max(len(a) * len(b) for a, b in parts) > 0.9 * len(left) * len(right):
                _blocks(x, left, right, forest)
            else:
                todo += parts


def _blocks(x: np.ndarray, left: np.ndarray, right: np.ndarray, forest: Forest, size: int = 1024) -> None:
    """What no vantage point divides is compared in blocks, without a list of the pairs."""
    for i in range(0, len(left), size):
        for j in range(i if left is right else 0, len(right), size):
            a = left[i:i + size]
            _join_near(x, a, a if left is right and i == j else right[j:j + size], forest)


def dealt(fps: DataFrame) -> DataFrame:
    """(fp, key): the groups of distinct fingerprints that are solved in one task each; near ones meet in a group.

    Every shard of two members or more is cut into rings around its least fingerprint. A ring over PART members is dealt by hash
    into chunks of about PART at most, and a group for each two chunks holds just these, so no group is larger than about 2 x PART.
    """
    cuts = [round(i * 64 / SEGMENTS) for i in range(SEGMENTS + 1)]
    values = [F.shiftrightunsigned("fp", a).bitwiseAND((1 << (b - a)) - 1).bitwiseOR(F.lit(i << 32)) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    shards = fps.select("fp", F.explode(F.array(*values)).alias("shard"))
    sizes = shards.groupBy("shard").agg(F.count("*").alias("size"), F.min("fp").alias("vantage")).where("size > 1")
    sized = shards.join(F.broadcast(sizes), "shard")  # no more rows than segments have values: 5 x 2 ** 13
    ring = (F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage"))) / RING).cast("int")
    ringed = sized.select("fp", "shard", "size", F.explode(F.array(ring, ring + 1)).alias("ring"))
    # no more rows than shards have rings (5 x 2 ** 13 x 18), and none unless a shard is larger than PART
    large = ringed.where(F.col("size") > PART).groupBy("shard", "ring").agg(F.count("*").alias("members")).where(F.col("members") > PART)
    chunks = F.ceil(F.col("members") / PART).cast("int")
    mine = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    pairs = F.filter(F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.struct(F.least(c, mine).alias("i"), F.greatest(c, mine).alias("j"))),
                     lambda p: p.i != p.j)
    none = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    return ringed.join(F.broadcast(large), ["shard", "ring"], "left").select(
        "fp", "shard", "ring", F.explode(F.when(F.col("members").isNull(), none).otherwise(pairs)).alias("p")).select(
        "fp", F.xxhash64("shard", "ring", "p.i", "p.j").alias("key"))


def near_links(fps: DataFrame) -> DataFrame:
    """(a, b): links among distinct fingerprints `fp` whose components are those of all pairs within the radius."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        size = 0
        for group in key_groups(batches, "key"):
            x = np.unique(group.column("fp").to_numpy())
            if len(x) < 2:
                continue
            forest = Forest(len(x))
            vp_links(x.view(np.uint64), forest)
            roots = forest.roots(np.arange(len(x)))
            moved = np.flatnonzero(roots != np.arange(len(x)))
            if len(moved):
                a.append(x[moved])
                b.append(x[roots[moved]])
                size += len(moved)
            if size > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
                a, b, size = [], [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return dealt(fps).repartition("key").sortWithinPartitions("key").mapInArrow(links, "a long, b long")


def classes(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, h, fp, group), and per group its first row (component_id, first_h); a group is named by a fingerprint."""
    found = components(near_links(prints.select("fp").distinct()))
    linked = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "doc_id", "h", "fp", F.coalesce("component", "fp").alias("group"))
    first = linked.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("first"))
    # cut, so that the join shuffles both sides and a large group's rows can be split
    return linked, cut(first.select("group", F.col("first.doc_id").alias("component_id"), F.col("first.h").alias("first_h")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint as 16 hex digits, component_id (least doc_id reachable by links)."""
    rows, first = classes(written(fingerprints(docs), "fingerprints"))
    return rows.join(first, "group").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay when each component keeps its document with the least doc_id, and of its repeated rows
    one. Only ids, hashes and fingerprints take part in the search; texts are shuffled once, for the join that drops rows.
    A component whose ids are all null keeps one row."""
    _, first = classes(written(fingerprints(docs), "fingerprints"))
    key = {"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_none": F.col("doc_id").isNull(), "_h": F.xxhash64("text")}
    stay = first.select(F.coalesce("component_id", F.lit(0)).alias("_id"), F.col("component_id").isNull().alias("_none"),
                        F.col("first_h").alias("_h"))
    rows = docs.select(F.struct("*").alias("_row"), *[c.alias(name) for name, c in key.items()])  # whatever the columns are called
    return rows.join(stay, list(key), "left_semi").dropDuplicates(list(key)).select("_row.*")
