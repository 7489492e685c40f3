"""Near-duplicate embeddings by E8 lattice hashing.

TABLES times, a vector is projected onto BLOCKS x 8 random orthonormal directions, scaled, and each eight decoded to the
nearest point of the lattice E8; the points are its home cell. It also probes the PROBES cells that lie nearest in each
block: those of the lattice's 240 shortest vectors that point most along the residual. Vectors meet in a cell if one is at
home there. Met vectors are verified by cosine in double precision; a cell's task emits a link from each vector to the
least one it is connected with, not the pairs. Components follow from the links; inside each component all pairs are then
verified and counted, so a link counts even where only a chain of others was found.

Vectors are compared only within a label. Exact copies are one class from the start and never meet. Cells and components
of more than GROUP classes are dealt into chunks and compared chunk by chunk, each pair of chunks in a task of its own.

Recall of pairs at the very threshold is above 0.98 with these parameters (a test measures it), higher for nearer pairs.

Defined results: a vector without label, null, empty, of zeros only, or with a null or non-finite component links with
nothing; vectors of unequal length aren't compared; repeated rows are rows and copies of each other; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Forest, key_groups, map_batches, written
from .components import components

THRESHOLD = 0.93
TABLES, BLOCKS, PROBES, SCALE, SEED = 10, 2, 2, 3.5, 7
GROUP = 512

USABLE = ("label is not null and embedding is not null and size(embedding) > 0 and exists(embedding, x -> x <> 0) and "
          "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8: integers of even sum; where rounding gives an odd one the worst coordinate goes the other way."""
    f = np.rint(x)
    rest = x - f
    i = np.flatnonzero(f.sum(axis=1) % 2)
    k = np.abs(rest[i]).argmax(axis=1)
    f[i, k] += np.where(rest[i, k] >= 0, 1.0, -1.0)
    return f


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 shifted by a half."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


@lru_cache(1)
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


@lru_cache(8)
def projections(size: int) -> list[list[np.ndarray]]:
    """Per table and block eight directions, orthonormal as far as the vectors' length allows."""
    rng = np.random.default_rng([SEED, size])
    scale = SCALE * np.sqrt(size / 64)  # the longer the vector, the less of it eight directions see
    return [[np.linalg.qr(rng.normal(size=(max(size, 8), 8)))[0][:size] * scale for _ in range(BLOCKS)] for _ in range(TABLES)]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cells(x: np.ndarray, label: np.ndarray) -> list[tuple[np.ndarray, bool]]:
    """(keys, home?) of unit vectors: per table the home cell and the probed ones; a key hashes label, table and points."""
    out = []
    mix = np.random.default_rng(SEED).integers(1, 2 ** 62, size=(TABLES, BLOCKS, 8)) * 2 + 1
    for t, blocks in enumerate(projections(x.shape[1])):
        home = label * (2 * t + 1)
        moves = []
        for b, p in enumerate(blocks):
            y = x @ p
            point = decode(y)
            home = home + ((2 * point).astype(np.int64) * mix[t, b]).sum(axis=1)
            toward = np.argsort(-((y - point) @ shortest().T), axis=1, kind="stable")[:, :PROBES]
            moves += [((2 * shortest()[toward[:, i]]).astype(np.int64) * mix[t, b]).sum(axis=1) for i in range(PROBES)]
        out.append((home, True))
        out += [(home + m, False) for m in moves]
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def keyed(classes: DataFrame) -> DataFrame:
    """(rid, key, home) of every class of copies."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.array([len(v) for v in b.column("embedding")])
            for size in np.unique(sizes).tolist():
                part = b.filter(pa.array(sizes == size))
                rid = part.column("rid").to_numpy()
                for key, home in cells(unit(_matrix(part.column("embedding"))), part.column("space").to_numpy()):
                    yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(key), pa.array(np.full(len(rid), int(home)))], ["rid", "key", "home"])

    return map_batches(classes.select("rid", "space", "embedding"), rows, "rid long, key long, home long")


def in_chunks(rows: DataFrame, sizes: DataFrame, group: str) -> DataFrame:
    """Deals each group's rows into chunks: a row for each pair of chunks that a row takes part in, keyed by `deal`.

    `sizes` has `group` and its `size`. A group of up to GROUP rows is one chunk and is not multiplied.
    """
    chunks = F.ceil(F.col("size") / GROUP).cast("int")
    own = F.pmod(F.xxhash64("rid", F.lit("chunk")), chunks).cast("int")
    return (rows.join(sizes, group).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .withColumn("deal", F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other"))).drop("size"))


def _near(x: np.ndarray, space: np.ndarray, a: int, b: int) -> np.ndarray:
    """Which of the vectors a..b are near which of all; never a vector to itself."""
    near = (x[a:b] @ x.T >= THRESHOLD) & (space[a:b, None] == space[None, :])
    near[np.arange(b - a), np.arange(a, b)] = False
    return near


def _of_length(table: pa.Table) -> Iterator[pa.Table]:
    """A deal's distinct classes; the vectors of a label and length, as hashes of cells may agree by chance."""
    _, first = np.unique(table.column("rid").to_numpy(), return_index=True)
    table = table.take(pa.array(first))
    sizes = np.array([len(v) for v in table.column("embedding")])
    for size in np.unique(sizes).tolist():
        yield table.filter(pa.array(sizes == size))


def links(classes: DataFrame) -> DataFrame:
    """(a, b): verified links that connect what pairs met in a cell connect."""
    keys = written(keyed(classes), "cells")
    sizes = written(keys.groupBy("key").agg(F.count("*").alias("size"), F.max("home").alias("lived")).where("size > 1 and lived = 1").select("key", "size"), "cell-sizes")
    dealt = in_chunks(keys.drop("home"), sizes, "key").select("rid", "deal")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, "deal"):
            if group.num_rows < 2:
                continue
            for table in _of_length(group):
                rid, x = table.column("rid").to_numpy(), unit(_matrix(table.column("embedding")))
                space, forest = table.column("space").to_numpy(), Forest(len(rid))
                for a in range(0, len(rid), 512):
                    b = min(a + 512, len(rid))
                    near = _near(x, space, a, b)
                    for i in np.flatnonzero(near.any(axis=1)).tolist():
                        forest.link(np.append(np.flatnonzero(near[i]), a + i))
                roots = forest.roots(np.arange(len(rid)))
                moved = np.flatnonzero(roots != np.arange(len(rid)))
                if len(moved):
                    yield pa.RecordBatch.from_arrays([pa.array(rid[moved]), pa.array(rid[roots[moved]])], ["a", "b"])

    met = dealt.join(classes.select("rid", "space", "embedding"), "rid")
    return map_batches(met.repartition("deal").sortWithinPartitions("deal"), local, "a long, b long").distinct()


def counted(classes: DataFrame, groups: DataFrame) -> DataFrame:
    """(rid, near): how many vectors of other classes each class is near to; `groups` has rid and component."""
    sizes = written(groups.groupBy("component").agg(F.count("*").alias("size")), "component-sizes")
    dealt = in_chunks(groups, sizes, "component").join(classes.select("rid", "space", "copies", "embedding"), "rid")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_groups(batches, "deal"):
            _, first = np.unique(table.column("rid").to_numpy(), return_index=True)
            table = table.take(pa.array(first))
            rid, x, space = table.column("rid").to_numpy(), unit(_matrix(table.column("embedding"))), table.column("space").to_numpy()
            copies, own = table.column("copies").to_numpy(), table.column("own").to_numpy()
            mixed = own.min() != own.max()  # a pair of chunks: pairs inside a chunk are counted in its own deal
            near = np.zeros(len(rid), np.int64)
            for a in range(0, len(rid), 512):
                b = min(a + 512, len(rid))
                found = _near(x, space, a, b)
                if mixed:
                    found &= own[a:b, None] != own[None, :]
                near[a:b] = found @ copies
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(near)], ["rid", "near"])

    # in a deal of one chunk with itself a row stands once; in one of two chunks each chunk's rows stand once
    found = map_batches(dealt.select("deal", "rid", "own", "space", "copies", "embedding").repartition("deal").sortWithinPartitions("deal"), local, "rid long, near long")
    return found.groupBy("rid").agg(F.sum("near").alias("near"))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = rows.where(USABLE)
    alone = rows.where(f"not coalesce({USABLE}, false)").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    classes = written(good.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first")).select(
        F.monotonically_increasing_id().alias("rid"), F.xxhash64("label", F.size("embedding")).alias("space"), "*"), "classes")
    groups = written(components(links(classes)).withColumnRenamed("node", "rid"), "components")
    near = counted(classes, groups)
    told = written(classes.join(groups, "rid", "left").join(near, "rid", "left").withColumn("component", F.coalesce("component", "rid")), "told")
    least = written(told.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    result = written(told.join(least, "component").select("label", "embedding", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "classes-told")
    return good.join(result, ["label", "embedding"]).select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
