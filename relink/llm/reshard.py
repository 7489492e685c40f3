"""Resharding by minimum-cost flow.

Documents lie in old shards. Equal texts of a shard belong to one block, and blocks are what moves. From the old shards'
bytes and the new shards' capacities (both can be given) a minimum-cost flow gives the bytes to move from each shard to each
other one, at no cost for what stays and one per byte that moves; blocks are then chosen to carry it. Blocks that are large
beside a shard (HEAVY) couldn't carry it closely: they get their shards first, and the flow is that of all others into the
room left. The solver sees one number per shard and one row per block; blocks are a fixed number per old shard, so the
driver's share doesn't grow with the rows. Then the shards that the plan affects are written, and the rows of the new shards
are read from these files and from the old shards that stay as they are.

Within a shard every row gets a gapless slot: what stays in it is laid first, block after block, then what comes to it, so
that a shard that only gains is added to at its end. A block with many rows (a text that is repeated very often) is numbered
in parts, so no task numbers more than a part. A block larger than SPLIT of a shard's
capacity moves part by part, since equal sizes could not be met otherwise; all smaller groups of equal texts stay together.

Defined results: a null text has no bytes, size 1 and crc32 0; a null doc_id is an id like any other; repeated rows each
get a slot; an empty table gives no rows; other columns are written along with their row and otherwise ignored.
"""

from __future__ import annotations

from collections import Counter
from heapq import heappop, heappush

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..lineage import work_path
from .common import written

OLD_SHARDS, NEW_SHARDS = 6, 8
#: Blocks per old shard, parts that all rows would fill, the share of a capacity above which a block is split, and that of a
#: mean capacity above which a block is placed before the flow.
BLOCKS, PARTS, SPLIT, HEAVY = 2048, 8192, 1 / 2, 1 / 16


def min_cost_flow(arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Units on each arc (from, to, capacity, cost >= 0) of a flow that is greatest and of least cost among those: shortest
    distances with potentials, then as much flow as the arcs of shortest paths take at once, over the arcs there are."""
    nodes = 1 + max(max(a[0], a[1]) for a in arcs)
    to, room, price, out = [], [], [], [[] for _ in range(nodes)]
    for u, v, capacity, cost in arcs:  # arc 2k and its reverse 2k + 1
        out[u].append(len(to))
        out[v].append(len(to) + 1)
        to += [v, u]
        room += [capacity, 0]
        price += [cost, -cost]
    level = [0] * nodes

    def tight(u: int, e: int) -> bool:
        return room[e] > 0 and price[e] + level[u] == level[to[e]]

    while True:
        far, heap, done = [None] * nodes, [(0, source)], [False] * nodes
        far[source] = 0
        while heap:
            d, u = heappop(heap)
            if done[u]:
                continue
            done[u] = True
            for e in out[u]:
                if room[e]:
                    new = d + price[e] + level[u] - level[to[e]]
                    if far[to[e]] is None or new < far[to[e]]:
                        far[to[e]] = new
                        heappush(heap, (new, to[e]))
        if far[sink] is None:
            return [room[2 * k + 1] for k in range(len(arcs))]
        most = max(d for d in far if d is not None)
        for v in range(nodes):
            level[v] += most if far[v] is None else far[v]
        while True:
            steps, queue = [-1] * nodes, [source]  # arcs from the source, along tight arcs
            steps[source] = 0
            for u in queue:
                for e in out[u]:
                    if steps[to[e]] < 0 and tight(u, e):
                        steps[to[e]] = steps[u] + 1
                        queue.append(to[e])
            if steps[sink] < 0:
                break
            turn, path, u = [0] * nodes, [], source
            while True:
                if u == sink:
                    amount = min(room[e] for e in path)
                    for e in path:
                        room[e] -= amount
                        room[e ^ 1] += amount
                    full = next(i for i, e in enumerate(path) if not room[e])
                    u = to[path[full] ^ 1]
                    del path[full:]
                elif turn[u] < len(out[u]):
                    e = out[u][turn[u]]
                    if tight(u, e) and steps[to[e]] == steps[u] + 1:
                        path.append(e)
                        u = to[e]
                    else:
                        turn[u] += 1
                elif path:
                    u = to[path.pop() ^ 1]
                    turn[u] += 1
                else:
                    break


def moves(supply: list[int], capacity: list[int]) -> list[dict[int, int]]:
    """Bytes that leave each old shard, by new shard, so that the fewest move: what an old shard holds may stay at no cost (in the
    new shard of its number) or go, at one for each byte, by way of a common node to any shard with room. So there are a few arcs
    for each shard, not one for each pair. A ValueError says if the capacities are less than the supplies."""
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities are less than the supplies")
    n, m = len(supply), len(capacity)
    source, sink, hub = n + m, n + m + 1, n + m + 2
    stay = [(i, n + i, supply[i], 0) for i in range(min(n, m))]
    leave = [(i, hub, supply[i], 1) for i in range(n)]
    enter = [(hub, n + j, capacity[j], 0) for j in range(m)]
    arcs = stay + leave + enter + [(source, i, supply[i], 0) for i in range(n)] + [(n + j, sink, capacity[j], 0) for j in range(m)]
    flow = min_cost_flow(arcs, source, sink)
    gone = flow[len(stay) : len(stay) + n]
    come = flow[len(stay) + n : len(stay) + n + m]
    owed: list[dict[int, int]] = [{} for _ in range(n)]
    j = 0
    for i in range(n):
        left = gone[i]
        while left:
            take = min(left, come[j])
            if take:
                owed[i][j] = take
            left -= take
            come[j] -= take
            j += not come[j]
    return owed


def settle(blocks: list[tuple], held: list[int], capacity: list[int]) -> dict:
    """New shard of every large block (key, old shard, bytes), from the largest down: its own while that holds it beside the
    large ones before it, else of those that can hold it the one with most room beside the bytes ``held`` so far, by old shard.
    One that no shard can hold stays whole, in the shard that it fills over least."""
    free = list(capacity)
    room = [c - (held[j] if j < len(held) else 0) for j, c in enumerate(capacity)]
    place = {}
    for key, old, size in sorted(blocks, key=lambda b: (-b[2], str(b[0]))):
        j = old
        if old >= len(capacity) or free[old] < size:
            j = max(range(len(capacity)), key=lambda j: (min(free[j], size), j == old, room[j], -j))
            room[j] -= size
            if old < len(capacity):
                room[old] += size
        free[j] -= size
        place[key] = j
    return place


def carry(blocks: list[tuple], owed: list[dict[int, int]], shards: int) -> dict:
    """New shard of every block (key, old shard, bytes): the flow's amounts are filled from the largest block down, each
    block going where most is still owed to its shard. Then blocks go that no single amount left could take but all of their
    shard's together can; what stays over is less than a block."""
    owed = [dict(x) for x in owed]
    place = {}
    for key, old, size in sorted(blocks, key=lambda b: (-b[2], str(b[0]))):
        j = max(owed[old], key=lambda j: (owed[old][j], -j), default=None)
        if j is not None and owed[old][j] >= size:
            owed[old][j] -= size
            place[key] = j
        else:
            place[key] = old if old < shards else None
    left = [sum(x.values()) for x in owed]
    for key, old, size in sorted(blocks, key=lambda b: (-b[2], str(b[0]))):
        if place[key] == old and left[old] >= size:
            j = max(owed[old], key=lambda j: (owed[old][j], -j))
            owed[old][j] -= size
            left[old] -= size
            place[key] = j
    room = Counter()
    for x in owed:
        room.update(x)
    for key, old, size in sorted((b for b in blocks if place[b[0]] is None), key=lambda b: (-b[2], str(b[0]))):
        mine = owed[old] or room  # a shard that ends gives up its last blocks too
        j = max(mine, key=lambda j: (mine[j], -j), default=0)
        mine[j] = mine.get(j, 0) - size
        place[key] = j
    return place


def assign(blocks: list[tuple], old_shards: int, capacity: list[int]) -> dict:
    """New shard of every block (key, old shard, bytes): the large ones settled, the flow of the others carried."""
    shards = max([old_shards, *[old + 1 for _, old, _ in blocks]])

    def held(blocks: list[tuple]) -> list[int]:
        out = [0] * shards
        for _, old, size in blocks:
            out[old] += size
        return out

    if sum(held(blocks)) > sum(capacity):
        raise ValueError("the capacities are less than the supplies")
    heavy = HEAVY * sum(capacity) / max(1, sum(c > 0 for c in capacity))
    place = settle([b for b in blocks if b[2] > heavy], held(blocks), capacity)
    room, rest = list(capacity), [b for b in blocks if b[0] not in place]
    for key, _, size in blocks:
        if key in place:
            room[place[key]] -= size
    return place | carry(rest, moves(held(rest), [max(0, c) for c in room]), len(capacity))


def tagged(docs: DataFrame, old=None, old_shards: int = OLD_SHARDS) -> DataFrame:
    """(_row, doc_id, text, _old, _block, _size, _mix) of every row: the whole row, the shard it lies in (``old``, a column or its
    name; by default the text's hash decides), its block there (by the text's hash), UTF-8 bytes plus one, and a hash that deals a
    block's rows into parts."""
    h = F.xxhash64("text")
    now = F.pmod(h, F.lit(old_shards)) if old is None else F.col(old) if isinstance(old, str) else old
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "text", now.cast("int").alias("_old"))
    return rows.select(
        "*", (F.col("_old") * BLOCKS + F.pmod(F.xxhash64("text", F.lit("block")), F.lit(BLOCKS))).cast("int").alias("_block"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("_size"), F.xxhash64("doc_id").alias("_mix"))


def plan(slim: DataFrame, old_shards: int = OLD_SHARDS, new_shards: int = NEW_SHARDS, capacity: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(parts of each block, shard and first slot of each part) from rows _old, _block, _size, _mix.

    ``capacity`` gives the bytes that each new shard may hold, by default nearly equal shares of all bytes."""
    spark = slim.sparkSession
    blocks = slim.groupBy("_old", "_block").agg(F.count("*").alias("n"), F.sum("_size").alias("b")).collect()
    total, rows = sum(r["b"] for r in blocks), sum(r["n"] for r in blocks)
    capacity = list(capacity) if capacity is not None else [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    split = SPLIT * min((c for c in capacity if c), default=0)
    most = max(1, rows // PARTS)
    count = {r["_block"]: max(-(-r["n"] // most), -(-r["b"] // max(1, total // PARTS)) if r["b"] > split else 1) for r in blocks}
    parts = spark.createDataFrame(list(count.items()) or [(0, 1)], "_block int, _parts int")
    held = part(slim, parts).groupBy("_old", "_block", "_part").agg(F.count("*").alias("n"), F.sum("_size").alias("b")).collect()
    large = {r["_block"] for r in blocks if r["b"] > split}
    moving: dict[tuple, list] = {}
    for r in held:
        key = (r["_block"], r["_part"]) if r["_block"] in large else (r["_block"], None)
        moving.setdefault(key, [r["_old"], 0])[1] += r["b"]
    place = assign([(k, old, size) for k, (old, size) in moving.items()], old_shards, capacity)
    first, out = [0] * len(capacity), []
    laid = [(place[(r["_block"], r["_part"]) if r["_block"] in large else (r["_block"], None)], r) for r in held]
    for j, r in sorted(laid, key=lambda x: (x[0] != x[1]["_old"], x[1]["_block"], x[1]["_part"])):  # what stays, then what comes
        out.append((r["_block"], r["_part"], j, first[j]))
        first[j] += r["n"]
    return parts, spark.createDataFrame(out, "_block int, _part int, _shard int, _first long")


def part(df: DataFrame, parts: DataFrame) -> DataFrame:
    """Adds _part; `parts` has a row per block, a fixed number for each old shard, so it is broadcast."""
    return df.join(F.broadcast(parts), "_block").withColumn("_part", F.pmod("_mix", "_parts").cast("int")).drop("_parts")


def placed(rows: DataFrame, parts: DataFrame, places: DataFrame) -> DataFrame:
    """Adds _part, its new shard _shard and its _first slot there; BLOCKS x shards + PARTS rows at most are broadcast, twice."""
    return part(rows, parts).join(F.broadcast(places), ["_block", "_part"])


def land(docs: DataFrame, path: str, old_shards: int, new_shards: int, old, capacity: list[int] | None) -> tuple[DataFrame, DataFrame, str, list, set[int]]:
    """Plan, and write the affected shards below ``path``. Returns the plan, the name that the shards' folders have, rows and
    bytes (_old, _shard, n, b) by old and new shard, and the old shards that lose rows."""
    rows = tagged(docs, old, old_shards)
    slim = written(rows.select("_old", "_block", "_size", "_mix"), "blocks")
    parts, places = plan(slim, old_shards, new_shards, capacity)
    totals = placed(slim, parts, places).groupBy("_old", "_shard").agg(F.count("*").alias("n"), F.sum("_size").alias("b")).collect()
    losing = {r["_old"] for r in totals if r["_old"] != r["_shard"]}
    write = placed(rows, parts, places).where((F.col("_old") != F.col("_shard")) | F.col("_old").isin(losing))
    folder = "shard"
    while folder.lower() in {c.lower() for c in docs.columns}:
        folder += "_"
    write.select("_row.*", F.col("_shard").alias(folder)).write.mode("overwrite").partitionBy(folder).parquet(path)
    return parts, places, folder, totals, losing


def reshard(docs: DataFrame, old_shards: int = OLD_SHARDS, new_shards: int = NEW_SHARDS, old=None, capacity: list[int] | None = None, path: str | None = None) -> DataFrame:
    """One row per document of the new shards: size, crc32 of the text, old shard, new shard, slot.

    The affected shards are written below ``path`` (by default a folder of this run) as by `rewrite` and their rows read from
    there; rows of shards that lose none are read from ``docs``. No text is shuffled. ``old`` names the shard that each row
    lies in (a column, or an expression of the rows' columns; numbers from 0, not null), ``capacity`` the bytes of each new shard."""
    spark = docs.sparkSession
    path = path or work_path(spark, "shards")
    parts, places, folder, totals, losing = land(docs, path, old_shards, new_shards, old, capacity)

    def rows(df: DataFrame) -> DataFrame:
        return placed(tagged(df, old, old_shards), parts, places)

    def slim(df: DataFrame, shard: str) -> DataFrame:
        crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0))
        return df.select("doc_id", crc.alias("text_crc32"), "_old", "_block", "_part", "_size", F.col(shard).alias("_shard"), "_first")

    files = spark.read.schema(StructType([*docs.schema, StructField(folder, IntegerType())])).parquet(path)
    found = slim(rows(files), f"_row.{folder}")
    if any(r["_old"] == r["_shard"] and r["_old"] not in losing for r in totals):
        found = found.unionByName(slim(rows(docs).where((F.col("_old") == F.col("_shard")) & ~F.col("_old").isin(losing)), "_shard"))
    number = F.expr("row_number() over (partition by _block, _part order by doc_id, text_crc32, _size)")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"), (F.col("_first") + number - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("_old").alias("old_shard"))


def rewrite(docs: DataFrame, path: str, old_shards: int = OLD_SHARDS, new_shards: int = NEW_SHARDS, old=None, capacity: list[int] | None = None) -> DataFrame:
    """Write the files that the plan affects below `path`/shard=N and return what happened to each shard.

    A shard that loses rows is written anew (action `rewrite`), one that only gains gets the new rows in further files
    (`append`), the others' files stay as they are (`keep`). A row's shard follows from its block, so texts aren't joined
    by row: the plan is broadcast to where they are read. The rows keep their columns, whatever they are called; the folders
    are named `shard=`, with underscores after it while a column has that name. ``path`` is this plan's alone and is
    written over, so that a run that failed can be run again.
    """
    *_, totals, losing = land(docs, path, old_shards, new_shards, old, capacity)
    gains = {r["_shard"] for r in totals if r["_old"] != r["_shard"]}
    report = [(j, "rewrite" if j in losing else "append" if j in gains else "keep",
               sum(r["n"] for r in totals if r["_shard"] == j), sum(r["b"] for r in totals if r["_shard"] == j)) for j in range(max(old_shards, new_shards))]
    return docs.sparkSession.createDataFrame(report, "shard int, action string, rows long, bytes long")
