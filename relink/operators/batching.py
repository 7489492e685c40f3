"""Load batches: fixed chunks, payload text per chunk, size-capped greedy batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.shapes import col, none_of
from .ranking import NULL_KEY, chunk_index, number_rows


def payload_chunks(df: DataFrame, by: list[str], order: list[str], n: int, columns: list[str]) -> DataFrame:
    """One request body per chunk of ``n`` rows, rows in order."""
    chunked = chunk_index(df, by, order, n)
    return chunked.groupBy(*by, "chunk").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.to_json(F.transform(
            F.array_sort(F.collect_list(F.struct("pos", F.struct(*columns).alias("row")))),
            lambda x: x["row"])).alias("payload"))


def uniquify(labels) -> Column:
    """Make the labels of a row's list distinct: `A`, `A (1)`, `A (2)`, skipping labels taken. Quadratic in the list's
    length: meant for option lists, not for texts."""
    def add(seen, label):
        # Of the k+1 first suffixes one is free when k labels with a suffix are taken.
        taken = F.filter(seen, lambda x: x.startswith(F.concat(label, F.lit(" ("))))
        tries = F.transform(F.sequence(F.lit(1), F.size(taken) + 1),
                            lambda k: F.concat(label, F.lit(" ("), k.cast("string"), F.lit(")")))
        free = F.get(F.array_except(tries, taken), F.lit(0))
        return F.concat(seen, F.array(F.when(F.array_contains(seen, label), free).otherwise(label)))

    return F.aggregate(F.coalesce(col(labels), none_of("array<string>")),
                       none_of("array<string>"), add)


def positions(steps, position) -> Column:
    """Position of each kept step of a row: its own, else its place among the kept ones."""
    return F.transform(col(steps), lambda s, i: F.coalesce(position(s), i + 1))


def _ends(sizes: np.ndarray, max_n: int, max_bytes: int, lone_bytes: int) -> np.ndarray:
    """For each start, where the batch beginning there ends (exclusive)."""
    n = len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    by_bytes = np.searchsorted(total, total[:-1] + max_bytes, side="right") - 1
    idx = np.arange(n)
    lone = sizes > lone_bytes
    nxt = np.full(n + 1, n)
    if lone.any():
        where = np.flatnonzero(lone)
        k = np.searchsorted(where, idx, side="left")
        nxt[:-1] = np.where(k < len(where), where[np.minimum(k, len(where) - 1)], n)
    end = np.minimum(np.minimum(by_bytes, idx + max_n), nxt[:-1])
    return np.maximum(np.where(lone, idx + 1, end), idx + 1)


def cap_batches(
    df: DataFrame, by: list[str], order: list[str], size: str, max_n: int = 20,
    max_bytes: int = 128 * 1024 * 1024, lone_bytes: int = 32 * 1024 * 1024, block: int = 200_000,
) -> DataFrame:
    """Greedy batches per queue: at most ``max_n`` items and ``max_bytes``, an item above ``lone_bytes`` or of unknown
    size alone. Adds `batch` (from 0 in the queue); rows without a queue share one.

    Each batch starts where the last one ended, but where it ends depends on the next ``max_n`` items
    only. So a queue is cut into blocks: every block works out, for each place a batch may start in it
    (one of its first ``max_n`` items), where the walk leaves it; the short chain of those answers gives
    each block its true start; the blocks then number their batches independently. The longest queue is
    spread over all executors, and the result equals the sequential walk.
    """
    if not by:
        raise ValueError("name the queue column")
    cols = df.columns
    # queues are told apart by non-null text keys, so that no join or group loses the rows without one
    queue = [f"_q{i}" for i in range(len(by))]
    ranked = number_rows(df, by, order, "_rank").withColumns(
        {q: F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)) for q, c in zip(queue, by)})
    by = queue
    slots = ranked.withColumn("_i", F.col("_rank") - 1).withColumn("_block", F.floor(F.col("_i") / block))
    own = slots.select(*by, "_block", "_i", F.coalesce(F.col(size).cast("bigint"), F.lit(lone_bytes + 1)).alias("_bytes"))
    # The first max_n items of a block are also shown to the block before it.
    halo = own.where((F.col("_block") > 0) & (F.pmod("_i", F.lit(block)) < max_n)).withColumn(
        "_block", F.col("_block") - 1)
    keys = [*by, "_block"]
    key_ddl = ", ".join(f"`{c}` string" for c in by)

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        b = int(pdf["_block"].iloc[0])
        n_own = int((pdf["_i"] < (b + 1) * block).sum())
        ends = _ends(pdf["_bytes"].to_numpy(), max_n, max_bytes, lone_bytes)
        rows = []
        for entry in range(min(max_n, n_own) if b else 1):
            at, count = entry, 0
            while at < n_own:
                at, count = int(ends[at]), count + 1
            rows.append((entry, at - n_own, count))
        out = pd.DataFrame(rows, columns=["_entry", "_exit", "_count"])
        if n_own < max_n and b:
            extra = range(n_own, max_n)
            out = pd.concat([out, pd.DataFrame(
                {"_entry": list(extra), "_exit": [e - n_own for e in extra], "_count": 0})])
        for c in by:
            out[c] = pdf[c].iloc[0]
        out["_block"] = b
        return out

    moves = own.unionByName(halo).groupBy(*keys).applyInPandas(
        summarise, f"{key_ddl}, _block bigint, _entry bigint, _exit bigint, _count bigint")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        table = {(b, e): (x, n) for b, e, x, n in
                 zip(pdf["_block"], pdf["_entry"], pdf["_exit"], pdf["_count"])}
        rows, entry, first = [], 0, 0
        for b in sorted(pdf["_block"].unique()):
            rows.append((b, entry, first))
            entry, n = table[(b, entry)]
            first += n
        out = pd.DataFrame(rows, columns=["_block", "_entry", "_first"])
        for c in by:
            out[c] = pdf[c].iloc[0]
        return out

    starts = moves.groupBy(*by).applyInPandas(chain, f"{key_ddl}, _block bigint, _entry bigint, _first bigint")

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        b, entry, first = int(pdf["_block"].iloc[0]), int(pdf["_entry"].iloc[0]), int(pdf["_first"].iloc[0])
        ends = _ends(pdf["_bytes"].to_numpy(), max_n, max_bytes, lone_bytes)
        start = np.zeros(len(pdf), dtype=np.int64)
        at = entry
        while at < len(pdf):
            start[at] = 1
            at = int(ends[at])
        out = pdf[[*by, "_i"]].copy()
        # Items before the entry belong to the last batch of the block before.
        out["batch"] = first - 1 + np.cumsum(start)
        return out[pdf["_i"].to_numpy() < (b + 1) * block]

    with_start = own.unionByName(halo).join(starts, keys)
    numbered = with_start.groupBy(*keys).applyInPandas(assign, f"{key_ddl}, _i bigint, batch bigint")
    return slots.join(numbered, [*by, "_i"]).select(*cols, "batch")


def upload_plan(df: DataFrame, queue: str, order: list[str], size: str, **caps) -> DataFrame:
    """Batches per target queue plus the queue's turn in sorted target order."""
    turns = number_rows(df.select(queue).distinct(), [], [queue], "turn").select(F.col(queue).alias("_turn_of"), (F.col("turn") - 1).alias("turn"))
    out = cap_batches(df, [queue], order, size, **caps)
    return out.join(turns, F.col(queue).eqNullSafe(F.col("_turn_of"))).drop("_turn_of")
