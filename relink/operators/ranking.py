"""Order-dependent operators that hold up when one scope owns a large share of all rows.

A plain `row_number() over (partition by scope)` puts a whole scope into one task. `number_rows` counts the scopes first;
those with very many rows are cut into pieces at measured quantiles of the whole order key and a hash of the row (so that
ties are cut up too), are ranked inside a piece, and get the number of rows of the earlier pieces added. First/last-per-key uses `row_number() = 1`, which Spark limits per map
task before the shuffle (WindowGroupLimit), so a hot key sends at most one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType, VariantType

from ..lineage import cut, freeing

NULL_KEY = "\u0000"
#: Rows from which a scope is cut into pieces, pieces at most, keys looked at for each piece, and how many scopes are cut:
#: the largest ones, so that any other holds less than 1 / SCOPES of the rows. What is collected and broadcast is bounded.
PIECE, PIECES, LOOKED_AT, SCOPES = 500_000, 256, 40, 500


def orderable(df: DataFrame, but: list[str] = ()) -> list[str]:
    """Columns of plain types, by which rows can be told apart and ordered."""
    return [f.name for f in df.schema if f.name not in but and isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]


def _bounds(keyed: DataFrame, key: Column, piece: int) -> dict[str, list]:
    """Upper bounds of the pieces of each large scope: quantiles of a sample of its rows by ``key``.

    Rows are drawn one by one, so rows that share a key are drawn in proportion. The sample is ranked in Spark, and only
    the bounds come to the driver: SCOPES x PIECES of them at most."""
    counts = keyed.groupBy("_scope").agg(F.count(F.lit(1)).alias("n"))
    with freeing(keyed.sparkSession):
        large = {r[0]: r[1] for r in counts.where(F.col("n") > piece).orderBy(F.desc("n"), "_scope").limit(SCOPES).collect()}
    if not large:
        return {}
    wanted = {s: min(PIECES, -(-n // piece)) for s, n in large.items()}
    share = F.create_map(*[F.lit(x) for s, k in wanted.items() for x in (s, min(1.0, k * LOOKED_AT / large[s]))])
    pieces = F.create_map(*[F.lit(x) for s, k in wanted.items() for x in (s, k)])
    sample = keyed.where(F.col("_scope").isin(list(large))).where(F.rand(17) < share[F.col("_scope")]).select("_scope", key.alias("k"))
    scope = Window.partitionBy("_scope")
    cut_at = F.floor(F.col("_at") * pieces[F.col("_scope")] / F.col("_all"))  # the piece a drawn row falls into, from 0
    ranked = sample.select("*", (F.row_number().over(scope.orderBy("k")) - 1).alias("_at"), F.count(F.lit(1)).over(scope).alias("_all"))
    firsts = ranked.select("_scope", "k", cut_at.alias("_piece")).where("_piece > 0").groupBy("_scope", "_piece").agg(F.min("k").alias("k"))
    found: dict[str, list] = {s: [] for s in large}
    with freeing(keyed.sparkSession):
        for r in firsts.sort("_scope", "_piece").collect():
            found[r[0]].append(r[2])
    return found


def number_rows(df: DataFrame, by: list[str], order: list[str], out: str = "rank", piece: int = PIECE) -> DataFrame:
    """Add the 1-based position of each row in its scope, in ascending ``order`` (nulls first).

    ``order`` should end in a unique column, else ties are numbered arbitrarily. However many rows tie, none waits for
    all others: a scope is cut by its order key and then by a hash of the row, and if very many rows are equal throughout,
    ``df`` is written once with a random number that tells them apart. ``df`` is counted before it is ranked, so it
    should be cheap to read or written before.
    """
    spark = df.sparkSession
    scope = F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)) for c in by]) if by else F.lit("")
    keyed = df.withColumn("_scope", scope)
    tie = F.xxhash64(*dict.fromkeys([*order, *orderable(df)]))
    key = F.struct(*order, tie.alias("_tie"))
    bounds = _bounds(keyed, key, piece)
    if any(len(set(b)) < len(b) for b in bounds.values()):  # equal rows that fill whole pieces
        keyed = cut(keyed.withColumn("_salt", F.rand()))
        key = F.struct(*order, tie.alias("_tie"), "_salt")
        bounds = _bounds(keyed, key, piece)
    if not bounds:  # by the columns themselves: rows that already lie together by some of them needn't be dealt again
        ranked = keyed.withColumn(out, F.row_number().over(Window.partitionBy(*(by or ["_scope"])).orderBy(*order)).cast("bigint"))
        return ranked.select(*df.columns, out)
    kind = keyed.select(key.alias("k")).schema["k"].dataType
    ddl = f"_scope string, _bounds array<{kind.simpleString()}>"
    table = F.broadcast(spark.createDataFrame(list(bounds.items()), ddl))  # SCOPES x PIECES keys at most
    pieced = keyed.join(table, "_scope", "left").withColumn("_piece", F.coalesce(
        F.size(F.filter("_bounds", lambda b: b <= key)), F.lit(0))).drop("_bounds")
    large = F.col("_scope").isin(list(bounds))
    with freeing(spark):
        sizes = {(r[0], r[1]): r[2] for r in pieced.where(large).groupBy("_scope", "_piece").count().collect()}
    first, rows = 0, []
    for s in bounds:
        first = 0
        for p in range(len(bounds[s]) + 1):
            rows.append((s, p, first))
            first += sizes.get((s, p), 0)
    offsets = F.broadcast(spark.createDataFrame(rows, "_scope string, _piece int, _before long"))
    local = F.row_number().over(Window.partitionBy("_scope", "_piece").orderBy(*order))
    return (pieced.withColumn("_local", local).join(offsets, ["_scope", "_piece"], "left")
            .withColumn(out, F.col("_local") + F.coalesce("_before", F.lit(0))).select(*df.columns, out))


def chunk_index(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """Fixed-size chunks in order: adds `chunk` (from 0) and `pos` (from 0 inside the chunk)."""
    ranked = number_rows(df, by, order, "_rank")
    zero = F.col("_rank") - 1
    return (ranked.withColumn("chunk", F.floor(zero / n)).withColumn("pos", F.pmod(zero, F.lit(n)))
            .drop("_rank"))


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last in order: later rows overwrite earlier ones."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row per key; rows without a key are all kept."""
    blank = F.coalesce(F.trim(F.col(key).cast("string")) == "", F.lit(True))
    return first_per_key(df.where(~blank), [key], order).unionByName(df.where(blank))


def trailing(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """Last ``n`` rows of each group in order, with `pos` from 0. Up to 1,000 rows per group are
    limited per map task before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    kept = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    size = F.count(F.lit(1)).over(Window.partitionBy(*by))
    return kept.withColumn("pos", size - F.col("_rn")).drop("_rn")


def keep_smallest(df: DataFrame, order: list, n: int) -> DataFrame:
    """Report of the first ``n`` rows in order (a take-ordered, no full sort)."""
    return df.orderBy(*order).limit(n)


def hot_keys(df: DataFrame, keys: list[str], share: float = 0.001) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: never more than 1/share of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    floor = df.agg((F.count(F.lit(1)) * F.lit(share)).alias("_floor"))
    return counts.where(F.col("_n") >= floor.scalar()).select(*keys)
