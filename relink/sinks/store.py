"""A crosswalk on shared storage that can be updated a little at a time.

    data/v=7/entity=case/scope=P/...   what version 7 wrote: whole slices (base) or new pairs only (delta)
    manifest/00000007/                 the live (entity, scope, version, kind) rows; complete once Spark marked it so

A writer writes data of a new version first and its manifest last. The last complete manifest is the store, so a job that
dies in between leaves the earlier version readable, and its remains are never read. An upsert writes its pairs only: the
slice's base stays as it is, and readers lay the deltas over it. Pairs of one key are settled by the stored order columns,
then by version, so files that arrive late change nothing. When a slice's deltas have become many, or large beside its
base, the slice alone is rewritten. A slice is dealt into files by a hash of the key, one for each ROWS rows.

One writer at a time: a second one that takes the same version number fails when it writes its manifest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..lineage import cut
from ..operators.ranking import last_per_key

PAIR = "source_key string, target_key string"
MANIFEST = "entity string, scope string, v int, kind string, n bigint, ddl string, order array<string>, tags map<string,bigint>"
#: Rows of one file; deltas of a slice, and their rows in percent of its base, from which a slice is rewritten.
ROWS, DELTAS, GROWN = 1_000_000, 16, 50


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of the store, in order; none where nothing was ever written."""
    where, fs = _fs(spark, f"{path}/manifest")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    done = [n for n in names if n.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/{n}/_SUCCESS"))]
    return sorted(int(n) for n in done)


def _taken(spark: SparkSession, path: str) -> int:
    """The largest number any writer has used, complete or not."""
    out = 0
    for folder, prefix in (("manifest", ""), ("data", "v=")):
        where, fs = _fs(spark, f"{path}/{folder}")
        if fs.exists(where):
            names = [s.getPath().getName().removeprefix(prefix) for s in fs.listStatus(where)]
            out = max([out, *[int(n) for n in names if n.isdigit()]])
    return out


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """Live slices of a version (default: the last complete one), and a row of kind `meta`; None for an empty path."""
    every = versions(spark, path)
    if not every:
        return None
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest/{every[-1] if version is None else version:08d}")


def _meta(live: DataFrame | None) -> tuple[str, list[str], dict[str, int]]:
    row = live.where("kind = 'meta'").first() if live is not None else None
    return (row["ddl"], list(row["order"]), dict(row["tags"])) if row else ("", [], {})


def _rows(spark: SparkSession, path: str, live: DataFrame, ddl: str) -> DataFrame:
    """All rows of the live (slice, version) pairs, with `v` and `kind`."""
    numbers = [r[0] for r in live.where("v is not null").select("v").distinct().collect()]
    schema = ", ".join(x for x in (PAIR, ddl, "v int, entity string, scope string") if x)
    if not numbers:
        return spark.createDataFrame([], f"{schema}, kind string")
    data = spark.read.schema(schema).parquet(f"{path}/data").where(F.col("v").isin(numbers))
    keep = live.where("v is not null").select(F.col("entity").alias("_e"), F.col("scope").alias("_s"), F.col("v").alias("_v"), "kind")
    same = data["entity"].eqNullSafe(keep["_e"]) & data["scope"].eqNullSafe(keep["_s"]) & (data["v"] == keep["_v"])
    return data.join(keep, same).drop("_e", "_s", "_v")


KEY = ["entity", "scope", "source_key"]


def _folded(rows: DataFrame, order: list[str]) -> DataFrame:
    """One pair for each key. Only the bases' rows whose key a delta has take part, the others pass as they are."""
    base, delta = rows.where("kind = 'base'"), rows.where("kind = 'delta'")
    touched = delta.select(*[F.col(c).alias(f"_{c}") for c in KEY]).distinct()
    same = reduce(lambda a, b: a & b, [base[c].eqNullSafe(touched[f"_{c}"]) for c in KEY])
    met = base.join(touched, same, "left_semi").unionByName(delta)
    return base.join(touched, same, "left_anti").unionByName(last_per_key(met, KEY, [*order, "v", "target_key"]))


def read(spark: SparkSession, path: str, version: int | None = None, keep: bool = False) -> DataFrame:
    """(entity, scope, source_key, target_key) of the store; with ``keep`` its order columns too."""
    live = manifest(spark, path, version)
    if live is None:
        return spark.createDataFrame([], "entity string, scope string, source_key string, target_key string")
    ddl, order, _ = _meta(live)
    rows = _rows(spark, path, live, ddl)
    if not live.where("kind = 'delta'").isEmpty():
        rows = _folded(rows, order)
    return rows.select("entity", "scope", "source_key", "target_key", *(order if keep else []))


def _write(rows: DataFrame, path: str, v: int) -> DataFrame:
    """Write pairs as data of one version; (entity, scope, v, n) of its slices. ``rows`` is read twice."""
    spark = rows.sparkSession
    sizes = rows.groupBy(F.col("entity").alias("_e"), F.col("scope").alias("_s")).agg(F.count(F.lit(1)).alias("n"))
    same = F.col("entity").eqNullSafe(F.col("_e")) & F.col("scope").eqNullSafe(F.col("_s"))
    bucket = F.pmod(F.xxhash64("source_key"), F.ceil(F.col("n") / ROWS))
    dealt = rows.join(sizes, same).withColumn("_bucket", bucket).repartition("entity", "scope", "_bucket")
    columns = [c for c in rows.columns if c not in ("entity", "scope")]
    dealt.select(*columns, "entity", "scope").write.option("maxRecordsPerFile", ROWS).partitionBy("entity", "scope").parquet(f"{path}/data/v={v}")
    return sizes.select(F.col("_e").alias("entity"), F.col("_s").alias("scope"), F.lit(v).alias("v"), "n")


def _publish(spark: SparkSession, path: str, v: int, live: DataFrame | None, ddl: str, order: list[str], tags: dict[str, int]) -> None:
    """Write the manifest of a version; from then on it is the store."""
    meta = spark.createDataFrame([(None, None, None, "meta", None, ddl, order, tags)], MANIFEST)
    rows = meta if live is None else live.where("kind <> 'meta'").select(
        "entity", "scope", "v", "kind", "n", F.lit(None).cast("string").alias("ddl"), F.lit(None).cast("array<string>").alias("order"),
        F.lit(None).cast("map<string,bigint>").alias("tags")).unionByName(meta)
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/{v:08d}")


def _pairs_of(df: DataFrame, order: list[str]) -> DataFrame:
    """What is stored of given pairs: those with both keys, one for each key. An empty scope is a missing one."""
    every = df.where("source_key is not null and target_key is not null").select(
        "source_key", "target_key", *order, *[F.nullif(c, F.lit("")).alias(c) for c in ("entity", "scope")])
    return cut(last_per_key(every, KEY, [*order, "target_key"]))


def _ddl(df: DataFrame, order: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in order)


def _without(live: DataFrame, slices: DataFrame) -> DataFrame:
    gone = slices.select(F.col("entity").alias("_e"), F.col("scope").alias("_s")).distinct()
    return live.where("kind <> 'meta'").join(gone, F.col("entity").eqNullSafe(F.col("_e")) & F.col("scope").eqNullSafe(F.col("_s")), "left_anti")


def save(cw: DataFrame, path: str, order: tuple[str, ...] = (), whole: bool = False) -> int:
    """Replace the slices that ``cw`` has (with ``whole`` all slices) by its pairs. ``order`` names columns to store, by
    which later upserts are settled; a store keeps those of its first write. Returns the new version."""
    spark = cw.sparkSession
    live = manifest(spark, path)
    ddl, kept, tags = _meta(live)
    if live is None:
        ddl, kept = _ddl(cw, list(order)), list(order)
    rows = _pairs_of(_with_order(cw, ddl, kept), kept)
    v = _taken(spark, path) + 1
    fresh = _write(rows, path, v).withColumn("kind", F.lit("base"))
    if live is not None and not whole:
        fresh = _without(live, rows).select("entity", "scope", "v", "n", "kind").unionByName(fresh)
    _publish(spark, path, v, fresh, ddl, kept, tags)
    return v


def _with_order(df: DataFrame, ddl: str, order: list[str]) -> DataFrame:
    """Order columns that the pairs lack are null: such pairs come before all others."""
    lacking = [c for c in order if c not in df.columns]
    if not lacking:
        return df
    kinds = {f.name: f.dataType for f in df.sparkSession.createDataFrame([], ddl).schema}
    return df.withColumns({c: F.lit(None).cast(kinds[c]) for c in lacking})


def replace_scope(worker: DataFrame, path: str, scope: str) -> int:
    """Replace all slices of one scope by a worker's; slices of it that the worker doesn't have are gone."""
    spark = worker.sparkSession
    live = manifest(spark, path)
    ddl, order, tags = _meta(live)
    rows = _pairs_of(_with_order(worker.where(F.col("scope") == scope), ddl, order), order)
    v = _taken(spark, path) + 1
    fresh = _write(rows, path, v).withColumn("kind", F.lit("base"))
    if live is not None:
        others = live.where("kind <> 'meta'").where(~F.col("scope").eqNullSafe(F.lit(scope)))
        fresh = others.select("entity", "scope", "v", "n", "kind").unionByName(fresh)
    _publish(spark, path, v, fresh, ddl, order, tags)
    return v


def upsert(pairs: DataFrame, path: str, order: list[str] = (), tag: tuple[str, int] | None = None) -> int:
    """Lay pairs over the store: of the pairs of a key the last in order stays. Writes the new pairs only, then rewrites the
    slices whose deltas have grown (`grown`).

    ``tag`` is a writer's name and batch number; a batch whose number is not larger than the writer's last one is not
    written again."""
    spark = pairs.sparkSession
    live = manifest(spark, path)
    ddl, kept, tags = _meta(live)
    if live is None:
        ddl, kept = _ddl(pairs, list(order)), list(order)
    if tag and tags.get(tag[0], -1) >= tag[1]:
        return versions(spark, path)[-1]
    if tag:
        tags = {**tags, tag[0]: tag[1]}
    rows = _pairs_of(_with_order(pairs, ddl, kept), kept)
    v = _taken(spark, path) + 1
    fresh = _write(rows, path, v)
    if live is None:
        _publish(spark, path, v, fresh.withColumn("kind", F.lit("base")), ddl, kept, tags)
        return v
    old = live.where("kind <> 'meta'").select("entity", "scope", "v", "n", "kind")
    known = old.select(F.col("entity").alias("_e"), F.col("scope").alias("_s"), F.lit(True).alias("_known")).distinct()
    same = F.col("entity").eqNullSafe(F.col("_e")) & F.col("scope").eqNullSafe(F.col("_s"))
    kind = F.when(F.col("_known"), "delta").otherwise("base")
    fresh = fresh.join(known, same, "left").withColumn("kind", kind).select("entity", "scope", "v", "n", "kind")
    _publish(spark, path, v, cut(old.unionByName(fresh)), ddl, kept, tags)
    return compact(spark, path)


def grown(live: DataFrame) -> DataFrame:
    """(entity, scope) of slices whose deltas are many or large."""
    sums = live.where("kind <> 'meta'").groupBy("entity", "scope").agg(
        F.count_if(F.col("kind") == "delta").alias("_d"), F.sum(F.when(F.col("kind") == "delta", F.col("n"))).alias("_new"),
        F.sum(F.when(F.col("kind") == "base", F.col("n"))).alias("_old"))
    return sums.where((F.col("_d") >= DELTAS) | (100 * F.col("_new") > GROWN * F.coalesce("_old", F.lit(0)))).where("_d > 0").select("entity", "scope")


def compact(spark: SparkSession, path: str, slices: DataFrame | None = None) -> int:
    """Rewrite slices (default: the grown ones) as one base each. Other slices' data is neither read nor written."""
    live = manifest(spark, path)
    now = versions(spark, path)[-1]
    wanted = cut(grown(live) if slices is None else slices.select("entity", "scope").distinct())
    if wanted.isEmpty():
        return now
    ddl, order, tags = _meta(live)
    pick = wanted.select(F.col("entity").alias("_e"), F.col("scope").alias("_s"))
    same = F.col("entity").eqNullSafe(F.col("_e")) & F.col("scope").eqNullSafe(F.col("_s"))
    mine = live.where("kind <> 'meta'").join(pick, same, "left_semi")
    rows = cut(_folded(_rows(spark, path, mine, ddl), order).select("source_key", "target_key", *order, "entity", "scope"))
    v = _taken(spark, path) + 1
    fresh = _write(rows, path, v).withColumn("kind", F.lit("base"))
    others = _without(live, wanted).select("entity", "scope", "v", "n", "kind")
    _publish(spark, path, v, others.unionByName(fresh), ddl, order, tags)
    return v


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete data that none of the last ``keep`` versions refers to, and older manifests. Returns the deleted data versions.
    Call it when no reader of an older version and no writer is at work."""
    every = versions(spark, path)
    kept = every[-keep:]
    used = {r[0] for n in kept for r in manifest(spark, path, n).where("v is not null").select("v").distinct().collect()}
    where, fs = _fs(spark, f"{path}/data")
    gone = []
    for status in fs.listStatus(where) if fs.exists(where) else []:
        name = status.getPath().getName()
        if name.startswith("v=") and int(name[2:]) not in used:
            fs.delete(status.getPath(), True)
            gone.append(int(name[2:]))
    for n in every[:-keep]:
        fs.delete(_fs(spark, f"{path}/manifest/{n:08d}")[0], True)
    return sorted(gone)
