"""The crosswalk (source key -> target key per entity and scope) and lookups through it.

Size of a crosswalk is not known in advance, so no side is broadcast by hint: adaptive execution
broadcasts a side whose measured size is small and otherwise sorts and merges, splitting skewed
partitions. `spread` adds explicit salting of the hottest keys for plans where that split cannot apply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.shapes import col
from ..lineage import cut
from ..schemas import WORKSPACE
from .ranking import first_per_key, hot_keys, last_per_key, number_rows


def build_crosswalk(pairs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Make (entity, scope, source_key) unique; the last pair in ``order`` wins."""
    keyed = pairs.where("source_key is not null and target_key is not null")
    kept = last_per_key(keyed, ["entity", "scope", "source_key"], order or ["target_key"])
    return kept.select("entity", "scope", "source_key", "target_key")


def pairs(df: DataFrame, entity: str, source, target, scope=WORKSPACE) -> DataFrame:
    """Crosswalk rows from a table that holds both keys."""
    scope = F.lit(scope) if scope == WORKSPACE else col(scope)
    return df.select(
        F.lit(entity).alias("entity"), scope.alias("scope"), col(source).cast("string").alias("source_key"),
        col(target).cast("string").alias("target_key"))


def from_buckets(buckets: DataFrame) -> DataFrame:
    """Saved buckets (entity, scope, entries map) -> long rows; keys stay text."""
    return buckets.select("entity", F.coalesce("scope", F.lit(WORKSPACE)).alias("scope"),
                          F.explode("entries").alias("source_key", "target_key"))


def slice_of(cw: DataFrame, entity: str, out: str, scoped: bool) -> DataFrame:
    rows = cw.where(F.col("entity") == entity)
    if scoped:
        return rows.select(F.col("scope").alias("_scope"), F.col("source_key").alias("_key"),
                           F.col("target_key").alias(out))
    return rows.where(F.col("scope") == WORKSPACE).select(
        F.col("source_key").alias("_key"), F.col("target_key").alias(out))


def lookup(
    df: DataFrame, cw: DataFrame, entity: str, key, out: str, scope: str | None = None,
    default=None, spread: Column | None = None, salts: int = 32,
) -> DataFrame:
    """Add ``out``, the target of ``key``; null (or ``default``) when unmapped. Keeps every row.

    ``scope`` names the scope column; without it the workspace slice is used. ``spread`` is any
    row-unique column; with it, keys holding at least 0.1 % of the rows are salted.
    """
    right = slice_of(cw, entity, out, scope is not None)
    left = df.withColumn("_key", col(key).cast("string"))
    on = ["_key"]
    if scope is not None:
        left, on = left.withColumn("_scope", F.col(scope)), ["_scope", "_key"]
    joined = (left.join(right, on, "left") if spread is None
              else salted_left_join(left, right, on, spread, salts))
    if default is not None:
        joined = joined.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return joined.select(*df.columns, out)


def salted_left_join(
    left: DataFrame, right: DataFrame, on: list[str], spread: Column, salts: int = 32
) -> DataFrame:
    """Left join to a right side unique in ``on``, hot left keys spread over ``salts`` partitions.

    The hot list holds at most 1,000 keys by construction, so broadcasting it is safe; only those
    right rows are repeated. The salt comes from the row itself, so retried tasks agree.
    """
    hot = F.broadcast(hot_keys(left.select(*on), on).withColumn("_hot", F.lit(True)))
    salted = left.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    copies = right.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                           .otherwise(F.array(F.lit(0)))))
    return salted.drop("_hot").join(copies.drop("_hot"), on + ["_salt"], "left").drop("_salt")


def natural_key(c, trim: bool = True) -> Column:
    """Normalised natural key; blank is no key."""
    k = F.lower(F.trim(col(c)) if trim else col(c))
    return F.nullif(k, F.lit(""))


def match_or_create(
    source: DataFrame, target: DataFrame, source_id: str, source_key: Column, target_key: Column,
    target_id: str, order: list[str], target_order: list[str], dedupe_new: bool = True, eligible: Column | None = None,
) -> DataFrame:
    """Match source rows to target rows by natural key; say which remain to be created.

    Adds `target_key`, `outcome` (matched | to_create | reuse_new | ineligible | invalid) and `created_from`,
    the source id whose creation serves the row. Of several target rows with one key the last wins; new rows
    sharing a key are created once (the first in order that is ``eligible``) unless ``dedupe_new`` is false.
    Rows after that one reuse it, eligible or not; rows before it, or of a key that nothing creates, are ineligible.
    """
    may = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    existing = last_per_key(
        target.select(target_key.alias("_nk"), F.col(target_id).cast("string").alias("target_key"),
                      *[F.col(c).alias(f"_o{i}") for i, c in enumerate(target_order)])
        .where("_nk is not null"),
        ["_nk"], [f"_o{i}" for i in range(len(target_order))]).select("_nk", "target_key")
    keyed = source.withColumn("_nk", source_key).join(existing, "_nk", "left")
    valid = F.col("_nk").isNotNull() & F.col(source_id).isNotNull()
    if dedupe_new:
        new = source.withColumn("_nk", source_key).where(valid & may)
        first = first_per_key(new, ["_nk"], order).select(
            "_nk", F.col(source_id).alias("created_from"), F.struct(*order).alias("_first"))
        keyed = keyed.join(first, "_nk", "left")
        later = F.col("created_from").isNotNull() & (F.struct(*order) >= F.col("_first"))
    else:
        keyed, later = keyed.withColumn("created_from", F.when(may, F.col(source_id))), may
    outcome = (F.when(~valid, "invalid").when(F.col("target_key").isNotNull(), "matched").when(~later, "ineligible")
               .when(may & (F.col("created_from") == F.col(source_id)), "to_create").otherwise("reuse_new"))
    made = F.when(F.col("outcome").isin("to_create", "reuse_new"), F.col("created_from"))
    return (keyed.withColumn("outcome", outcome).withColumn("created_from", made)
            .withColumn("target_key", F.when(valid, F.col("target_key")))
            .select(*source.columns, "target_key", "outcome", "created_from"))


def titles_to_ids(df: DataFrame, title: str, row_id: str, by: list[str], order: list[str]) -> DataFrame:
    """Title -> id within a scope; of equal titles the last wins."""
    named = df.where(F.coalesce(F.col(title) != "", F.lit(False)) & F.col(row_id).isNotNull())
    return last_per_key(named, [*by, title], order).select(*by, title, row_id)


def lookup_by_title(
    df: DataFrame, titles: DataFrame, title: str, by: list[str], row_id: str, fallback: str | None, out: str
) -> DataFrame:
    """Id by title; ``fallback`` is used only on rows without a title."""
    right = titles.select(*[F.col(c).alias(f"_t{i}") for i, c in enumerate([*by, titles.columns[len(by)]])],
                          F.col(row_id).alias("_found"))
    on = [F.col(c) == F.col(f"_t{i}") for i, c in enumerate([*by, title])]
    joined = df.join(right, on, "left")
    found = F.col("_found") if fallback is None else F.when(
        F.coalesce(F.col(title) == "", F.lit(True)), F.col(fallback)).otherwise(F.col("_found"))
    return joined.withColumn(out, found).select(*df.columns, out)


def first_whole_id(*aliases) -> Column:
    """First alias that is a whole number."""
    return F.coalesce(*[col(c).try_cast("bigint") for c in aliases])


def attribute(
    df: DataFrame, cw: DataFrame, uuid: str | None, aliases: list[str], out: str, default: int = 1
) -> DataFrame:
    """Target user: author uuid -> author id -> user, else the first whole-number alias -> user; id 0
    and rows with no usable id take the default, as do users without a target."""
    work = df
    by_uuid = F.lit(None).cast("bigint")
    if uuid is not None:
        work = lookup(work, cw, "author", uuid, "_author")
        by_uuid = F.col("_author").try_cast("bigint")
    chosen = F.coalesce(by_uuid, first_whole_id(*aliases)) if aliases else by_uuid
    work = lookup(work.withColumn("_uid", chosen), cw, "user", "_uid", "_user")
    target = F.when(F.coalesce(F.col("_uid"), F.lit(0)) == 0, F.lit(default)).otherwise(
        F.coalesce(F.col("_user").try_cast("bigint"), F.lit(default)))
    return work.withColumn(out, target).select(*df.columns, out)


def resume(df: DataFrame, cw: DataFrame, entity: str, key: str, scope: str | None = None) -> DataFrame:
    """Rows whose key has no target yet."""
    done = slice_of(cw, entity, "_target", scope is not None)
    on = F.col(key).cast("string") == F.col("_key")
    if scope is not None:
        on = on & (F.col(scope) == F.col("_scope"))
    return df.join(done, on, "left_anti")


def apply_created(rows: DataFrame, responses: DataFrame, entity: str, source_id: str = "id", scope=WORKSPACE) -> DataFrame:
    """Crosswalk rows that creation adds: ``rows`` is what `match_or_create` returned, ``responses`` has source_id and
    target_key of what was created. Rows that reuse a new one get its target; failed creations give no row. Of repeated
    responses the largest key counts, so that a retried call changes nothing."""
    made = responses.where("target_key is not null").groupBy(F.col("source_id").cast("string").alias("_made")).agg(
        F.max(F.col("target_key").cast("string")).alias("_new"))
    served = rows.where("outcome in ('to_create', 'reuse_new')").withColumn("_made", F.col("created_from").cast("string"))
    return pairs(served.join(made, "_made"), entity, source_id, "_new", scope)


def extend(cw: DataFrame, *added: DataFrame) -> DataFrame:
    """A crosswalk with further pairs laid over it: of one key the later frame's pair stays."""
    every = cw.withColumn("_turn", F.lit(0))
    for i, a in enumerate(added):
        every = every.unionByName(a.withColumn("_turn", F.lit(i + 1)))
    return build_crosswalk(every, ["_turn", "target_key"])


def replace_slices(main: DataFrame, worker: DataFrame, scope: str) -> DataFrame:
    """Main crosswalk with one scope's rows replaced by a worker's."""
    return main.where(F.col("scope") != scope).unionByName(
        worker.where(F.col("scope") == scope).select(*main.columns))


def collisions(df: DataFrame, original: str, made: str) -> DataFrame:
    """Made ids that stand for more than one original."""
    return (df.select(original, made).distinct().groupBy(made)
            .agg(F.count(F.lit(1)).alias("n_originals"), F.min(original).alias("first_original"))
            .where("n_originals > 1"))


#: Rounds of probing after which the few originals left are dealt the free ids in order.
ROUNDS = 12


def assign_ids(originals: DataFrame, original: str, low: int, high: int, taken: DataFrame | None = None, by: list[str] = ()) -> DataFrame:
    """An id of its own in [low, high] for every distinct original: (by..., original, made). No id is given twice in a group ``by``.

    ``taken`` has what earlier loads gave (same columns) and is returned as it is, so a later load changes no id. In each round
    an original without an id tries a hash of itself and the round; of those that try one free id the least original gets it. After
    ROUNDS rounds few are left even in a full range: they get the free ids in order. The result depends on the originals
    and ``taken`` only. Null originals get none; a group with more originals than ids is an error.
    """
    by = list(by)
    spark = originals.sparkSession
    size = high - low + 1
    same = [*by, original]
    every = originals.where(F.col(original).isNotNull()).select(*same).distinct()
    given = every.limit(0).withColumn("made", F.lit(None).cast("bigint")) if taken is None else taken.select(*same, F.col("made").cast("bigint").alias("made"))
    open_ = cut(every.join(given.select(*same), same, "left_anti"))
    counts = open_.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).unionByName(given.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")))
    if not counts.groupBy(*by).agg(F.sum("_n").alias("_n")).where(F.col("_n") > size).isEmpty():
        raise ValueError(f"more originals than the {size} ids from {low} to {high}")
    for turn in range(ROUNDS):
        if open_.isEmpty():
            return given
        tries = open_.withColumn("made", F.lit(low) + F.pmod(F.xxhash64(F.col(original), F.lit(turn)), F.lit(size)))
        free = tries.join(given.select(*by, "made"), [*by, "made"], "left_anti")
        won = free.groupBy(*by, "made").agg(F.min(original).alias(original)).select(*same, "made")
        given = cut(given.unionByName(won))
        open_ = cut(open_.join(given.select(*same), same, "left_anti"))
    if open_.isEmpty():
        return given
    wanting = open_.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    used = given.join(wanting.select(*by), by, "left_semi") if by else given
    ids = spark.range(low, high + 1).select(F.col("id").alias("made"))
    groups = wanting.select(*by)
    if by:
        every_id = groups.select(*by, F.explode(F.sequence(F.lit(low).cast("bigint"), F.lit(high).cast("bigint"))).alias("made"))
    else:
        every_id = ids
    free = every_id.join(used.select(*by, "made"), [*by, "made"], "left_anti")
    numbered = number_rows(free, by, ["made"], "_r").withColumnRenamed("made", "_made")
    rest = number_rows(open_, by, [original], "_r").join(numbered, [*by, "_r"]).select(*same, F.col("_made").alias("made"))
    return given.unionByName(rest)
