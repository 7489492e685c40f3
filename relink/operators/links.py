"""Rewriting foreign keys, key lists, map keys and keys in text through the crosswalk.

Wide rows with many references resolve them all in one pass: `resolve_refs` shuffles only slim
(row, entity, key) triples, looks them up once, and brings one small map per row back.
Unbounded link sets stay link tables (parent, position, child) and are never gathered into a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.shapes import col, let, none_of
from ..functions.text import embedded_keys, normal_key, packed, rewrite_keys, unpacked
from ..schemas import WORKSPACE
from .crosswalk import slice_of
from .ranking import first_per_key

SEP = "\u001f"


def resolve_refs(
    df: DataFrame, cw: DataFrame, row_key: list[str], refs: dict[str, Column], scope: str | None = None,
    workspace: tuple[str, ...] = (), out: str = "targets",
) -> DataFrame:
    """Add ``out``: map of `entity␟source key` -> target key for the references of each row.

    ``refs`` gives, per entity, an array of text keys; entities in ``workspace`` (or all, without a
    ``scope`` column) use the workspace slice. ``row_key`` must identify the row. A row with a null scope resolves its
    workspace references, and others where the crosswalk has pairs without a scope; a row whose key lacks any other part
    can't be told from its like and gets no map (plans reject it).
    """
    def tagged(entity, keys):
        place = F.lit(WORKSPACE) if scope is None or entity in workspace else F.col(scope)
        return F.transform(
            F.array_distinct(F.filter(keys.cast("array<string>"), lambda k: k.isNotNull())),
            lambda k: F.struct(F.lit(entity).alias("entity"), place.alias("scope"), k.alias("source_key")))

    arrays = [F.coalesce(tagged(e, k), none_of("array<struct<entity:string,scope:string,source_key:string>>")) for e, k in refs.items()]
    every = reduce(lambda a, b: F.concat(a, b), arrays)
    # Keys travel as bytes, digests at half their length.
    kept = ["_r.entity", F.col("_r.scope").alias("_place"), packed("_r.source_key").alias("_source")]
    sure = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in row_key if c != scope] or [F.lit(True)])
    slim = df.where(sure).select(*row_key, F.explode(every).alias("_r")).select(*row_key, *kept)
    wanted = cw.where(F.col("entity").isin(*refs)).select(
        "entity", F.col("scope").alias("_cw_scope"), packed("source_key").alias("_known"), packed("target_key").alias("_target"))
    hits = (slim.join(wanted, (slim["entity"] == wanted["entity"]) & slim["_place"].eqNullSafe(wanted["_cw_scope"])
                      & (slim["_source"] == wanted["_known"]))
            .select(*row_key, slim["entity"], slim["_source"], "_target"))
    # A row's map holds at most the row's own distinct references; of several targets of one key the largest counts.
    found = hits.groupBy(*row_key).agg(F.collect_list(F.struct("entity", "_source", "_target")).alias("_h"))
    entries = F.array_sort(F.transform("_h", lambda h: F.struct(
        F.concat_ws(SEP, h["entity"], unpacked(h["_source"])).alias("key"), unpacked(h["_target"]).alias("target_key"))))
    last = let(entries, lambda es: F.filter(es, lambda e, i: (i == F.size(es) - 1) | (F.get(es, i + 1)["key"] != e["key"])))
    maps = found.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(row_key)], F.map_from_entries(last).alias(out))
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) if c == scope else F.col(c) == F.col(f"_k{i}") for i, c in enumerate(row_key)]
    return df.join(maps, reduce(lambda a, b: a & b, on), "left").select(*df.columns, out)


def target_of(targets, entity: str, key) -> Column:
    """Target of one key from the map of `resolve_refs`; null when unmapped."""
    return F.try_element_at(col(targets), F.concat(F.lit(entity + SEP), col(key).cast("string")))


def text_targets(targets, entity: str) -> Column:
    """The part of the map that concerns one entity, keyed by plain source key."""
    kept = F.map_filter(col(targets), lambda k, _: k.startswith(entity + SEP))
    return F.transform_keys(kept, lambda k, _: F.substring_index(k, SEP, -1))


def remap_list(keys, targets, entity: str, distinct: bool = False) -> Column:
    """Array of source keys -> array of target keys: unmapped dropped, order kept."""
    hit = F.filter(F.transform(col(keys), lambda k: target_of(targets, entity, k)), lambda t: t.isNotNull())
    hit = F.coalesce(hit, none_of("array<string>"))
    return F.array_distinct(hit) if distinct else hit


def remap_map_keys(entries, targets, entity: str) -> Column:
    """array<struct<key,value>> with remapped keys; unmapped keys dropped, a later entry of one
    target replaces an earlier one."""
    from ..functions.shapes import last_per_key

    made = F.filter(
        F.transform(col(entries), lambda e: F.struct(
            target_of(targets, entity, e["key"]).alias("key"), e["value"].alias("value"))),
        lambda e: e["key"].isNotNull())
    return last_per_key(made)


def remap_links(
    links: DataFrame, cw: DataFrame, entity: str, child: str, out: str, scope: str | None = None,
) -> DataFrame:
    """Link table with target children; unmapped links are dropped."""
    right = slice_of(cw, entity, out, scope is not None)
    on = F.col(child).cast("string") == F.col("_key")
    if scope is not None:
        on = on & (F.col(scope) == F.col("_scope"))
    return links.join(right, on).select(*links.columns, out)


def distinct_links(links: DataFrame, parent: list[str], child: str, order: list[str]) -> DataFrame:
    """First link per (parent, child), position kept."""
    return first_per_key(links, [*parent, child], order)


def parents_with_links(parents: DataFrame, links: DataFrame, on: list[str]) -> DataFrame:
    """Parents that keep at least one link."""
    return parents.join(links.select(*on), on, "left_semi")


def refs_in_text(columns) -> Column:
    """Distinct keys found in several text columns of a row."""
    return F.array_distinct(F.flatten(F.array(*[embedded_keys(c) for c in columns])))


def rewrite_text(
    df: DataFrame, cw: DataFrame, row_key: list[str], columns: list[str], entity: str = "attachment",
    scope: str | None = None, new_workspace=None, symmetric: bool = False,
) -> DataFrame:
    """Rewrite the keys embedded in text columns. Texts without a mapped key are unchanged.

    Only keys travel to the crosswalk; the text itself moves once, when its row meets its map."""
    resolved = resolve_refs(df, cw, row_key, {entity: refs_in_text(columns)}, scope, out="_targets")
    m = text_targets("_targets", entity)
    for c in columns:
        resolved = resolved.withColumn(c, rewrite_keys(c, m, new_workspace, symmetric))
    return resolved.select(*df.columns)


def substitute_refs(steps, targets, entity: str, ref) -> Column:
    """Steps that refer to a shared step keep only the mapped reference; an unmapped reference drops
    the step; other steps stay. ``ref`` reads the reference of one step."""
    kept = F.filter(col(steps), lambda s: ref(s).isNull() | target_of(targets, entity, ref(s)).isNotNull())
    return F.transform(kept, lambda s: F.struct(
        target_of(targets, entity, ref(s)).alias("shared"), s.alias("step")))


def fan_out(refs: DataFrame, global_map: DataFrame, scope: str, key: str) -> DataFrame:
    """Per-scope map from a global key map: (scope, key, target)."""
    wanted = refs.select(F.col(scope), normal_key(key).alias(key)).distinct()
    return wanted.join(global_map, key)


def first_owner(refs: DataFrame, key: str, scope: str, ordinal: str) -> DataFrame:
    """Owner of each key: the first scope, in the given order, that refers to it."""
    return refs.groupBy(key).agg(F.min_by(scope, ordinal).alias("owner"))
