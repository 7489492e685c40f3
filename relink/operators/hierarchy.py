"""Forests held as (id, parent): expansion from the roots, orphans, load order, titles along the path.

Expansion doubles the known stretch of every node's path to the root each round, so a tree of depth d
takes about log2(d) joins instead of d. Only unfinished nodes take part in a round; each round is cut
with a reliable checkpoint. A parent with very many children is a skewed but single-sided key
(unique on the other side), which adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..lineage import cut
from .crosswalk import lookup
from .ranking import first_per_key, orderable

OPEN, REACHED, LOST = "open", "reached", "unreachable"


def expand(
    df: DataFrame, node: str, parent: str, by: list[str] = (), ordinal: str | None = None,
    label: str | None = None, zero_is_root: bool = False,
) -> DataFrame:
    """Walk from the roots. Adds `state` (reached | unreachable), `depth` (root = 0), `path` (ids from
    the root), `order_path` (sibling ordinals from the root; sorting by it gives the pre-order load
    sequence) and, with ``label``, `titles` along the path.

    Nodes whose chain of parents ends in a missing node or a cycle are unreachable, and so is a row without an id. A null
    parent marks a root; with ``zero_is_root`` so does 0. A node that was landed twice is walked and returned once (the
    first by ordinal and its plain columns). Rows without a scope form a scope of their own.
    """
    by = list(by)
    ordinal = ordinal or node
    lone = df.where(F.col(node).isNull())
    df = first_per_key(df.where(F.col(node).isNotNull()), [*by, node], [ordinal, *orderable(df, [*by, node, ordinal])])
    up = F.col(parent)
    if zero_is_root:
        up = F.nullif(up, F.lit(0).cast(df.schema[parent].dataType))
    labels = [F.array(F.col(label)).alias("titles")] if label else []
    state = df.select(
        *by, F.col(node).alias("_id"), up.alias("_up"), F.array(node).alias("path"),
        F.array(ordinal).alias("order_path"), *labels,
        F.when(up.isNull(), REACHED).otherwise(OPEN).alias("state"))
    carried = ["path", "order_path"] + (["titles"] if label else [])

    places = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    known = cut(state)
    while True:
        ahead = known.select(*places, F.col("_id").alias("_head"), F.col("_up").alias("_next"),
                             F.col("state").alias("_state"), *[F.col(c).alias(f"_h_{c}") for c in carried])
        todo = known.where(F.col("state") == OPEN)
        met = todo.join(ahead, reduce(lambda a, b: a & b, [F.col("_up") == F.col("_head"), *same]), "left")
        whole = F.concat("_h_path", "path")
        loops = F.size(F.array_distinct(whole)) < F.size(whole)
        new_state = (F.when(F.col("_state").isNull() | (F.col("_state") == LOST) | loops, LOST)
                     .when(F.col("_state") == REACHED, REACHED).otherwise(OPEN))
        stepped = met.select(
            *by, "_id", F.when(new_state == OPEN, F.col("_next")).alias("_up"),
            *[F.when(new_state == LOST, F.col(c)).otherwise(F.concat(f"_h_{c}", c)).alias(c) for c in carried],
            new_state.alias("state"))
        done = known.where(F.col("state") != OPEN)
        known = cut(done.unionByName(stepped))
        if known.where(F.col("state") == OPEN).isEmpty():
            break
    reached = F.col("state") == REACHED
    walk = known.select(
        *places, "_id", "state",
        F.when(reached, F.size("path") - 1).alias("depth"),
        *[F.when(reached, F.col(c)).alias(c) for c in carried])
    walked = df.join(walk, reduce(lambda a, b: a & b, [F.col(node) == F.col("_id"), *same]), "left").drop("_id", *[f"_by{i}" for i in range(len(by))])
    return walked.unionByName(lone.withColumn("state", F.lit(LOST)), allowMissingColumns=True)


def unreachable(walked: DataFrame) -> DataFrame:
    """Nodes the walk from the roots never meets."""
    return walked.where(F.col("state") == LOST)


def load_order(walked: DataFrame, by: list[str] = ()) -> DataFrame:
    """Reached nodes, parents before children, siblings in input order."""
    return walked.where(F.col("state") == REACHED).orderBy(*by, "order_path")


def remap_parent(df: DataFrame, cw: DataFrame, entity: str, parent: str, out: str, scope: str | None) -> DataFrame:
    """Target key of the parent."""
    return lookup(df, cw, entity, parent, out, scope)


def path_text(c, sep: str = "/") -> Column:
    return F.array_join(F.col(c).cast("array<string>"), sep)
