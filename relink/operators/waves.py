"""Loading a forest wave by wave: the answers to one depth are the parents of the next.

Creation gives new keys, and a child is sent with its parent's new key, so a forest is loaded in as many waves as it is
deep. A node that gets no key takes its whole subtree with it; every row ends up sent, known already, or rejected with a
reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..lineage import cut
from . import hierarchy
from .audit import rejects
from .coverage import same_group
from .crosswalk import extend, pairs

REASONS = {"failed": "not created", "blocked": "an ancestor was not created", "lost": "parent never reached"}


def load_waves(
    walked: DataFrame, cw: DataFrame, entity: str, scope: str, send: Callable[[DataFrame], DataFrame],
    node: str = "id", parent: str = "parent_id", ready: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Send the nodes of an expanded forest (`hierarchy.expand`), one depth after the other.

    ``send`` gets a wave (the row's columns, `wave` and `parent_target`), once and written, and answers with (scope, node,
    target_key); rows it leaves out or answers with null count as failed, answers to other rows are ignored, and of several
    answers to a row the largest counts. ``ready`` shapes a wave before it is sent. Nodes that the crosswalk knows already are
    not sent again, and their children go on below the known key: with the crosswalk of a first call, a second one sends
    only what failed and what was blocked by it.

    Returns `payload` (what was sent, with `wave`), `created` (crosswalk rows), `resumed`, `rejects` and the extended
    `crosswalk`. payload + resumed + rejects of what was never sent = all rows; failed rows are among payload and rejects.
    """
    known = cw.where(F.col("entity") == entity).select(F.col("scope").alias(f"_{scope}"), F.col("source_key").alias("_key"), F.col("target_key").alias("_target"))
    here = same_group([scope])
    rows = cut(walked.join(known, here & (F.col(node).cast("string") == F.col("_key")), "left").drop(f"_{scope}", "_key"))
    reached = rows.where(F.col("state") == hierarchy.REACHED)
    resumed = reached.where("_target is not null")
    depths = reached.where("_target is null").agg(F.min("depth"), F.max("depth")).first()
    made = resumed.select(F.col(scope).alias(f"_{scope}"), F.col(node).alias("_up"), F.col("_target").alias("parent_target"))
    sent, answered = [], []
    if depths[0] is not None:
        for depth in range(depths[0], depths[1] + 1):
            wave = reached.where((F.col("depth") == depth) & F.col("_target").isNull()).drop("_target")
            above = made if depth else made.limit(0)
            ready_rows = wave.join(above, here & (F.col(parent) == F.col("_up")), "left" if depth == 0 else "inner").drop(f"_{scope}", "_up")
            shaped = ready_rows.withColumn("wave", F.lit(depth))
            shaped = cut(ready(shaped) if ready else shaped)
            if shaped.isEmpty():  # all parents failed; deeper rows may still stand below known ones
                continue
            answers = send(shaped).where("target_key is not null").groupBy(F.col(scope).alias(f"_{scope}"), F.col(node).alias("_up")).agg(
                F.max(F.col("target_key").cast("string")).alias("parent_target"))
            asked = shaped.select(scope, node)
            got = cut(answers.join(asked, here & (F.col(node) == F.col("_up")), "left_semi"))
            sent.append(shaped)
            answered.append(got)
            made = made.unionByName(got)
    payload = _all(sent) if sent else reached.limit(0).drop("_target").withColumn("parent_target", F.lit(None).cast("string")).withColumn("wave", F.lit(0))
    answers = _all(answered) if answered else made.limit(0)
    created = pairs(answers, entity, "_up", "parent_target", f"_{scope}")
    was_sent = payload.select(F.col(scope).alias(f"_{scope}"), F.col(node).alias("_up"), F.lit(True).alias("_sent"))
    has_key = answers.select(f"_{scope}", "_up", F.lit(True).alias("_made"))
    judged = rows.join(was_sent, here & (F.col(node) == F.col("_up")), "left").drop(f"_{scope}", "_up")
    judged = judged.join(has_key, here & (F.col(node) == F.col("_up")), "left").drop(f"_{scope}", "_up")
    reached_now = F.coalesce(F.col("state") == hierarchy.REACHED, F.lit(False))
    unsent = F.col("_sent").isNull() & F.col("_target").isNull()
    return {
        "payload": payload, "created": created, "resumed": resumed.drop("_target"),
        "rejects": rejects(judged, entity, scope, node, {
            REASONS["lost"]: ~reached_now, REASONS["failed"]: F.col("_sent").isNotNull() & F.col("_made").isNull(),
            REASONS["blocked"]: reached_now & unsent}),
        "crosswalk": extend(cw, created) if answered else cw,
    }


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
