"""All entities of all projects, and of the workspace, in dependency order.

There is no loop over projects: project is a column of every table. A failed or missing entity does not
vanish: its references come out unmapped and are listed among the rejects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.crosswalk import apply_created, extend, pairs
from ..schemas import WORKSPACE
from . import project as pj, workspace as ws

# Fixed order: an entity comes after everything it refers to.
ORDER = (
    "project", "user", "group", "custom_field", "shared_parameter", "attachment", "milestone", "configuration",
    "environment", "shared_step", "suite", "case", "plan", "run", "result", "defect",
)


def project_entities(
    landed: dict[str, DataFrame], cw: DataFrame, new_workspace: str | None = None, default_user: int = 1,
    created: dict[str, DataFrame] | None = None,
) -> dict[str, dict[str, DataFrame]]:
    """Plan of each landed project entity. ``created`` holds, per entity, what creation answered (project_code, source_id,
    target_key): an entity's answers are laid over the crosswalk before the entities after it are planned, so a second
    call with the answers of the first resolves the references that were open then. ``result_case`` holds the cases that results
    look up, where they are not those of ``case``."""
    build = {
        "milestone": lambda d, cw: pj.milestones(d["milestone"], cw),
        "configuration": lambda d, cw: pj.configurations(d["configuration_group"], d["configuration"], cw),
        "environment": lambda d, cw: pj.environments(d["environment"], cw),
        "shared_step": lambda d, cw: pj.shared_steps(d["shared_step"]),
        "suite": lambda d, cw: pj.suites(d["suite"], cw),
        "case": lambda d, cw: pj.cases(d["case"], cw, new_workspace=new_workspace, default_user=default_user),
        "plan": lambda d, cw: pj.plans(d["plan"], cw),
        "run": lambda d, cw: pj.runs(d["run"], d["run_link"], d["milestone"], cw, default_user),
        "result": lambda d, cw: pj.results(d["result"], d.get("result_detail"), d.get("result_case", d["case"]), cw, new_workspace, default_user),
        "defect": lambda d, cw: pj.defects(d["defect"], cw, new_workspace, default_user),
    }
    plans = {}
    for e in ORDER:
        if e in build and e in landed:
            plans[e] = build[e](landed, cw)
        if created and e in created:
            cw = extend(cw, pairs(created[e], e, "source_id", "target_key", pj.SCOPE))
    return plans


def workspace_entities(
    landed: dict[str, DataFrame], target: dict[str, DataFrame], cw: DataFrame, only=(), skip=(),
    create_users: bool = True, default_user: int = 1, created: dict[str, DataFrame] | None = None,
) -> dict[str, dict[str, DataFrame]]:
    """Plan of each landed workspace entity against what the target has. What an entity's plan matches, and what
    ``created`` says of it (source_id, target_key), is in the crosswalk that the entities after it are planned with: users
    found in this call are seen by groups. The whole crosswalk is returned as plan `crosswalk`.

    Attachments are planned if ``landed`` has attachment (references), project_order and attachment_size.
    """
    build = {
        "project": lambda d, t, cw: ws.projects(d["project"], t["project"], only, skip),
        "user": lambda d, t, cw: ws.users(d["user"], t["user"], create_users, default=default_user),
        "group": lambda d, t, cw: ws.groups(d["group"], t["group"], cw),
        "custom_field": lambda d, t, cw: ws.custom_fields(d["custom_field"], t["custom_field"]),
        "shared_parameter": lambda d, t, cw: ws.shared_parameters(d["shared_parameter"], t["shared_parameter"], cw),
        "attachment": lambda d, t, cw: ws.attachments(d["attachment"], t["attachment"], cw, d["project_order"], d["attachment_size"]),
    }
    plans = {}
    for e in ORDER:
        if e not in build or e not in landed:
            continue
        plans[e] = build[e](landed, target, cw)
        added = [plans[e]["crosswalk"]]
        if created and e in created and "rows" in plans[e]:
            added.append(apply_created(plans[e]["rows"], created[e], e))
        cw = extend(cw, *added)
    return {**plans, "crosswalk": {"crosswalk": cw}}


def all_rejects(plans: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Dropped rows of every plan, with reasons."""
    return reduce(lambda a, b: a.unionByName(b), [p["rejects"] for p in plans.values() if "rejects" in p])


def digest(columns) -> Column:
    """A number of 32 bits from a row's columns as texts (nulls left out), the same in any engine that has MD5. Sums of it tell
    whether two tables hold the same rows, in whatever order."""
    text = F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def plan_summary(landed: dict[str, DataFrame], plans: dict[str, dict[str, DataFrame]], scope: str = pj.SCOPE,
                 contents: dict[str, list] | None = None) -> DataFrame:
    """Rows landed and rows planned, per scope and entity, per scope, and overall.

    ``contents`` names columns of an entity's payload whose digests are added up beside the counts, so that what is to be sent is
    worked out and compared, not only counted. Tables of a plan that nobody reads are not built."""
    def counted(df, entity, landed_n, columns=()):
        place = F.col(scope) if scope in df.columns else F.lit(WORKSPACE)
        value = digest(columns) if columns else F.lit(0).cast("bigint")
        return df.select(place.alias("scope"), F.lit(entity).alias("entity"), F.lit(landed_n).alias("is_landed"), value.alias("_digest"))

    parts = []
    for e, p in plans.items():
        if "payload" not in p:
            continue
        parts += [counted(landed[e], e, True), counted(p["payload"], e, False, (contents or {}).get(e, ()))]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    sums = [F.sum("_digest").alias("digest")] if contents is not None else []
    return (rows.rollup("scope", "entity").agg(
        F.count_if("is_landed").alias("landed"), F.count_if(~F.col("is_landed")).alias("planned"), *sums,
        F.grouping("scope").alias("_s"), F.grouping("entity").alias("_e"))
        .select(F.when(F.col("_s") == 1, "(all)").otherwise(F.col("scope")).alias("scope"),
                F.when(F.col("_e") == 1, "(all)").otherwise(F.col("entity")).alias("entity"), "landed", "planned", *["digest" for _ in sums]))
