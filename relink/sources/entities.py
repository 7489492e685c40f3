"""Scans of the landed entities. Each takes page rows (see `pages`) and returns entity rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.predicates import allow
from ..functions.shapes import get, items, linked_ids, member_keys
from ..operators.overlay import overlay
from ..operators.links import distinct_links, remap_links
from ..operators.ranking import first_wins, last_per_key
from .pages import entity_rows


def projects(pages: DataFrame, only=()) -> DataFrame:
    """Allow-listed projects, the first of each code; rows without a code are kept."""
    rows = allow(entity_rows(pages, "project", scope="workspace", dedupe=False), "code", only)
    return first_wins(rows, "code", ["id"])


def users(pages: DataFrame) -> DataFrame:
    """Accounts of people; service accounts carry another type."""
    rows = entity_rows(pages, "user", scope="workspace")
    return rows.where(F.coalesce("type", F.lit("user")) == "user")


def authors(pages: DataFrame) -> DataFrame:
    """uuid -> id, both present, a later row replacing an earlier one."""
    rows = entity_rows(pages, "author", scope="workspace", dedupe=False).where("uuid is not null and id is not null")
    return last_per_key(rows, ["uuid"], ["id"]).select("uuid", "id")


def groups(pages: DataFrame) -> DataFrame:
    rows = entity_rows(pages, "group", scope="workspace")
    return rows.withColumn("members", member_keys("members"))


def custom_fields(pages: DataFrame) -> DataFrame:
    return entity_rows(pages, "custom_field", scope="workspace")


def shared_parameters(pages: DataFrame, project_codes=()) -> DataFrame:
    """Shared parameters of some projects, or all."""
    rows = entity_rows(pages, "shared_parameter", scope="workspace")
    if not project_codes:
        return rows
    wanted = F.array(*[F.lit(c) for c in project_codes])
    return rows.where(F.col("is_enabled_for_all_projects") | F.arrays_overlap("project_codes", wanted))


def milestones(pages: DataFrame) -> DataFrame:
    return entity_rows(pages, "milestone")


def configurations(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, configurations): nested configurations under any of three aliases."""
    rows = entity_rows(pages, "configuration_group")
    nested = F.coalesce(*[F.when(F.col(c).isNotNull(), items(c)) for c in ("configs", "configurations", "entities")])
    flat = rows.select("project_code", F.col("id").alias("group_id"), F.posexplode(nested).alias("pos", "_c"))
    return rows, flat.select("project_code", "group_id", "pos", get(F.col("_c"), "id", "bigint").alias("id"),
                             get(F.col("_c"), "title").alias("title"))


def environments(pages: DataFrame) -> DataFrame:
    return entity_rows(pages, "environment")


def shared_steps(pages: DataFrame) -> DataFrame:
    return entity_rows(pages, "shared_step").where("hash is not null")


def suites(pages: DataFrame) -> DataFrame:
    return entity_rows(pages, "suite")


def cases(pages: DataFrame, detail: DataFrame | None = None) -> DataFrame:
    """Cases; rows with neither steps nor a step type take their detail row, where there is one."""
    rows = entity_rows(pages, "case")
    if detail is None:
        return rows
    thin = F.col("steps").isNull() & F.col("steps_type").isNull()
    fetched = overlay(rows.where(thin), detail, ["project_code", "id"])
    return rows.where(~thin).unionByName(fetched.select(*rows.columns))


def plans(pages: DataFrame, detail: DataFrame | None = None) -> DataFrame:
    """Plans with their detail laid over (detail wins)."""
    rows = entity_rows(pages, "plan")
    return rows if detail is None else overlay(rows, detail, ["project_code", "id"])


def runs(pages: DataFrame) -> DataFrame:
    return entity_rows(pages, "run")


def run_details(pages: DataFrame) -> DataFrame:
    """Detail rows of runs, one per run."""
    return entity_rows(pages, "run", dedupe=True)


def run_links(run_rows: DataFrame, tests: DataFrame | None = None) -> DataFrame:
    """Run -> case links (project_code, run_id, pos, case_id), untested cases included.

    Runs that list no cases fall back to their test rows (project_code, run_id, pos, case_id).
    """
    listed = run_rows.select("project_code", F.col("id").alias("run_id"),
                             F.posexplode(linked_ids("cases")).alias("pos", "case_id"))
    if tests is None:
        return listed
    bare = run_rows.where(F.size(items("cases")) == 0).select("project_code", F.col("id").alias("run_id"))
    found = tests.where("case_id is not null and case_id <> 0").join(bare, ["project_code", "run_id"], "left_semi")
    return listed.unionByName(found.select(*listed.columns))


def mapped_run_links(links: DataFrame, cw: DataFrame, scope: str | None = "project_code") -> DataFrame:
    """Links with target cases: unmapped dropped, the first of equal targets kept."""
    mapped = remap_links(links, cw, "case", "case_id", "target_case", scope)
    return distinct_links(mapped, ["project_code", "run_id"], "target_case", ["pos"])


def results(pages: DataFrame, run_ids=()) -> DataFrame:
    """Results of all runs in one scan; a list of runs prunes it."""
    rows = entity_rows(pages, "result")
    return rows.where(F.col("run_id").isin(list(run_ids))) if run_ids else rows


def result_details(pages: DataFrame) -> DataFrame:
    """Detail rows of results, one per hash."""
    return entity_rows(pages, "result", dedupe=True)


def defects(pages: DataFrame) -> DataFrame:
    return entity_rows(pages, "defect")
