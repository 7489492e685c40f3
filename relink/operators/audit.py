"""Counts, reconciliation, rejects and completion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.shapes import as_text, as_type, col, get, is_array, is_object, items
from ..functions.shapes import truncate
from .crosswalk import lookup


def stats(rows: DataFrame, by: list[str], created: str) -> DataFrame:
    """Processed and created per group; ``created`` is null on rows without a target."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("processed"),
                                 F.count(created).alias("created"))


def merge_stats(parts: list[DataFrame], by: list[str]) -> DataFrame:
    """Sum of several workers' stats."""
    every = reduce(lambda a, b: a.unionByName(b), parts)
    return every.groupBy(*by).agg(F.sum("processed").alias("processed"), F.sum("created").alias("created"))


def summary(rows: DataFrame, scope: str, entity: str, created: str) -> DataFrame:
    """Created/processed per project and entity, per project, and for the workspace."""
    return (rows.rollup(scope, entity)
            .agg(F.count(F.lit(1)).alias("processed"), F.count(created).alias("created"),
                 F.grouping(scope).alias("_s"), F.grouping(entity).alias("_e"))
            .select(F.when(F.col("_s") == 1, "(all)").otherwise(F.col(scope)).alias(scope),
                    F.when(F.col("_e") == 1, "(all)").otherwise(F.col(entity)).alias(entity), "processed", "created"))


# Counters of a run that add up to its results.
COUNT_PARTS = ("passed", "failed", "skipped", "blocked", "invalid", "untested", "pending", "in_progress", "retest")


def expected_results(runs: DataFrame) -> Column:
    """Results a run should have: a total among its stats, else the sum of its status counters, else a
    count alias, else the length of its case list, else null."""
    def whole(v):
        n = as_type(v, "bigint")
        return F.when(n >= 0, n)

    have = set(runs.columns)
    stats_sources = [s for s in ("stats", "counters", "statistics") if s in have]
    out = []
    if stats_sources:
        st = F.coalesce(*[F.when(is_object(s) & (as_text(s) != "{}"), F.col(s)) for s in stats_sources])
        out += [whole(F.try_variant_get(st, f"$.{k}", "variant")) for k in ("total", "all", "count", "results")]
        parts = reduce(lambda a, b: a + b, [F.coalesce(get(st, p, "bigint"), F.lit(0)) for p in COUNT_PARTS])
        out.append(F.when(parts > 0, parts))
    out += [F.when(F.col(c) >= 0, F.col(c)) for c in
            ("results_count", "tests_count", "cases_count", "total_tests") if c in have]
    if "cases" in have:
        out.append(F.when(F.size(items("cases")) > 0, F.size(items("cases")).cast("bigint")))
    return F.coalesce(*out)


def project_profile(cases: DataFrame, runs: DataFrame, looked_up: DataFrame) -> DataFrame:
    """Cases, runs and results per project; results are inferred from the run, else looked up.

    ``runs`` has project_code, id and expected; ``looked_up`` has project_code, run_id and total.
    """
    n_cases = cases.groupBy("project_code").agg(F.count(F.lit(1)).alias("cases_total"))
    totals = looked_up.select("project_code", F.col("run_id").alias("id"), F.col("total").alias("_total"))
    n_runs = (runs.join(totals, ["project_code", "id"], "left").groupBy("project_code").agg(
        F.count(F.lit(1)).alias("runs_total"),
        F.sum(F.greatest(F.lit(0), F.coalesce("expected", "_total", F.lit(0)))).alias("results_total")))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("cases_total", "runs_total", "results_total")]
    return n_cases.join(n_runs, "project_code", "full").select("project_code", *zero)


def reconcile(
    run_cw: DataFrame, source: DataFrame, target: DataFrame, entity: str = "run"
) -> DataFrame:
    """Case counts of each mapped run on both sides.

    ``source`` and ``target`` have scope, id, n, plan and title. `outcome` is match, mismatch or missing
    (a side that is not there has n = -1).
    """
    mapped = run_cw.where(F.col("entity") == entity).select("scope", "source_key", "target_key")
    s = source.select(F.col("scope"), F.col("id").cast("string").alias("source_key"), F.col("n").alias("_sn"),
                      F.col("plan").alias("src_plan"), truncate("title", 60).alias("title"))
    t = target.select(F.col("scope"), F.col("id").cast("string").alias("target_key"), F.col("n").alias("_tn"),
                      F.col("plan").alias("tgt_plan"))
    joined = mapped.join(s, ["scope", "source_key"], "left").join(t, ["scope", "target_key"], "left")
    sn, tn = F.coalesce("_sn", F.lit(-1)), F.coalesce("_tn", F.lit(-1))
    outcome = (F.when((sn < 0) | (tn < 0), "missing").when(sn == tn, "match").otherwise("mismatch"))
    return joined.select("scope", "source_key", "target_key", sn.alias("src_n"), tn.alias("tgt_n"),
                         "src_plan", "tgt_plan", "title", outcome.alias("outcome"))


def reconcile_summary(rec: DataFrame, by: list[str] = ()) -> DataFrame:
    """Counts of a reconciliation."""
    planned = F.coalesce(F.col("src_plan") != 0, F.lit(False))
    return rec.groupBy(*by).agg(
        F.count(F.lit(1)).alias("compared"),
        F.count_if(F.col("outcome") == "match").alias("matching"),
        F.count_if(F.col("outcome") == "mismatch").alias("mismatching"),
        F.count_if(F.col("outcome") == "missing").alias("missing"),
        F.count_if(planned).alias("plan_runs"),
        F.count_if(planned & (F.col("outcome") == "match")).alias("plan_runs_match"))


def scope_label(sent, plan_size, actual, has_plan) -> Column:
    """Was the list of cases sent with a plan honoured by the target?"""
    s, a = col(sent), col(actual)
    return (F.when(~col(has_plan), "not judged (no plan)")
            .when(F.coalesce(s, F.lit(0)) == 0, "not judged (no cases)")
            .when(a == s, "honoured").when(a == col(plan_size), "expanded").otherwise("unexpected"))


def scope_after_update(sent, plan_size, before, after, plan_attached) -> Column:
    """The same question after the plan was attached to an existing run."""
    kept = (col(after) == col(before)) & (col(before) == col(sent))
    return (F.when(kept & col(plan_attached), "preserved and attached").when(kept, "preserved, not attached")
            .when(col(after) == col(plan_size), "expanded after update").otherwise("unexpected"))


def completion_queue(
    runs: DataFrame, cw: DataFrame, finished_list: Column, finished_detail: Column, scope: str = "project_code"
) -> DataFrame:
    """Target runs to be completed: finished by the list row, else by the detail row."""
    mapped = lookup(runs.withColumn("_l", finished_list).withColumn("_d", finished_detail), cw, "run", "id",
                    "target_run_id", scope)
    return (mapped.where(F.col("target_run_id").isNotNull() & (F.col("_l") | F.col("_d")))
            .select(scope, F.col("id").alias("source_run_id"), "target_run_id",
                    F.when(F.col("_l"), "list").otherwise("detail").alias("found_in")))


def rejects(rows: DataFrame, entity: str, scope, key, reasons: dict[str, Column]) -> DataFrame:
    """Every dropped row with the first reason that applies; nothing disappears silently."""
    reason = F.coalesce(*[F.when(c, F.lit(name)) for name, c in reasons.items()])
    return rows.withColumn("_reason", reason).where("_reason is not null").select(
        F.lit(entity).alias("entity"), col(scope).alias("scope"), col(key).cast("string").alias("source_key"),
        F.col("_reason").alias("reason"))


def nested_count(groups: DataFrame) -> Column:
    """Configurations of a group under any of three aliases."""
    lists = [F.when(is_array(c), F.size(items(c))) for c in ("configs", "configurations", "entities")
             if c in groups.columns]
    return F.coalesce(*lists, F.lit(0))


def outcome_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def page_completeness(
    pages: DataFrame, rows: DataFrame, by: list[str] = ("entity", "project_code"), expected: DataFrame | None = None
) -> DataFrame:
    """Distinct rows landed against the total the pages declare.

    ``pages`` has total and bad (could not be read), ``rows`` the landed keys. Complete means: a total is declared, as
    many distinct keys are there, and every page could be read. Scopes of ``expected`` (columns ``by``) without any page
    are listed as incomplete. Rows without a key count one by one.
    """
    by = list(by)
    keys = rows.groupBy(*by).agg((F.count_distinct("key") + F.count_if(F.col("key").isNull())).alias("landed"))
    per = pages.groupBy(*by).agg(F.max("total").alias("declared"), F.count(F.lit(1)).alias("n_pages"), F.count_if("bad").alias("n_bad"))
    if expected is not None:
        per = expected.select(*by).distinct().join(per, by, "full").fillna(0, ["n_pages", "n_bad"])
    per = per.join(keys, by, "left").withColumn("landed", F.coalesce("landed", F.lit(0)))
    whole = F.coalesce(F.col("landed") >= F.col("declared"), F.lit(False)) & (F.col("n_bad") == 0)
    return per.select(*by, "landed", "declared", "n_pages", "n_bad", whole.alias("complete"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Log line of a run: cut title, lengths, counts."""
    return runs.select(
        "project_code", F.col("id").alias("source_run_id"),
        F.left(F.coalesce("title", F.lit("")), F.lit(200)).alias("title"),
        F.length(F.coalesce("description", F.lit(""))).alias("description_len"),
        as_text("user_id").alias("user_id"), "start_time", "end_time", "plan_id", "milestone_id",
        F.when(is_object("milestone"), get("milestone", "title")).alias("milestone_title"),
        F.when(is_array("cases"), F.size(items("cases"))).alias("n_cases_on_run"))


def sent_summary(payload: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """Log line of a result as it is sent; ``steps`` is the merged step table, of which the roots are counted."""
    key = ["project_code", "hash"]
    rows = payload if steps is None else payload.join(
        steps.where(F.size("path") == 1).groupBy(*key).agg(F.count(F.lit(1)).alias("_roots")), key, "left")
    return rows.select(
        "project_code", "run_id", "hash", "chunk", "pos", "target_case_id", F.left(F.coalesce("title", F.lit("")), F.lit(200)).alias("title"),
        (F.lit(0) if steps is None else F.coalesce("_roots", F.lit(0))).cast("bigint").alias("n_step_roots"),
        F.size(F.coalesce("attachments", F.array().cast("array<string>"))).alias("n_attachments"), F.col("status").alias("execution_status"),
        F.col("duration_ms").alias("execution_duration_ms"), F.length(F.coalesce("message", F.lit(""))).alias("message_len"))


def chunk_summary(sent: DataFrame, by: tuple[str, ...] = ("project_code", "run_id", "chunk")) -> DataFrame:
    """Log line of a chunk: how many rows, and their summaries in order (a chunk's size is fixed)."""
    items_of = [c for c in sent.columns if c not in by]
    return sent.groupBy(*by).agg(F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_list(
        F.struct("pos", *[c for c in items_of if c != "pos"]))).alias("items"))


def result_summary(results: DataFrame) -> DataFrame:
    """Log line of an enriched result."""
    return results.select(
        "project_code", as_text("case_id").alias("source_case_id"), "hash", "status_id",
        F.left(F.coalesce("title", F.lit("")), F.lit(200)).alias("title"),
        F.size(items("steps")).alias("n_steps"), F.size(items("attachments")).alias("n_attachments_coalesced"),
        F.size(items("files")).alias("n_files"), F.size(items("screenshots")).alias("n_screenshots"),
        is_object("execution").alias("has_execution_block"),
        F.length(F.coalesce("comment", F.lit(""))).alias("comment_len"),
        F.length(F.coalesce("message", F.lit(""))).alias("message_len"))
