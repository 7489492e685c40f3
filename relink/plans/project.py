"""Project entities in dependency order. Project is a column: all projects are planned at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, enums, shapes, text
from ..functions.predicates import defect_resolved, has_all, run_finished
from ..functions.shapes import as_text, as_type, first_truthy, get, is_array, is_object, items, none_of
from ..lineage import stored
from ..operators import hierarchy, overlay as ov
from ..operators.audit import rejects
from ..operators.crosswalk import lookup, lookup_by_title, resume, titles_to_ids
from ..operators.links import (
    distinct_links, refs_in_text, remap_links, remap_list, remap_map_keys, resolve_refs, target_of, text_targets,
)
from ..operators.ranking import chunk_index, first_per_key, orderable
from ..operators.waves import load_waves

SCOPE = "project_code"
ROW = [SCOPE, "id"]


class Members(dict):
    """A plan's tables; one that needs jobs of its own is built when it is first read."""

    def __getitem__(self, name: str) -> DataFrame:
        made = super().__getitem__(name)
        if not isinstance(made, DataFrame):
            made = self[name] = made()
        return made


def milestones(rows: DataFrame, cw: DataFrame | None = None) -> dict[str, DataFrame]:
    """Milestones parents-first; 0 counts as no parent. With a crosswalk, `parent_target` is the parent's target where
    it is known already; the others are created level by level."""
    walked = hierarchy.expand(rows, "id", "parent_id", [SCOPE], zero_is_root=True)
    ok = walked.where("state = 'reached'")
    ok = (ok.withColumn("parent_target", F.lit(None).cast("string")) if cw is None
          else hierarchy.remap_parent(ok, cw, "milestone", "parent_id", "parent_target", SCOPE))
    return {
        "payload": ok.select(
            SCOPE, F.col("id").alias("source_id"), "title",
            F.coalesce("description", F.lit("")).alias("description"),
            F.coalesce("status", F.lit("active")).alias("status"), dates.day("due_date").alias("due_date"),
            "parent_id", "parent_target", "depth", "order_path"),
        "rejects": rejects(walked, "milestone", SCOPE, "id", {
            "parent never reached": F.col("state") == hierarchy.LOST}),
    }


def configurations(groups: DataFrame, nested: DataFrame, cw: DataFrame) -> dict[str, DataFrame]:
    """Groups, and those of their configurations that have a title and are not mapped yet."""
    fresh = resume(nested, cw, "configuration", "id", SCOPE)
    return {
        "payload_groups": groups.select(SCOPE, F.col("id").alias("source_id"), "title"),
        "payload": fresh.where(has_all("title")).select(SCOPE, "group_id", F.col("id").alias("source_id"), "title"),
        "rejects": rejects(fresh, "configuration", SCOPE, "id", {"no title": ~has_all("title")}),
    }


def environments(rows: DataFrame, cw: DataFrame) -> dict[str, DataFrame]:
    fresh = resume(rows, cw, "environment", "id", SCOPE)
    return {
        "payload": fresh.where(has_all("id", "title")).select(
            SCOPE, F.col("id").alias("source_id"), "title", F.coalesce("slug", F.lit("")).alias("slug"),
            F.coalesce("host", F.lit("")).alias("host"), F.nullif(F.col("description"), F.lit("")).alias("description")),
        "rejects": rejects(fresh, "environment", SCOPE, "id", {"no id or title": ~has_all("id", "title")}),
    }


def shared_steps(rows: DataFrame) -> dict[str, DataFrame]:
    return {
        "payload": rows.where(has_all("hash")).select(
            SCOPE, F.col("hash").alias("source_hash"), "title", shapes.clean_shared_steps("steps").alias("steps")),
        "rejects": rejects(rows, "shared_step", SCOPE, "title", {"no hash": ~has_all("hash")}),
    }


def suites(rows: DataFrame, cw: DataFrame) -> dict[str, DataFrame]:
    """Suites parents-first, with the remapped parent where it is known already."""
    walked = hierarchy.expand(rows, "id", "parent_id", [SCOPE])
    ok = hierarchy.remap_parent(walked.where("state = 'reached'"), cw, "suite", "parent_id", "parent_target", SCOPE)
    return {
        "payload": ok.select(
            SCOPE, F.col("id").alias("source_id"), text.suite_title("title", "name", "id").alias("title"),
            F.coalesce("description", F.lit("")).alias("description"),
            F.coalesce("preconditions", F.lit("")).alias("preconditions"),
            "parent_id", "parent_target", "depth", "order_path"),
        "rejects": rejects(walked, "suite", SCOPE, "id", {"parent never reached": F.col("state") == hierarchy.LOST}),
    }


def suite_waves(rows: DataFrame, cw: DataFrame, send) -> dict[str, DataFrame]:
    """Suites created parents-first in one call, each below its parent's new key; see `waves.load_waves`."""
    def ready(wave):
        return wave.select(
            SCOPE, "id", text.suite_title("title", "name", "id").alias("title"), F.coalesce("description", F.lit("")).alias("description"),
            F.coalesce("preconditions", F.lit("")).alias("preconditions"), "parent_id", "parent_target", "depth", "order_path", "wave")

    return load_waves(hierarchy.expand(rows, "id", "parent_id", [SCOPE]), cw, "suite", SCOPE, send, ready=ready)


def milestone_waves(rows: DataFrame, cw: DataFrame, send) -> dict[str, DataFrame]:
    """Milestones created parents-first in one call; 0 counts as no parent."""
    def ready(wave):
        return wave.select(
            SCOPE, "id", "title", F.coalesce("description", F.lit("")).alias("description"), F.coalesce("status", F.lit("active")).alias("status"),
            dates.day("due_date").alias("due_date"), "parent_id", "parent_target", "depth", "order_path", "wave")

    return load_waves(hierarchy.expand(rows, "id", "parent_id", [SCOPE], zero_is_root=True), cw, "milestone", SCOPE, send, ready=ready)


def _shared_ref(step) -> Column:
    """Shared-step reference under any of its aliases."""
    return F.coalesce(
        F.nullif(get(step, "shared"), F.lit("")),
        F.nullif(get(step, "shared_step.hash"), F.lit("")),
        F.nullif(get(step, "shared_step_hash"), F.lit("")))


def _case_attachment(item) -> Column:
    """Key of a case or defect attachment: the text itself, `hash`, or the key in `url`."""
    in_url = F.nullif(F.regexp_extract(get(item, "url"), text.STRICT_KEY_IN_URL, 1), F.lit(""))
    from_object = F.coalesce(get(item, "hash"), get(item, "attachment_hash"),
                             F.when(text.looks_like_key(get(item, "id")), get(item, "id")), in_url)
    return text.normal_key(F.when(is_object(item), from_object).otherwise(as_text(item)))


def _custom_values(df: DataFrame) -> Column:
    """Custom field values as entries, from the list form, else the map form."""
    entry = "array<struct<key:string,value:string>>"
    listed = F.filter(
        F.transform(items("custom_fields"), lambda f: F.struct(
            get(f, "id").alias("key"), get(f, "value").alias("value"))), lambda e: e["key"].isNotNull())
    mapped = F.transform(
        F.map_entries(as_type("custom_field", "map<string,string>")),
        lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return F.coalesce(F.when(F.size(items("custom_fields")) > 0, listed), mapped, none_of(entry))


def parameter_shapes(m) -> Column:
    """Shared references where mapped, else the single or group shape with titles and values."""
    def values(p):
        v = F.try_variant_get(p, "$.values", "variant")
        return F.when(is_array(v), F.transform(items(v), as_text)).otherwise(F.array(as_text(v)))

    def named(list_of):
        kept = F.filter(list_of, lambda p: F.coalesce(
            F.nullif(get(p, "title"), F.lit("")), F.nullif(get(p, "name"), F.lit(""))).isNotNull()
            & shapes.truthy(F.try_variant_get(p, "$.values", "variant")))
        return F.transform(kept, lambda p: F.struct(
            F.coalesce(F.nullif(get(p, "title"), F.lit("")), get(p, "name")).alias("title"), values(p).alias("values")))

    def one(p):
        shared = target_of(m, "shared_parameter", get(p, "shared_id"))
        single = named(F.array(F.try_variant_get(p, "$.item", "variant")))
        group = named(items(F.try_variant_get(p, "$.items", "variant")))
        nothing = none_of("array<struct<title:string,values:array<string>>>")
        shape = (F.when(shared.isNotNull(), nothing).when(get(p, "type") == "single", single)
                 .when(get(p, "type") == "group", group).otherwise(nothing))
        return F.struct(shared.alias("shared_id"), get(p, "type").alias("type"), shape.alias("items"))

    return F.filter(F.transform(items("parameters"), one),
                    lambda p: p["shared_id"].isNotNull() | (F.size(p["items"]) > 0))


# Texts of a case, and what a member that is missing counts as.
CASE_TEXTS = ("description", "preconditions", "postconditions")
CASE_DEFAULTS = {"severity": 2, "priority": 2, "type": 1, "behavior": 1, "automation": 0, "status": 1, "is_flaky": 0}


def cases(
    rows: DataFrame, cw: DataFrame, ids: str = "preserve", new_workspace: str | None = None,
    default_user: int = 1, batch: int = 20,
) -> dict[str, DataFrame]:
    """Cases with every reference rewritten in one pass over the crosswalk, chunked for loading."""
    author = first_truthy("member_id", "created_by", "author_id")
    custom = _custom_values(rows)
    steps = items("steps")
    step_texts = F.flatten(F.transform(steps, lambda s: F.array(
        get(s, "action"), get(s, "expected_result"), get(s, "data"))))
    custom_texts = F.transform(custom, lambda e: e["value"])
    in_texts = F.flatten(F.transform(
        F.concat(F.array(*CASE_TEXTS), F.coalesce(step_texts, none_of("array<string>")), custom_texts),
        text.embedded_keys))
    listed = F.transform(items("attachments"), _case_attachment)
    in_steps = F.flatten(F.transform(steps, lambda s: F.transform(
        items(F.try_variant_get(s, "$.attachments", "variant")), lambda a: text.normal_key(as_text(a)))))
    refs = {
        "suite": F.array(F.col("suite_id").cast("string")),
        "milestone": F.array(F.col("milestone_id").cast("string")),
        "user": F.array(author.try_cast("bigint").cast("string")),
        "attachment": F.concat(in_texts, listed, in_steps),
        "custom_field": F.transform(custom, lambda e: e["key"]),
        "shared_step": F.transform(steps, _shared_ref),
        "shared_parameter": F.transform(items("parameters"), lambda p: get(p, "shared_id")),
    }
    # Chunks are numbered on the landed rows: every row is kept, and the references need not be
    # resolved a second time for the count.
    wide = chunk_index(rows, [SCOPE], ["id"], batch).withColumn("_author", author).withColumn("_custom", custom)
    resolved = resolve_refs(wide, cw, ROW, refs, SCOPE, workspace=("user", "custom_field", "shared_parameter"),
                            out="_m").withColumn("_texts", text_targets("_m", "attachment"))

    def rewritten(t):
        return text.rewrite_keys(t, F.col("_texts"), new_workspace)

    kept = F.filter(items("steps"), lambda s: _shared_ref(s).isNull()
                    | target_of("_m", "shared_step", _shared_ref(s)).isNotNull())

    def step(s, i):
        shared = target_of("_m", "shared_step", _shared_ref(s))
        plain = shared.isNull()
        hashes = F.transform(items(F.try_variant_get(s, "$.attachments", "variant")),
                             lambda a: text.normal_key(as_text(a)))
        return F.struct(
            shared.alias("shared"),
            F.when(plain, rewritten(F.coalesce(get(s, "action"), F.lit("")))).alias("action"),
            F.when(plain, rewritten(get(s, "expected_result"))).alias("expected_result"),
            F.when(plain, rewritten(get(s, "data"))).alias("data"),
            F.when(plain, F.coalesce(get(s, "position", "int"), i + 1)).alias("position"),
            F.when(plain, remap_list(hashes, "_m", "attachment")).alias("attachments"))

    custom_out = F.transform(
        remap_map_keys("_custom", "_m", "custom_field"),
        lambda e: F.struct(e["key"].alias("key"), rewritten(e["value"]).alias("value")))
    uid = F.col("_author").try_cast("bigint")
    out = resolved.select(
        SCOPE, F.col("id").alias("source_id"), enums.safe_id("id", ids).alias("id"),
        F.coalesce("title", F.lit("")).alias("title"),
        *[rewritten(F.coalesce(c, F.lit(""))).alias(c) for c in CASE_TEXTS],
        *[F.coalesce(c, F.lit(v)).alias(c) for c, v in CASE_DEFAULTS.items()],
        shapes.tag_titles("tags").alias("tags"),
        dates.iso_text("created_at").alias("created_at"), dates.iso_text("updated_at").alias("updated_at"),
        F.when(F.coalesce(uid, F.lit(0)) == 0, F.lit(default_user)).otherwise(
            F.coalesce(target_of("_m", "user", uid).try_cast("bigint"), F.lit(default_user))).alias("author_id"),
        target_of("_m", "milestone", F.col("milestone_id")).alias("milestone_id"),
        target_of("_m", "suite", F.col("suite_id")).alias("suite_id"),
        remap_list(F.transform(items("attachments"), _case_attachment), "_m", "attachment").alias("attachments"),
        custom_out.alias("custom_field"),
        F.coalesce(F.when(is_object("params"), as_type("params", "map<string,string>")),
                   none_of("map<string,string>")).alias("params"),
        parameter_shapes("_m").alias("parameters"),
        F.transform(kept, step).alias("steps"), "chunk", "pos",
        F.col("suite_id").alias("_suite"))
    unknown_suite = F.col("_suite").isNotNull() & F.col("suite_id").isNull()
    return {
        "payload": out.where("source_id is not null").drop("_suite"),
        "at_root": rejects(out, "case", SCOPE, "source_id", {"suite unknown, created at root": unknown_suite}),
        "rejects": rejects(rows, "case", SCOPE, "title", {"no id": F.col("id").isNull()}),
    }


def plans(rows: DataFrame, cw: DataFrame) -> dict[str, DataFrame]:
    """Plans with at least one mapped case; case lists as a link table."""
    new = resume(rows, cw, "plan", "id", SCOPE)
    fresh = new.where(has_all("id", "title"))
    links = fresh.select(SCOPE, F.col("id").alias("plan_id"), F.posexplode(
        shapes.linked_ids("cases", "case_id")).alias("pos", "case_id"))
    mapped = remap_links(links, cw, "case", "case_id", "target_case", SCOPE)
    keyed = mapped.select(SCOPE, F.col("plan_id").alias("id")).distinct()
    kept = fresh.join(keyed, ROW, "left_semi")
    dropped = fresh.join(keyed, ROW, "left_anti")
    return {
        "payload": kept.select(SCOPE, F.col("id").alias("source_id"), "title",
                               F.nullif(F.col("description"), F.lit("")).alias("description")),
        "links": mapped.select(SCOPE, "plan_id", "pos", "case_id", "target_case"),
        "rejects": rejects(dropped, "plan", SCOPE, "id", {"no mapped case": F.lit(True)}).unionByName(
            rejects(new, "plan", SCOPE, "id", {"no id or title": ~has_all("id", "title")})),
    }


def runs(
    rows: DataFrame, links: DataFrame, milestone_rows: DataFrame, cw: DataFrame, default_user: int = 1
) -> dict[str, DataFrame]:
    """Runs with author, times, milestone (by title, else id), environment and completion flag.

    ``links`` is (project_code, run_id, pos, case_id). The plan is not sent - the target would widen the
    run to the whole plan - but its mapped id stays in `mapped_plan_id`.
    """
    titles = titles_to_ids(milestone_rows, "title", "id", [SCOPE], ["id"]).withColumnRenamed("id", "_mid")
    work = rows.withColumn("_mtitle", F.when(is_object("milestone"), get("milestone", "title")))
    has_object = F.coalesce(is_object("milestone") & (as_text("milestone") != "{}"), F.lit(False))
    work = work.withColumn("_direct", F.when(~has_object, F.col("milestone_id")))
    work = lookup_by_title(work, titles, "_mtitle", [SCOPE], "_mid", "_direct", "_source_milestone")
    author = first_truthy("user_id", "created_by", "author_id", "member_id").try_cast("bigint")
    work = work.withColumn("_uid", author)
    plan = F.coalesce("plan_id", get("plan", "id", "bigint")) if "plan" in rows.columns else F.col("plan_id")
    work = work.withColumn("_plan", plan)
    refs = {
        "user": F.array(F.col("_uid").cast("string")),
        "milestone": F.array(F.col("_source_milestone").cast("string")),
        "plan": F.array(F.col("_plan").cast("string")),
        "environment": F.array(F.col("environment_id").cast("string")),
        "configuration": F.transform(shapes.linked_ids("configurations", "id", "configuration_id"),
                                     lambda k: k.cast("string")),
    }
    done = resolve_refs(work, cw, ROW, refs, SCOPE, workspace=("user",), out="_m")
    mapped = distinct_links(remap_links(links, cw, "case", "case_id", "target_case", SCOPE),
                            [SCOPE, "run_id"], "target_case", ["pos"])
    out = done.select(
        SCOPE, F.col("id").alias("source_id"), F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.when(F.coalesce("_uid", F.lit(0)) == 0, F.lit(default_user)).otherwise(
            F.coalesce(target_of("_m", "user", F.col("_uid")).try_cast("bigint"), F.lit(default_user))).alias("author_id"),
        dates.wall_clock("start_time").alias("start_time"), dates.wall_clock("end_time").alias("end_time"),
        remap_list(F.transform(shapes.linked_ids("configurations", "id", "configuration_id"),
                               lambda k: k.cast("string")), "_m", "configuration").alias("configurations"),
        target_of("_m", "milestone", F.col("_source_milestone")).alias("milestone_id"),
        target_of("_m", "environment", F.col("environment_id")).alias("environment_id"),
        target_of("_m", "plan", F.col("_plan")).alias("mapped_plan_id"),
        run_finished(done).alias("finished"))
    lost = links.join(cw.where("entity = 'case'").select(
        F.col("scope").alias(SCOPE), F.col("source_key").try_cast("bigint").alias("case_id")), [SCOPE, "case_id"], "left_anti")
    return {
        "payload": out, "links": mapped.select(SCOPE, "run_id", "pos", "case_id", "target_case"),
        "rejects": rejects(lost, "run_case", SCOPE, F.concat_ws(":", "run_id", "case_id"), {"case not mapped": F.lit(True)}),
    }


# Names of step lists, members a detail record wins, media lists, durations in milliseconds.
STEP_LISTS = ("steps", "step_results", "elements", "result_steps", "test_results", "substeps")
DETAIL_WINS = (
    "steps", "comment", "message", "stacktrace", "attachments", "status", "status_id", "time_spent_ms",
    "member_id", "author_uuid", "files", "screenshots", "media", "images", "params", "param", "param_groups",
    "parameters", "signature", "suite_title",
)
MEDIA = ("attachments", "files", "screenshots", "media", "images", "evidence", "artifacts")
RUN_MEDIA = ("attachments", "files", "screenshots", "media", "images")
MS_FIELDS = ("time_spent_ms", "time_ms", "duration_ms")


def _by_hash(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hash", F.coalesce("hash", "result_hash")) if "result_hash" in rows.columns else rows


def enrich_results(rows: DataFrame, details: DataFrame | None, case_rows: DataFrame) -> DataFrame:
    """Summary + detail + promoted execution + case metadata: one row per result, one join each.

    Adds `_steps` (variant), `_case_steps`, `_path` (suite titles) and flattened texts. A row's key is `hash`, or
    `result_hash` where that is all it has. Details and cases that were landed twice count once, so they multiply nothing.
    """
    out, details = _by_hash(rows), None if details is None else _by_hash(details)
    if details is not None:
        fill = tuple(c for c in details.columns if c not in DETAIL_WINS)
        out = ov.overlay(out, details, [SCOPE, "hash"], not_shorter=("steps",),
                         longer=("files", "screenshots", "media", "images"), fill_only=fill)
    ex = F.col("execution")

    def promoted(c, *aliases):
        own = F.when(F.trim(c) != "", F.col(c))
        return F.coalesce(own, *[F.when(shapes.nonempty(F.try_variant_get(ex, f"$.{a}", "variant")), get(ex, a))
                                 for a in aliases], F.col(c))

    def zero_or_blank(v):
        return F.coalesce(as_text(v).isin("", "0"), F.lit(True))

    ms = [F.try_variant_get(ex, f"$.{a}", "variant") for a in MS_FIELDS]
    ms_from_run = F.coalesce(*[F.when(as_text(m).isNotNull(), m) for m in ms],
                             get(ex, "duration").try_cast("double").cast("bigint").cast("variant"))
    out = (out.withColumn("time_spent_ms", F.when(zero_or_blank("time_spent_ms"), F.coalesce(ms_from_run, "time_spent_ms"))
                          .otherwise(F.col("time_spent_ms")))
           .withColumn("comment", promoted("comment", "comment"))
           .withColumn("message", promoted("message", "message"))
           .withColumn("stacktrace", promoted("stacktrace", "stacktrace", "stack_trace")))
    lists = [F.when(F.size(items(c)) > 0, F.col(c)) for c in STEP_LISTS]
    from_run = F.try_variant_get(ex, "$.steps", "variant")
    out = out.withColumn("_steps", F.coalesce(*lists, F.when(F.size(items(from_run)) > 0, from_run)))
    out = out.withColumn("_case_id", as_type("case_id", "bigint"))
    once = first_per_key(case_rows.where("id is not null"), ROW, orderable(case_rows, ROW) or ["id"])
    meta = once.select(
        F.col(SCOPE).alias("_case_scope"), F.col("id").alias("_found_id"), F.col("steps").alias("_case_steps"),
        text.suite_path("suite_title", "suite", "suites").alias("_case_path"))
    own_path = text.suite_path("suite_title", "suite", "suites")
    nested = [text.suite_path(get("case", "suite_title"), F.try_variant_get("case", "$.suite", "variant"),
                              F.try_variant_get("case", "$.suites", "variant"))]
    same = F.col(SCOPE).eqNullSafe(F.col("_case_scope")) & (F.col("_case_id") == F.col("_found_id"))
    return (out.join(meta, same, "left").withColumn("_path", F.coalesce("_case_path", own_path, *nested))
            .drop("_case_path", "_case_scope", "_found_id"))


def result_steps(enriched: DataFrame, cw: DataFrame, new_workspace: str | None = None) -> DataFrame:
    """Steps of results at every level, merged by position with the steps of their cases."""
    key = [SCOPE, "_hash"]
    enriched = stored(enriched.select(SCOPE, text.packed("hash").alias("_hash"), F.col("status_id").alias("_ps"), "_steps", "_case_steps"), "enriched")
    own = ov.explode_steps(enriched, key, "_steps")
    case_side = ov.explode_steps(enriched, [*key, "_ps"], "_case_steps")
    merged = ov.zip_steps(own, case_side.withColumnRenamed("_ps", "parent_status"), key)
    comment = text.step_comment("actual", "comment")
    with_text = merged.withColumn("comment", comment).withColumn("_pk", F.array_join(F.col("path").cast("array<string>"), "."))
    refs = {"attachment": F.concat(refs_in_text(["comment"]), text.media_keys("attachments"))}
    done = resolve_refs(stored(with_text, "steps"), cw, [*key, "_pk"], refs, SCOPE, out="_m")
    status = F.coalesce("status", "status_id")
    return done.select(
        SCOPE, text.unpacked("_hash").alias("hash"), "path", F.coalesce("action", F.lit(".")).alias("action"), "expected_result",
        text.rewrite_keys("comment", text_targets("_m", "attachment"), new_workspace).alias("comment"),
        enums.step_status(status).alias("status"), "duration",
        remap_list(text.media_keys("attachments"), "_m", "attachment", distinct=True).alias("attachments"), "origin")


def results(
    rows: DataFrame, details: DataFrame | None, case_rows: DataFrame, cw: DataFrame,
    new_workspace: str | None = None, default_user: int = 1, batch: int = 500, with_steps: bool = True,
) -> dict[str, DataFrame]:
    """Results ready to load, chunked per run, and their merged step table (`steps`, built when it is read).

    The crosswalk holds case, attachment, user and author (uuid -> source user id) entries. What a row says by itself is worked
    out once and written to the shared folder with a number for the row; references are resolved by that number.
    """
    enriched = enrich_results(chunk_index(_by_hash(rows), [SCOPE, "run_id"], ["hash"], batch), details, case_rows)
    have, ex = enriched.columns, F.col("execution")
    media = text.media_keys(*MEDIA, *[F.try_variant_get(ex, f"$.{m}", "variant") for m in RUN_MEDIA])
    message = text.join_message("comment", "message", "text")
    params = shapes.first_params("params", "param", "parameters", *[
        F.try_variant_get(o, f"$.{p}", "variant") for o in ("execution", "case") for p in ("params", "param", "parameters")])
    groups = F.coalesce("param_groups", *[F.try_variant_get(o, "$.param_groups", "variant") for o in ("execution", "case")])
    chosen = F.coalesce(*[as_text(c).try_cast("bigint") for c in ("member_id", "author_id", "user_id", "created_by")])
    work = lookup(enriched.withColumn("_message", message), cw, "author", "author_uuid", "_author")
    work = work.select(
        SCOPE, "run_id", "hash", "_case_id", "_message", "stacktrace", "signature", "defect", "chunk", "pos",
        media.alias("_media"), refs_in_text(["_message", "stacktrace"]).alias("_in_texts"), params.alias("_params"),
        shapes.param_groups(groups).alias("_groups"), F.coalesce(F.col("_author").try_cast("bigint"), chosen).alias("_uid"),
        text.own_title(
            [c for c in ("title", "case_title", "caseTitle", "name") if c in have],
            F.coalesce(*[F.when(is_object(c), F.col(c)) for c in ("case", "test_case", "TestCase") if c in have]),
            F.coalesce(*[F.nullif(as_text(c), F.lit("")) for c in ("case_id", "CaseId", "test_case_id") if c in have]), "id").alias("_title"),
        enums.run_execution_status(enums.result_status("status_id", "status")).alias("_status"),
        enums.duration_ms([as_type(c, "bigint") for c in MS_FIELDS],
                          [as_type(c, "bigint") for c in ("time", "duration")]).alias("duration_ms"),
        *[(dates.wall_clock(c) if c in have else F.lit(None).cast("string")).alias(c) for c in ("start_time", "end_time")],
        text.short_titles("_path").alias("suite_path"), as_text("case_id").alias("_case_text"),
        F.when(F.col("hash").isNotNull(), F.monotonically_increasing_id()).alias("_row"))
    work = stored(work, "results")
    refs = {
        "case": F.array(F.col("_case_id").cast("string")),
        "user": F.array(F.col("_uid").cast("string")),
        "attachment": F.concat("_media", "_in_texts"),
    }
    done = resolve_refs(work, cw, ["_row"], refs, SCOPE, workspace=("user",), out="_m")
    m = text_targets("_m", "attachment")
    done = done.withColumn("target_case_id", target_of("_m", "case", F.col("_case_id")).try_cast("bigint"))
    row_id, signature = text.row_identity("hash", "signature", "target_case_id", F.col("_params"))
    author = F.when(F.coalesce("_uid", F.lit(0)) == 0, F.lit(default_user)).otherwise(
        F.coalesce(target_of("_m", "user", F.col("_uid")).try_cast("bigint"), F.lit(default_user)))
    stack = text.rewrite_keys("stacktrace", m, new_workspace)
    out = done.select(
        SCOPE, "run_id", "hash", "target_case_id",
        text.titled("_title", "target_case_id", "hash").alias("title"),
        F.col("_status").alias("status"), "duration_ms",
        F.when(F.trim(stack) != "", stack).alias("stacktrace"),
        text.rewrite_keys("_message", m, new_workspace).alias("message"),
        remap_list("_media", "_m", "attachment", distinct=True).alias("attachments"),
        F.col("_params").alias("params"), F.col("_groups").alias("param_groups"),
        row_id.alias("id"), signature.alias("signature"), F.col("defect"), "start_time", "end_time", "suite_path",
        F.when(F.col("target_case_id").isNull(), text.standalone_description("_case_text", "hash")).alias("description"),
        F.when(F.col("target_case_id").isNull(), author.cast("string")).alias("author"), "chunk", "pos")
    return Members({
        "payload": out,
        **({"steps": lambda: result_steps(enriched, cw, new_workspace)} if with_steps else {}),
        "rejects": rejects(out, "result_case", SCOPE, "hash", {"case not mapped": F.col("target_case_id").isNull()}),
    })


def defects(rows: DataFrame, cw: DataFrame, new_workspace: str | None = None, default_user: int = 1) -> dict[str, DataFrame]:
    """Defects with severity code, author, milestone, attachments, rewritten text and resolve flag."""
    uid = first_truthy("author_id", "member_id").try_cast("bigint")
    listed = F.transform(items("attachments"), _case_attachment)
    work = rows.where(has_all("id")).withColumn("_uid", uid).withColumn("_mid", as_type("milestone_id", "bigint"))
    refs = {
        "user": F.array(F.col("_uid").cast("string")),
        "milestone": F.array(F.col("_mid").cast("string")),
        "attachment": F.concat(refs_in_text(["actual_result"]), listed),
    }
    done = resolve_refs(work, cw, ROW, refs, SCOPE, workspace=("user",), out="_m")
    return {
        "payload": done.select(
            SCOPE, F.col("id").alias("source_id"), F.coalesce("title", F.lit("")).alias("title"),
            text.rewrite_keys(F.coalesce("actual_result", F.lit("")), text_targets("_m", "attachment"), new_workspace).alias("actual_result"),
            enums.severity_code("severity").alias("severity"),
            F.when(F.coalesce("_uid", F.lit(0)) == 0, F.lit(default_user)).otherwise(
                F.coalesce(target_of("_m", "user", F.col("_uid")).try_cast("bigint"), F.lit(default_user))).alias("author_id"),
            target_of("_m", "milestone", F.col("_mid")).alias("milestone_id"),
            remap_list(F.transform(items("attachments"), _case_attachment), "_m", "attachment").alias("attachments"),
            defect_resolved("status").alias("resolve")),
        "rejects": rejects(rows, "defect", SCOPE, "title", {"no id": ~has_all("id")}),
    }
