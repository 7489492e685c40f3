"""Workspace entities: projects, users, groups, custom fields, shared parameters, attachments.

Every plan takes DataFrames and returns a dict of DataFrames: what to send (`payload`), what is already
known (`crosswalk`), what was dropped and why (`rejects`), and plan-specific tables. Target keys come
from the target side; none is invented.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.enums import field_entity_code, field_type_code, numeric_text
from ..functions.predicates import allow, deny
from ..functions.shapes import as_text, clean_parameters, get, is_object, items
from ..functions.text import split_name
from ..lineage import cut
from ..operators import harvest
from ..operators.audit import rejects
from ..operators.batching import uniquify, upload_plan
from ..operators.crosswalk import match_or_create, natural_key, pairs, resume
from ..operators.links import fan_out, first_owner, remap_links
from ..operators.ranking import first_wins


def projects(source: DataFrame, target: DataFrame, only=(), skip=()) -> dict[str, DataFrame]:
    """Allow- and deny-listed projects matched by exact code. Skipped projects are not created."""
    wanted = deny(allow(source, "code", only), "code", skip)
    rows = match_or_create(first_wins(wanted, "code", ["id"]), target, "code",
                           F.nullif(F.col("code"), F.lit("")), F.col("code"), "code", ["id"], ["id"])
    code = F.coalesce("target_key", "created_from")
    return {
        "payload": rows.where("outcome = 'to_create'").select("code", "title", "description", "access"),
        "projects": rows.where("outcome <> 'invalid'").select(
            F.col("code").alias("source_code"), code.alias("target_code"), "outcome"),
        "crosswalk": pairs(rows.where("outcome <> 'invalid'").withColumn("_t", code), "project", "code", "_t"),
        "rejects": rejects(rows, "project", F.lit("*"), "id", {"no code": F.col("outcome") == "invalid"}),
    }


def users(
    source: DataFrame, target: DataFrame, create: bool = True, create_inactive: bool = False, default: int = 1
) -> dict[str, DataFrame]:
    """Users matched by lower-case email. `outcome`: matched, to_create, reuse_new, defaulted, invalid.

    The first user of an email that may be created is; later users of it, inactive ones too, reuse that one, and
    earlier ones that may not be created take the default user."""
    active = F.coalesce("is_active", F.lit(True))
    may_create = F.lit(create) & (active | F.lit(create_inactive))
    rows = match_or_create(source, target, "id", F.nullif(F.lower("email"), F.lit("")),
                           F.nullif(F.lower("email"), F.lit("")), "id", ["id"], ["id"], eligible=may_create)
    rows = rows.withColumn("outcome", F.when(F.col("outcome") == "ineligible", "defaulted").otherwise(F.col("outcome")))
    target_id = (F.when(F.col("outcome") == "matched", numeric_text("target_key"))
                 .when(F.col("outcome") == "defaulted", F.lit(str(default))))
    rows = rows.withColumn("target_key", target_id)
    first, last = split_name("name", F.lower("email"))
    mapped = rows.where("target_key is not null")
    uuid = F.coalesce(F.nullif(F.col("uuid"), F.lit("")), F.nullif(F.col("author_uuid"), F.lit("")))
    return {
        "rows": rows,
        "payload": rows.where("outcome = 'to_create'").select(
            F.col("id").alias("source_id"), F.lower("email").alias("email"), first.alias("first_name"),
            last.alias("last_name"), F.coalesce(F.nullif(F.col("role"), F.lit("")), F.lit("Member")).alias("role"),
            active.alias("is_active")),
        "crosswalk": pairs(mapped, "user", "id", "target_key"),
        "uuid_crosswalk": pairs(mapped.where("outcome = 'matched'").withColumn("_u", uuid).where("_u is not null"),
                                "user_uuid", "_u", "target_key"),
        "by_email": mapped.groupBy(F.lower("email").alias("email")).agg(F.max_by("target_key", "id").alias("target_key")),
        "counts": rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")),
        "rejects": rejects(rows, "user", F.lit("*"), "id", {"no id or email": F.col("outcome") == "invalid"}),
    }


def groups(source: DataFrame, target: DataFrame, user_cw: DataFrame) -> dict[str, DataFrame]:
    """Groups matched by lower-case name (not trimmed); memberships as a link table."""
    rows = match_or_create(source, target, "id", natural_key("displayName", trim=False),
                           natural_key("displayName", trim=False), "id", ["id"], ["id"])
    links = rows.where("outcome <> 'invalid'").select(
        F.col("id").alias("group_id"), F.coalesce("target_key", F.concat(F.lit("new:"), "created_from")).alias("target_group"),
        F.posexplode("members").alias("pos", "member"))
    whole = links.withColumn("member", F.col("member").try_cast("bigint").cast("string")).where("member is not null")
    return {
        "rows": rows,
        "payload": rows.where("outcome = 'to_create'").select(F.col("id").alias("source_id"), "displayName"),
        "members": remap_links(whole, user_cw, "user", "member", "target_user"),
        "crosswalk": pairs(rows.where("outcome = 'matched'"), "group", "id", "target_key"),
        "rejects": rejects(rows, "group", F.lit("*"), "id", {"no id or name": F.col("outcome") == "invalid"}),
    }


def custom_fields(source: DataFrame, target: DataFrame) -> dict[str, DataFrame]:
    """Fields matched by trimmed lower-case title; codes for entity and type; option labels made unique."""
    rows = match_or_create(source, target, "id", natural_key("title"), natural_key("title"), "id", ["id"], ["id"])

    def label(v):
        titled = F.coalesce(F.nullif(get(v, "title"), F.lit("")), get(v, "value"), F.lit(""))
        return F.when(is_object(v), titled).otherwise(as_text(v))

    for_all = F.coalesce("is_enabled_for_all_projects", F.lit(False))
    options = uniquify(F.transform(items("value"), label))
    return {
        "rows": rows,
        "payload": rows.where("outcome = 'to_create'").select(
            F.col("id").alias("source_id"), "title", field_entity_code("entity").alias("entity"),
            field_type_code("type").alias("type"),
            F.transform(options, lambda t, i: F.struct((i + 1).alias("id"), t.alias("title"))).alias("value"),
            F.coalesce("is_filterable", F.lit(True)).alias("is_filterable"),
            F.coalesce("is_visible", F.lit(True)).alias("is_visible"),
            F.coalesce("is_required", F.lit(False)).alias("is_required"),
            for_all.alias("is_enabled_for_all_projects"),
            F.when(~for_all, F.col("projects_codes")).alias("projects_codes"), "default_value"),
        "crosswalk": pairs(rows.where("outcome = 'matched'"), "custom_field", "id", "target_key"),
        "rejects": rejects(rows, "custom_field", F.lit("*"), "id", {"no title": F.col("outcome") == "invalid"}),
    }


def shared_parameters(source: DataFrame, target: DataFrame, cw: DataFrame) -> dict[str, DataFrame]:
    """Parameters not yet mapped, matched by title; only items with a title and values are sent."""
    open_rows = resume(source, cw, "shared_parameter", "id")
    cleaned = open_rows.withColumn("clean", clean_parameters("parameters"))
    rows = match_or_create(cleaned, target, "id", natural_key("title"), natural_key("title"), "id", ["id"], ["id"],
                           eligible=F.size("clean") > 0)
    for_all = F.coalesce("is_enabled_for_all_projects", F.lit(False))
    return {
        "rows": rows,
        "payload": rows.where("outcome = 'to_create'").select(
            F.col("id").alias("source_id"), "title", "type", for_all.alias("is_enabled_for_all_projects"),
            F.col("clean").alias("parameters"),
            F.when(~for_all & (F.size("project_codes") > 0), F.col("project_codes")).alias("project_codes")),
        "crosswalk": pairs(rows.where("outcome = 'matched'"), "shared_parameter", "id", "target_key"),
        "rejects": rejects(rows, "shared_parameter", F.lit("*"), "id", {
            "no id or title": F.col("outcome") == "invalid", "no usable values": F.col("outcome") == "ineligible"}),
    }


def attachments(
    refs: DataFrame, target_refs: DataFrame, cw: DataFrame, project_order: DataFrame, sizes: DataFrame, **caps
) -> dict[str, DataFrame]:
    """Harvested refs -> what to move, who owns it, in which upload batch, and each project's map.

    ``project_order`` has scope, ordinal and target_code; ``sizes`` has key and n_bytes. Keys to move that no listed
    scope refers to, and keys of unknown size, are rejected: without an owner there is no queue, and without a size no
    batch could keep its cap. payload + rejects = the keys labelled `to_transfer`.
    """
    # Harvesting reads every text, so its small result is written once and used five times.
    found = cut(harvest.keys_with_urls(refs))
    per_scope = found.select("scope", "key")
    keys = per_scope.select("key").distinct()
    mapped = cw.where("entity = 'attachment'").select("source_key", "target_key")
    split = harvest.transfer_split(keys, mapped, target_refs.select("key"))
    owned = first_owner(per_scope.join(project_order, "scope"), "key", "scope", "ordinal").join(
        project_order.select(F.col("scope").alias("owner"), "target_code"), "owner")
    known_size = sizes.groupBy("key").agg(F.max("n_bytes").alias("n_bytes"))
    wanted = cut(split.where("label = 'to_transfer'").select("key").join(owned, "key", "left").join(known_size, "key", "left"))
    to_move = wanted.where("target_code is not null and n_bytes is not null").join(harvest.latest_url(found), "key", "left")
    known = split.where("target_key is not null").select("key", "target_key")
    fanned = fan_out(per_scope, known, "scope", "key")
    counts = per_scope.groupBy("scope").agg(F.count(F.lit(1)).alias("n_keys"))
    return {
        "split": split,
        "payload": upload_plan(to_move, "target_code", ["key"], "n_bytes", **caps),
        "crosswalk": pairs(fanned, "attachment", "key", "target_key", scope="scope"),
        "counts": counts,
        "rejects": rejects(wanted, "attachment", F.coalesce("owner", F.lit("*")), "key", {
            "no listed project": F.col("target_code").isNull(), "size unknown": F.col("n_bytes").isNull()}),
    }
