"""Landed response pages: `{status, result: {total, entities: [...]}}`, one JSON document per page.

`result` may also be a bare list. A page with a false status or no entities yields no rows. Paging is
already done by whoever landed the files; what is left is reading all of them, and the completeness
audit that says whether all of them are there, and `page_rejects`, which lists the pages that could not be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import ENTITIES, KEYS, struct_of
from ..operators.audit import page_completeness
from ..operators.coverage import gaps, overlaps, same_group
from ..operators.ranking import first_per_key, orderable


def open_pages(pages: DataFrame, ddl: str, keep: list[str] = ()) -> DataFrame:
    """(keep..., entities, total) of each page. The bare-list reading is tried only on pages that have
    no entities under the usual name. The body is parsed in a step of its own, once per page."""
    row = struct_of(ddl)
    usual = F.from_json("body", f"status boolean, result struct<total:bigint, entities:array<{row}>>")
    bare = F.from_json("body", f"status boolean, result array<{row}>")
    parsed = pages.select(*keep, "body", usual.alias("_e"))
    ok = F.col("_e.status")
    rows = F.when(ok, F.coalesce(F.col("_e.result.entities"), bare["result"]))
    return parsed.select(*keep, rows.alias("entities"), F.when(ok, F.col("_e.result.total")).alias("total"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page files under `entity=.../project_code=.../` (or any layout) as (body, folder columns).

    Partition folders prune the read; one file holds one page, or one page per line.
    """
    return spark.read.text(path).withColumnRenamed("value", "body")


def entity_rows(pages: DataFrame, entity: str, scope: str = "project_code", dedupe: bool = True) -> DataFrame:
    """Pages of one entity -> its rows, with the scope column first.

    Pages fetched while the source changed may overlap, so a key's row is taken once: from the page fetched last where
    pages say when (`fetched_at`), then from the one of the smallest offset. Rows without a key are all kept, for plans to
    reject them with a reason. ``dedupe=False`` keeps every landed row.
    """
    mine = pages.where(F.col("entity") == entity) if "entity" in pages.columns else pages
    keep = [c for c in (scope, "page_offset", "fetched_at") if c in pages.columns]
    out = open_pages(mine, ENTITIES[entity], keep).select(*keep, F.inline("entities"))
    if dedupe:
        key = KEYS[entity]
        keys = [c for c in (scope,) if c in keep] + [key]
        latest = [F.desc_nulls_last("fetched_at")] if "fetched_at" in keep else []
        order = latest + [c for c in ("page_offset",) if c in keep] + orderable(out, [*keys, "page_offset", "fetched_at"])
        # Rows without a key are spread by a number of their own, as their partition would hold them all.
        lone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
        out = first_per_key(out.withColumn("_lone", lone), [*keys, "_lone"], order or [key]).drop("_lone")
    return out.drop("page_offset", "fetched_at")


def _status(pages: DataFrame, scope: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(entity, scope, keep..., rows as texts, total, bad): a page is bad if it can't be parsed or its status isn't true."""
    parsed = pages.select(
        "entity", scope, *keep, "body", F.from_json("body", "status boolean, result struct<total:bigint, entities:array<string>>").alias("_e"),
        F.from_json("body", "result array<string>").alias("_b"))
    ok = F.coalesce(F.col("_e.status"), F.lit(False))
    return parsed.select("entity", scope, *keep, "body", F.when(ok, F.coalesce("_e.result.entities", "_b.result")).alias("rows"),
                         F.when(ok, F.col("_e.result.total")).alias("total"), (~ok).alias("bad"))


def page_rejects(pages: DataFrame, scope: str = "project_code") -> DataFrame:
    """Pages that yield no rows because they can't be read or report failure."""
    bad = _status(pages, scope).where("bad")
    unread = F.coalesce(F.try_parse_json("body").isNull(), F.lit(True))
    return bad.select("entity", F.col(scope).alias("scope"), F.md5("body").alias("source_key"),
                      F.when(unread, "page not parsable").otherwise("page reports failure").alias("reason"))


def audit_pages(pages: DataFrame, scope: str = "project_code", expected: DataFrame | None = None) -> DataFrame:
    """Landed rows against declared totals, per entity and scope. Only keys are parsed; repeated rows count once."""
    read = _status(pages, scope)
    name = F.create_map(*[F.lit(x) for e, k in sorted(KEYS.items()) for x in (e, f"$.{k}")])
    path = F.coalesce(F.try_element_at(name, F.col("entity")), F.lit("$.id"))
    keys = read.select("entity", scope, F.explode("rows").alias("row")).select(
        "entity", scope, F.call_function("get_json_object", F.col("row"), path).alias("key"))
    return page_completeness(read, keys, ["entity", scope], expected)


def page_coverage(pages: DataFrame, scope: str = "project_code", limit: int = 100) -> dict[str, DataFrame]:
    """What the landed pages of each (entity, scope) cover of the rows the source declares.

    A page at `page_offset` with n rows covers n rows from there. Of several fetches of an offset the last readable one counts
    (`fetched_at`, where pages have it); the total is the one declared last. Returns

    - `refetch`: (entity, scope, page_offset, n, reason) requests of at most ``limit`` rows for all that is not covered; the reason
      is `unreadable` where a page landed at that offset but none could be read, else `never fetched`;
    - `overlaps`: (entity, scope, start, end) rows that a page delivers once more;
    - `summary`: (entity, scope, declared, n_missing, n_repeated, n_pages, complete).

    A scope whose pages are all unreadable declares nothing: its offsets are requested anew. Pages without an offset can't be
    placed and are left to `audit_pages`.
    """
    keep = tuple(c for c in ("page_offset", "fetched_at") if c in pages.columns)
    read = _status(pages.where("page_offset is not null"), scope, keep).select(
        "entity", F.col(scope).alias("scope"), F.col("page_offset").cast("bigint").alias("start"), F.coalesce(F.size("rows"), F.lit(0)).cast("bigint").alias("n"),
        "total", "bad", F.xxhash64("body").alias("_hash"), *[F.col(c).alias("_at") for c in keep if c == "fetched_at"])
    at = [F.desc_nulls_last("_at")] if "fetched_at" in keep else []
    group = ["entity", "scope"]
    chosen = first_per_key(read, [*group, "start"], ["bad", *at, F.desc("n"), "_hash"])
    latest = F.max_by("total", F.struct("_at", "total")) if at else F.max("total")
    totals = read.where("not bad").groupBy(*group).agg(latest.alias("total"))
    spans = chosen.where("n > 0 and not bad").select(*group, "start", (F.col("start") + F.col("n")).alias("end"))
    missing = gaps(spans, totals.where("total is not null"), group)
    repeated = overlaps(spans, group)
    offsets = F.explode(F.sequence("start", F.col("end") - 1, F.lit(limit).cast("bigint")))
    wanted = missing.select(*group, "end", offsets.alias("page_offset"))
    wanted = wanted.select(*group, "page_offset", F.least(F.lit(limit), F.col("end") - F.col("page_offset")).alias("n"))
    unread = chosen.where("bad").select(F.col("entity").alias("_entity"), F.col("scope").alias("_scope"), F.col("start").alias("_start"))
    mixed = wanted.join(unread, same_group(group) & (F.col("page_offset") == F.col("_start")), "left")
    known = totals.select(F.col("entity").alias("_entity"), F.col("scope").alias("_scope"))
    silent = chosen.where("bad").join(known, same_group(group), "left_anti").select(
        *group, F.col("start").alias("page_offset"), F.lit(limit).cast("bigint").alias("n"), F.lit("unreadable").alias("reason"))
    refetch = mixed.select(*group, "page_offset", F.col("n").cast("bigint").alias("n"),
                           F.when(F.col("_start").isNotNull(), "unreadable").otherwise("never fetched").alias("reason")).unionByName(silent)
    parts = (chosen.select(*group, F.lit("page").alias("_kind"), F.lit(1).cast("bigint").alias("_n"))
             .unionByName(totals.select(*group, F.lit("total").alias("_kind"), F.col("total").alias("_n")))
             .unionByName(refetch.select(*group, F.lit("gap").alias("_kind"), F.col("n").alias("_n")))
             .unionByName(repeated.select(*group, F.lit("again").alias("_kind"), (F.col("end") - F.col("start")).alias("_n"))))

    def summed(kind):
        return F.coalesce(F.sum(F.when(F.col("_kind") == kind, F.col("_n"))), F.lit(0))

    summary = parts.groupBy(*group).agg(
        F.max(F.when(F.col("_kind") == "total", F.col("_n"))).alias("declared"), summed("gap").alias("n_missing"),
        summed("again").alias("n_repeated"), summed("page").alias("n_pages"))
    whole = F.col("declared").isNotNull() & (F.col("n_missing") == 0)
    return {"refetch": refetch, "overlaps": repeated, "summary": summary.withColumn("complete", whole)}


def land(df: DataFrame, entity: str, page: Column, columns: list, scope: str = "project_code") -> DataFrame:
    """Rows -> page bodies, the inverse of `entity_rows`: for tests and for handing pages on.

    ``page`` numbers the pages; it must hold a bounded number of rows per page.
    """
    packed = df.withColumn("page_offset", page).groupBy(scope, "page_offset").agg(
        F.collect_list(F.struct(*columns)).alias("entities"))
    totals = df.groupBy(scope).agg(F.count(F.lit(1)).alias("total"))
    return packed.join(totals, scope).select(
        F.lit(entity).alias("entity"), scope, "page_offset",
        F.to_json(F.struct(F.lit(True).alias("status"),
                           F.struct("total", "entities").alias("result"))).alias("body"))
