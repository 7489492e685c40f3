"""Collecting attachment keys from entities, as rows (scope, key, url, source_rank, seq)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.shapes import as_text, get, is_object, is_text, items, none_of
from ..functions.text import embedded_keys, embedded_urls, media_refs, normal_key

REF = "struct<key:string,url:string>"
NO_REFS = f"array<{REF}>"


def text_refs(text) -> Column:
    """array<struct<key,url>> of one text: every key, and the URL of those inside image links."""
    keys = F.transform(embedded_keys(text), lambda k: F.struct(k.alias("key"), F.lit(None).cast("string").alias("url")))
    return F.concat(keys, embedded_urls(text))


def value_refs(v) -> Column:
    """Refs of a field that is text, an object with `value`, or a list of either."""
    def texts(x):
        return F.when(is_object(x), F.when(is_text(F.try_variant_get(x, "$.value", "variant")), get(x, "value"))
                      ).when(is_text(x), as_text(x))

    listed = F.transform(items(v), texts)
    every = F.when(F.size(listed) > 0, listed).otherwise(F.array(texts(v)))
    return F.flatten(F.transform(every, text_refs))


def harvest_refs(df: DataFrame, scope: str, refs: list[Column], source_rank: int, order: str) -> DataFrame:
    """Explode a row's refs. ``refs`` are array<struct<key,url>> columns."""
    every = F.flatten(F.array(*[F.coalesce(r, none_of(NO_REFS)) for r in refs]))
    return (df.select(F.col(scope).alias("scope"), F.col(order).cast("string").alias("row_id"),
                      F.posexplode(every).alias("pos", "_r"))
            .select("scope", "row_id", "pos", F.col("_r.key").alias("key"), F.col("_r.url").alias("url"),
                    F.lit(source_rank).alias("source_rank"))
            .where("key is not null"))


def _nested(lists: Column, name: str) -> Column:
    return F.try_variant_get(lists, f"$.{name}", "variant")


MEDIA = ("attachments", "files", "screenshots", "media", "images", "evidence", "artifacts")
RUN_MEDIA = ("attachments", "files", "screenshots", "media", "images")


def object_media(*objects: Column) -> Column:
    """Media refs of some objects and of their `execution`."""
    return media_refs(*[_nested(v, m) for v in objects for m in MEDIA],
                      *[_nested(v, f"execution.{m}") for v in objects for m in RUN_MEDIA])


def texts_refs(texts: list[Column]) -> Column:
    """Refs of several texts."""
    return F.flatten(F.transform(F.array(*texts), text_refs))


def case_refs(cases: DataFrame) -> DataFrame:
    """Refs of cases: attachments, texts, custom fields, steps."""
    def step(s):
        return F.concat(media_refs(_nested(s, "attachments")),
                        texts_refs([get(s, t) for t in ("action", "expected_result")]), value_refs(_nested(s, "data")))

    return harvest_refs(cases, "project_code", [
        media_refs("attachments"), texts_refs([F.col(c) for c in ("description", "preconditions", "postconditions")]),
        value_refs("custom_fields"),
        F.flatten(F.transform(items("steps"), step)),
    ], 0, "id")


def result_refs(results: DataFrame) -> DataFrame:
    """Refs of results: media lists here, under execution, in steps, in a step's data and execution."""
    def step(s):
        texts = ("action", "expected_result", "comment", "message", "text", "actual_result",
                 "execution.comment", "execution.message")
        return F.concat(object_media(s, _nested(s, "data")), texts_refs([get(s, t) for t in texts]))

    own = [m for m in MEDIA if m in results.columns]
    return harvest_refs(results, "project_code", [
        media_refs(*own, *[_nested(F.col("execution"), m) for m in RUN_MEDIA]),
        texts_refs([*[F.col(c) for c in ("comment", "message", "text", "stacktrace")],
                    *[get("execution", c) for c in ("comment", "message", "stacktrace")]]),
        F.flatten(F.transform(items("steps"), step)),
    ], 1, "hash")


def defect_refs(defects: DataFrame) -> DataFrame:
    """Refs of defects: attachments and the actual result."""
    return harvest_refs(defects, "project_code", [media_refs("attachments"), text_refs("actual_result")], 2, "id")


def all_refs(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def keys_by_scope(refs: DataFrame) -> DataFrame:
    """Distinct (scope, key)."""
    return refs.select("scope", "key").distinct()


def keys_with_urls(refs: DataFrame) -> DataFrame:
    """One row per (scope, key) with its last URL and that URL's rank among sources."""
    order = F.when(F.col("url").isNotNull(), F.struct("source_rank", "row_id", "pos"))
    return refs.groupBy("scope", "key").agg(F.max_by("url", order).alias("url"), F.max(order).alias("url_order"))


def latest_url(found: DataFrame) -> DataFrame:
    """One URL per key over all scopes, from `keys_with_urls`."""
    return found.where("url is not null").groupBy("key").agg(F.max_by("url", "url_order").alias("url"))


def url_per_key(refs: DataFrame, by: list[str] = ("key",)) -> DataFrame:
    """One URL per key: the last source with one wins, and the last URL in it."""
    order = F.struct("source_rank", "row_id", "pos")
    return refs.where("url is not null").groupBy(*by).agg(F.max_by("url", order).alias("url"))


def transfer_split(keys: DataFrame, mapped: DataFrame, existing: DataFrame) -> DataFrame:
    """Label each key: already_mapped (its target kept), at_target (maps to itself) or to_transfer."""
    m = mapped.select(normal_key("source_key").alias("key"), "target_key").groupBy("key").agg(
        F.max("target_key").alias("_mapped"))
    e = existing.select(normal_key("key").alias("key")).distinct().withColumn("_exists", F.lit(True))
    joined = keys.join(m, "key", "left").join(e, "key", "left")
    label = (F.when(F.col("_mapped").isNotNull(), "already_mapped").when(F.col("_exists"), "at_target")
             .otherwise("to_transfer"))
    target = F.coalesce("_mapped", F.when(F.col("_exists"), F.col("key")))
    return joined.select(*keys.columns, label.alias("label"), target.alias("target_key"))
