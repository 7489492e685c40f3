"""Saved crosswalks, trace logs and what already exists at the target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.crosswalk import from_buckets, natural_key
from ..operators.harvest import all_refs
from ..operators.ranking import last_per_key
from ..schemas import TRACE, WORKSPACE
from ..sinks import store


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version of a crosswalk written by `sinks.tables`."""
    return store.read(spark, path)


def bucket_rows(df: DataFrame, body: str, workspace: tuple[str, ...] = ("users",)) -> DataFrame:
    """JSON bucket file -> crosswalk rows.

    Project buckets are {name: {project: {src: tgt}}}, workspace buckets {name: {src: tgt}}. Keys stay
    text, so a reload finds every key that was saved.
    """
    per_name = df.select(F.explode(F.from_json(body, "map<string,variant>")).alias("entity", "_v"))
    flat = per_name.where(F.col("entity").isin(*workspace)).select(
        "entity", F.lit(WORKSPACE).alias("scope"),
        F.try_variant_get("_v", "$", "map<string,string>").alias("entries"))
    nested = per_name.where(~F.col("entity").isin(*workspace)).select(
        "entity", F.explode(F.try_variant_get("_v", "$", "map<string,variant>")).alias("scope", "_m")).select(
        "entity", "scope", F.try_variant_get("_m", "$", "map<string,string>").alias("entries"))
    return from_buckets(flat.unionByName(nested))


def read_buckets(spark: SparkSession, path: str, workspace: tuple[str, ...] = ("users",)) -> DataFrame:
    return bucket_rows(spark.read.text(path, wholetext=True), "value", workspace)


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRACE).json(path)


def existing_rows(target: DataFrame, key, row_id: str, trim: bool = True, order: list[str] | None = None) -> DataFrame:
    """Target rows by normalised natural key, a later row replacing an earlier one."""
    keyed = target.withColumn("natural_key", natural_key(key, trim)).where("natural_key is not null")
    return last_per_key(keyed, ["natural_key"], order or [row_id]).select(
        "natural_key", F.col(row_id).cast("string").alias("target_key"))


def existing_keys(*refs: DataFrame) -> DataFrame:
    """Attachment keys referenced by any entity at the target."""
    return all_refs(*refs).select("key").distinct()
