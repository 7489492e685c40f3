"""Registry of runnable queries, and how the given tables stand in for landed entities.

Stand-ins: project = order priority, part brand or nation; user = customer; case = part; run = order;
result = line item; trace = events; text with embedded keys = documents with URLs made from their ids.
Target sides keep the rows that satisfy an attribute test (say, a non-negative balance), so some keys
are unmapped, as after a partial move.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import WORKSPACE, fields

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def page_per_row(df: DataFrame, entity: str, scope: Column | str | None, /, **members) -> DataFrame:
    """Land each row as a response page of its own."""
    scope = F.lit(WORKSPACE) if scope is None else (F.col(scope) if isinstance(scope, str) else scope)
    row = F.struct(*[(F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in members.items()])
    body = F.to_json(F.struct(F.lit(True).alias("status"), F.struct(
        F.lit(1).alias("total"), F.array(row).alias("entities")).alias("result")))
    return df.select(F.lit(entity).alias("entity"), scope.alias("project_code"), body.alias("body"))


def entity_of(df: DataFrame, entity: str, scope: Column | str | None, /, **members) -> DataFrame:
    """Rows with the declared columns of a landed entity; members not given are null."""
    scope = F.lit(WORKSPACE) if scope is None else (F.col(scope) if isinstance(scope, str) else scope)
    given = df.select("*", *[(F.expr(v) if isinstance(v, str) else v).alias(f"_m_{k}") for k, v in members.items()])
    types = dict(given.dtypes)

    def column(name, kind):
        if name not in members:
            return F.lit(None).cast(kind).alias(name)
        have = types[f"_m_{name}"]
        nested = kind == "variant" and have.startswith(("array", "struct", "map"))
        made = F.to_variant_object(f"_m_{name}") if nested else F.col(f"_m_{name}").cast(kind)
        return made.alias(name)

    return given.select(scope.alias("project_code"), *[column(n, k) for n, k in fields(entity)])


def crosswalk_of(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def xw(df: DataFrame, entity: str, source: str, target: str, scope: str | None = None) -> DataFrame:
    """Crosswalk rows from SQL expressions."""
    return df.select(
        F.lit(entity).alias("entity"), (F.expr(scope) if scope else F.lit(WORKSPACE)).alias("scope"),
        F.expr(source).cast("string").alias("source_key"), F.expr(target).cast("string").alias("target_key"))


def user_cw(spark, sf) -> DataFrame:
    return xw(t(spark, sf, "customer").where("c_acctbal >= 0"), "user", "c_custkey", "c_custkey + 100000")


USER_CW = "(select c_custkey as source_key, c_custkey + 100000 as target_key from customer where c_acctbal >= 0)"


def case_cw(spark, sf) -> DataFrame:
    return xw(t(spark, sf, "part").where("p_size > 5"), "case", "p_partkey", "p_partkey + 500000")


CASE_CW = "(select p_partkey as source_key, p_partkey + 500000 as target_key from part where p_size > 5)"


def attachment_cw(spark, sf) -> DataFrame:
    return xw(t(spark, sf, "documents").where("lang <> 'de'"), "attachment", "md5(cast(doc_id as string))",
              "md5(concat('t', doc_id))")


ATT_CW = ("(select doc_id, md5(doc_id::varchar) as source_key, md5('t' || doc_id) as target_key "
          "from documents where lang <> 'de')")

OLD_WS = "0123456789abcdef0123456789abcdef"
NEW_WS = "fedcba9876543210fedcba9876543210"


def linked_documents(spark, sf) -> DataFrame:
    """Documents whose whole text is followed by an image link, a bare link and a plural link."""
    return linked(t(spark, sf, "documents"))


def linked(df: DataFrame) -> DataFrame:
    return df.withColumn("k", F.md5(F.col("doc_id").cast("string"))).withColumn("text", F.expr(
        f"concat(text, ' ![a b](https://files.example/public/team/{OLD_WS}/attachment/', upper(k), '/pic.png)',"
        " ' see /attachment/', k, '/ and /attachments/', k, '/x')"))


def result_lines(spark, sf) -> DataFrame:
    """Line items as results: scope, run, key, case."""
    orders = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("project_code"), "o_custkey")
    lines = t(spark, sf, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).withColumn("hash", F.expr(
        "md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint),"
        " cast(round(l_extendedprice * 100) as bigint)))"))


LINES = ("(select *, o_orderpriority as project_code, md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
         " l_quantity::bigint, round(l_extendedprice * 100)::bigint)) as hash"
         " from lineitem join orders on l_orderkey = o_orderkey)")
