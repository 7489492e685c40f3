"""Summary and detail records of the same row; positional merge of two step trees."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.shapes import as_type, is_array, items, members, names, none_of, pick_member, truthy
from .ranking import last_per_key, orderable


def overlay(
    summary: DataFrame, detail: DataFrame, on: list[str], not_shorter: tuple[str, ...] = (),
    longer: tuple[str, ...] = (), fill_only: tuple[str, ...] = (), size=None, latest: tuple[str, ...] = (),
) -> DataFrame:
    """Left join a detail record over its summary; non-null detail wins.

    Lists in ``not_shorter`` win when at least as long, lists in ``longer`` only when longer; columns
    in ``fill_only`` only fill gaps. ``size`` measures a list column (default: variant list).

    A detail that was landed twice counts once: the last by ``latest``, then by its plain columns. So every summary row
    stays one row. The last column of ``on`` is the key, which never matches by null; those before it are scopes, and a
    missing scope matches a missing one.
    """
    size = size or (lambda c: F.size(items(c)))
    extra = [c for c in detail.columns if c not in on]
    once = last_per_key(detail.where(F.col(on[-1]).isNotNull()), on, [*latest, *orderable(detail, [*on, *latest])])
    d = once.select(*[F.col(c).alias(f"_on{i}") for i, c in enumerate(on)], *[F.col(c).alias(f"_d_{c}") for c in extra])
    same = [F.col(c).eqNullSafe(F.col(f"_on{i}")) if c != on[-1] else F.col(c) == F.col(f"_on{i}") for i, c in enumerate(on)]
    joined = summary.join(d, reduce(lambda a, b: a & b, same), "left")

    def pick_value(c):
        new = F.col(f"_d_{c}")
        if c not in summary.columns:
            return new.alias(c)
        old = F.col(c)
        if c in fill_only:
            return F.coalesce(old, new).alias(c)
        if c in not_shorter:
            return F.when(new.isNotNull() & (old.isNull() | (size(new) >= size(old))), new).otherwise(old).alias(c)
        if c in longer:
            return F.when(new.isNotNull() & (old.isNull() | (size(new) > size(old))), new).otherwise(old).alias(c)
        return F.coalesce(new, old).alias(c)

    return joined.select(
        *[F.col(c) if c in on or c not in extra else pick_value(c) for c in summary.columns],
        *[pick_value(c) for c in extra if c not in summary.columns])


# Step members under `execution` that replace the step's own.
EXECUTION_WINS = (
    "comment", "Comment", "message", "Message", "text", "Text", "actual_result", "actualResult", "actual",
    "Actual", "result", "Result", "body", "Body", "content", "Content", "output", "Output", "log", "Log",
    "stdout", "stderr", "error", "Error", "errors", "attachments", "duration", "time_ms", "time_spent_ms",
    "stacktrace", "start_time", "end_time", "status", "status_id",
)
# Names under which a step's texts are landed.
ACTION = ("action", "Action", "title", "Title", "name", "Name")
EXPECTED = ("expected_result", "expectedResult", "expected", "Expected")
ACTUAL = (
    "actual_result", "actualResult", "actual", "Actual", "result", "Result", "body", "Body", "content",
    "Content", "output", "Output", "log", "Log", "stdout", "stderr", "error", "Error",
)
COMMENT = ("comment", "Comment", "message", "Message", "text", "Text")


def _empty(v: Column) -> Column:
    t = F.try_variant_get(v, "$", "string")
    return F.coalesce(t.isin("", "[]", "{}"), F.lit(True))


def flat_step(step) -> Column:
    """Members of a step after its nested `data` (fills blanks) and `execution` (replaces the
    result-like members, fills the others) are laid over it: map<string,variant>."""
    none = none_of("map<string,variant>")
    wins = names(EXECUTION_WINS)

    def layer(name):
        return F.coalesce(members(F.try_variant_get(step, f"$.{name}", "variant")), none)

    def fill(_, below, above):
        return F.when(F.try_variant_get(above, "$", "string").isNotNull() & _empty(below), above).otherwise(below)

    def replace(k, below, above):
        text = F.try_variant_get(above, "$", "string")
        strong = F.when(k.isin("status", "status_id"), text.isNotNull()).otherwise(
            text.isNotNull() & ~_empty(above) & (F.trim(text) != ""))
        return F.when(F.when(F.array_contains(wins, k), strong).otherwise(text.isNotNull() & _empty(below)), above
                      ).otherwise(below)

    out = F.map_zip_with(F.coalesce(members(step), none), layer("data"), fill)
    for name in ("execution", "Execution"):
        out = F.map_zip_with(out, layer(name), replace)
    return out


def step_text(flat, aliases) -> Column:
    """First non-blank alias of a flattened step, trimmed."""
    return pick_member(flat, aliases)


def step_member(flat, name: str) -> Column:
    return F.try_element_at(F.col(flat) if isinstance(flat, str) else flat, F.lit(name))


def step_columns(flat) -> list[Column]:
    """The columns of the step table read from one flattened step."""
    duration = F.coalesce(*[F.when(truthy(step_member(flat, d)), as_type(step_member(flat, d), "bigint"))
                            for d in ("duration", "time_ms", "time_spent_ms")])
    return [
        step_text(flat, ACTION).alias("action"),
        step_text(flat, EXPECTED).alias("expected_result"),
        step_text(flat, ACTUAL).alias("actual"),
        step_text(flat, COMMENT).alias("comment"),
        step_member(flat, "status").alias("status"),
        step_member(flat, "status_id").alias("status_id"),
        step_member(flat, "attachments").alias("attachments"),
        duration.alias("duration"),
    ]


def _empty_value(v) -> bool:
    return v is None or v in ("", "[]", "{}") or v == [] or v == {}


def _nested(step) -> list:
    """Steps below a step, laid over each other as `flat_step` does with every member."""
    below = step.get("steps")
    for name in ("data", "execution", "Execution"):
        layer = step.get(name)
        if isinstance(layer, dict) and layer.get("steps") is not None and _empty_value(below):
            below = layer["steps"]
    return below if isinstance(below, list) else []


def _without_nested(step):
    if not isinstance(step, dict):
        return step
    return {k: {n: x for n, x in v.items() if n != "steps"} if k in ("data", "execution", "Execution") and isinstance(v, dict) else v
            for k, v in step.items() if k != "steps"}


#: Numbers with a fraction pass through as they are written: a mark that no text has stands around them while a step is a text.
_MARK = uuid.uuid4().hex


def walk_steps(text: str | None) -> Iterator[tuple[list[int], str]]:
    """(path, step as JSON without the steps below it) of every step of a tree, at any depth."""
    tree = json.loads(text, parse_float=lambda s: f"{_MARK}{s}{_MARK}") if text else None
    todo = [([i], s) for i, s in enumerate(tree)] if isinstance(tree, list) else []
    while todo:
        path, step = todo.pop()
        flat = json.dumps(_without_nested(step), ensure_ascii=False)
        yield path, re.sub(f'"{_MARK}([^"]*){_MARK}"', r"\1", flat) if _MARK in flat else flat
        if isinstance(step, dict):
            todo += [([*path, i], s) for i, s in enumerate(_nested(step))]


#: Steps of one Arrow batch that a walk hands on.
STEPS = 2_000


def explode_steps(df: DataFrame, row_key: list[str], steps) -> DataFrame:
    """Step tree -> table (row_key, path array<int>, step columns), one row per step at any depth.

    One pass whatever the depth: an Arrow function walks each row's tree, and the steps it finds are flattened by
    expressions, each once. Nothing is written and no job is run before the result is used.
    """
    text = F.when(is_array(steps), F.to_json(steps if isinstance(steps, Column) else F.col(steps)))
    slim = df.select(*row_key, text.alias("_tree")).where("_tree is not null")
    kinds = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in row_key)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, paths, found = [], [], []

            def out():
                at = pa.array(rows, pa.int64())
                return pa.record_batch([*[batch.column(c).take(at) for c in row_key], pa.array(paths, pa.list_(pa.int32())), pa.array(found, pa.string())],
                                       names=[*row_key, "path", "_step"])

            for i, tree in enumerate(batch.column("_tree")):
                for path, step in walk_steps(tree.as_py()):
                    rows.append(i)
                    paths.append(path)
                    found.append(step)
                    if len(rows) >= STEPS:
                        yield out()
                        rows, paths, found = [], [], []
            if rows:
                yield out()

    walked = slim.mapInArrow(walk, f"{kinds}, path array<int>, _step string")
    return walked.select(*row_key, "path", flat_step(F.parse_json("_step")).alias("_flat")).select(*row_key, "path", *step_columns("_flat"))


def zip_steps(
    result_steps: DataFrame, case_steps: DataFrame, row_key: list[str], parent_status: str = "parent_status"
) -> DataFrame:
    """Merge two step tables by (row, path).

    Result columns win where they are not null; a blank or `.` action and a blank expected result come
    from the case. Case steps below a parent with no result steps at all are synthesised and take the
    row's ``parent_status`` (a column of ``case_steps``) when they have none of their own.
    """
    on = [*row_key, "path"]
    parent = F.slice(F.col("path"), F.lit(1), F.size("path") - 1)
    shared = [c for c in result_steps.columns if c not in on]
    r = result_steps.select(*on, *[F.col(c).alias(f"_r_{c}") for c in shared], F.lit(True).alias("_r"))
    c = case_steps.select(*on, *[F.col(x).alias(f"_c_{x}") for x in shared], F.col(parent_status).alias("_ps"))
    siblings = Window.partitionBy(*row_key, "_parent")  # the steps of one list
    merged = r.join(c, on, "full").withColumn("_parent", parent).withColumn("_covered", F.max("_r").over(siblings))
    synthetic = F.col("_r").isNull() & F.col("_covered").isNull()

    def value(x):
        rv, cv = F.col(f"_r_{x}"), F.col(f"_c_{x}")
        if x == "action":
            return F.coalesce(F.when(F.trim(rv).isin("", "."), None).otherwise(rv), cv, rv)
        if x == "expected_result":
            return F.coalesce(F.nullif(F.trim(rv), F.lit("")), cv)
        return F.coalesce(rv, cv)

    cols = {x: value(x) for x in shared}
    if "status_id" in cols:
        own = F.col("_c_status_id")
        no_status = own.isNull()
        if "status" in cols:
            no_status = no_status & F.col("_c_status").isNull()
        fill = F.when(synthetic & no_status, F.col("_ps").cast(result_steps.schema["status_id"].dataType))
        cols["status_id"] = F.coalesce(cols["status_id"], fill)
    origin = F.when(F.col("_r").isNull(), F.when(synthetic, "synthetic").otherwise("case")).otherwise("result")
    return merged.select(*on, *[v.alias(k) for k, v in cols.items()], origin.alias("origin"))
