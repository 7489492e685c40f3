"""Which part of a numbered sequence is covered by intervals: gaps and overlaps.

A scope may own a third of all intervals, so no scope is walked in one task: intervals are dealt into stretches of SPAN
numbers, each stretch finds its own running end, and a second, small walk over the stretches (one row each) carries the
furthest end so far into the next one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

SPAN = 1_000_000


def same_group(by: list[str], left: str = "", right: str = "_"):
    """Join condition on group columns; a missing value is a group of its own."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}")) for c in by])


def reached_before(intervals: DataFrame, by: list[str], start: str = "start", end: str = "end", span: int = SPAN) -> DataFrame:
    """Add `before`: the furthest end of all intervals of the group that sort before this one by (start, end); 0 if none."""
    ordered = intervals.withColumn("_stretch", F.floor(F.col(start) / span))
    inner = Window.partitionBy(*by, "_stretch").orderBy(start, end, *[c for c in intervals.columns if c not in (*by, start, end)])
    local = F.max(end).over(inner.rowsBetween(Window.unboundedPreceding, -1))
    ends = ordered.groupBy(*by, "_stretch").agg(F.max(end).alias("_end"))
    outer = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_stretch").alias("_at"), F.max("_end").over(outer).alias("_carried"))
    joined = ordered.withColumn("_local", local).join(carried, same_group(by) & (F.col("_stretch") == F.col("_at")), "left")
    return joined.select(*intervals.columns, F.greatest(F.coalesce("_local", F.lit(0)), F.coalesce("_carried", F.lit(0))).alias("before"))


def gaps(intervals: DataFrame, totals: DataFrame, by: list[str], start: str = "start", end: str = "end", total: str = "total") -> DataFrame:
    """(by..., start, end) of the maximal stretches of [0, total) that no interval covers. ``totals`` has a row for each group; a
    group without a total is open-ended: only holes before its last interval count."""
    walked = reached_before(intervals.select(*by, start, end), by, start, end)
    known = totals.select(*[F.col(c).alias(f"_{c}") for c in by], F.col(total).alias("_total"))
    inside = walked.where(F.col(start) > F.col("before")).join(known, same_group(by), "left")
    inside = inside.select(*by, F.col("before").alias(start), F.least(F.col(start), F.coalesce("_total", F.col(start))).alias(end)).where(F.col(start) < F.col(end))
    last = intervals.groupBy(*by).agg(F.max(end).alias("_last"))
    lasts = last.select(*[F.col(c).alias(f"_{c}") for c in by], "_last")
    tail = totals.select(*by, total).join(lasts, same_group(by), "left").withColumn("_last", F.coalesce("_last", F.lit(0)))
    after = tail.where(F.col(total) > F.col("_last")).select(*by, F.col("_last").alias(start), F.col(total).alias(end))
    return inside.unionByName(after)


def overlaps(intervals: DataFrame, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """(by..., start, end) of what each interval covers once more."""
    walked = reached_before(intervals.select(*by, start, end), by, start, end)
    return walked.where(F.col(start) < F.least("before", F.col(end))).select(*by, start, F.least("before", F.col(end)).alias(end))
