"""Row predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .enums import FINISHED_WORDS, RESOLVED_WORDS
from .shapes import as_text, as_type, col, get, is_int, is_object, is_text, truthy


def allow(df: DataFrame, column: str, only) -> DataFrame:
    """Allow-list; an empty list allows all."""
    return df.where(F.col(column).isin(list(only))) if only else df


def deny(df: DataFrame, column: str, skip) -> DataFrame:
    return df.where(~F.col(column).isin(list(skip))) if skip else df


def has_all(*columns) -> Column:
    """Every required column is neither null nor blank."""
    return reduce(lambda a, b: a & b,
                  [F.coalesce(F.trim(col(c).cast("string")) != "", F.lit(False)) for c in columns])


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


# Members that say a run is finished.
FINISHED_FLAGS = ("is_completed", "is_complete")
FINISHED_TIMES = ("end_time", "completed_at", "time_end", "finished_at", "closed_at", "complete_time")
STATE_ALIASES = ("state", "status", "run_status", "runStatus", "execution_state", "executionState")
STATE_MEMBERS = ("title", "name", "status", "slug", "value")


def run_finished(df: DataFrame) -> Column:
    """Finished by a flag, by any finishing time, or by a state word (plain or inside an object).

    Flags and states are VARIANT columns, times are text; absent columns are skipped.
    """
    have = set(df.columns)

    def word(c):
        return F.coalesce(F.lower(F.trim(c)).isin(*FINISHED_WORDS), F.lit(False))

    tests = [F.coalesce(truthy(f), F.lit(False)) for f in FINISHED_FLAGS if f in have]
    tests += [F.coalesce(F.col(t) != "", F.lit(False)) for t in FINISHED_TIMES if t in have]
    for s in STATE_ALIASES:
        if s in have:
            tests.append(is_text(s) & word(as_text(s)))
            tests += [is_object(s) & word(get(s, m)) for m in STATE_MEMBERS]
    return any_of(tests) if tests else F.lit(False)


def defect_resolved(status) -> Column:
    """A resolving word, or a number above zero."""
    return F.coalesce(
        (is_text(status) & F.lower(as_text(status)).isin(*RESOLVED_WORDS))
        | (is_int(status) & (as_type(status, "bigint") > 0)), F.lit(False))
