"""Status, severity and type codes, and ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .shapes import as_text, as_type, col, is_int, is_text

INT32_MAX = 2147483647

# Code tables both systems agree on.
RESULT_STATUS_BY_ID = {1: "passed", 2: "blocked", 3: "skipped", 4: "retest", 5: "failed"}
RESULT_STATUS_WORDS = {
    "passed": ("passed", "pass"),
    "failed": ("failed", "fail"),
    "blocked": ("blocked", "block"),
    "skipped": ("skipped", "skip"),
    "retest": ("retest", "retry"),
    "invalid": ("invalid",),
    "in_progress": ("in_progress", "in progress", "pending"),
    "untested": ("untested",),
}
ACCEPTED_RUN_STATUS = ("passed", "failed", "blocked", "skipped", "invalid", "untested")
STEP_STATUS_BY_INT = {1: "passed", 2: "failed", 3: "blocked", 5: "skipped", 7: "in_progress"}
STEP_STATUS_WORDS = {
    "passed": ("passed", "pass"),
    "failed": ("failed", "fail"),
    "blocked": ("blocked", "block"),
    "skipped": ("skipped", "skip"),
    "in_progress": ("in_progress", "in progress", "pending"),
}
SEVERITY = {"undefined": 0, "blocker": 1, "critical": 2, "major": 3, "normal": 4, "minor": 5, "trivial": 6}
FIELD_ENTITY = {"case": 0, "run": 1, "defect": 2}
FIELD_TYPE = {
    "string": 0, "number": 1, "text": 2, "selectbox": 3, "checkbox": 4,
    "radio": 5, "multiselect": 6, "url": 7, "user": 8, "date": 9,
}
FINISHED_WORDS = ("completed", "complete", "finished", "done", "closed", "aborted", "ended")
RESOLVED_WORDS = ("resolved", "closed", "invalid", "duplicate")


def by_code(c: Column, table: dict) -> Column:
    """Value of a small literal table, null when absent."""
    out = None
    for k, v in table.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def by_word(c: Column, table: dict) -> Column:
    """Group whose words contain the text, null when none does."""
    out = None
    for group, words in table.items():
        out = F.when(c.isin(*words), group) if out is None else out.when(c.isin(*words), group)
    return out


def result_status(status_id, status) -> Column:
    word = by_word(F.lower(col(status)), RESULT_STATUS_WORDS)
    return F.coalesce(by_code(col(status_id), RESULT_STATUS_BY_ID), word, F.lit("skipped"))


def run_execution_status(core) -> Column:
    """Statuses the target rejects on old runs are coerced."""
    c = F.lower(F.coalesce(col(core), F.lit("skipped")))
    return (F.when(c.isin("retest", "in_progress"), "blocked")
            .when(c.isin(*ACCEPTED_RUN_STATUS), c).otherwise("skipped"))


def step_status(v) -> Column:
    """Step status from a variant holding a number or a word; its numbering is not that of results."""
    n = by_code(as_type(v, "bigint"), STEP_STATUS_BY_INT)
    w = by_word(F.lower(F.trim(as_text(v))), STEP_STATUS_WORDS)
    return F.coalesce(F.when(is_int(v), n), F.when(is_text(v), w), F.lit("passed"))


def severity_code(word) -> Column:
    return F.coalesce(by_code(F.lower(col(word)), SEVERITY), F.lit(0))


def field_entity_code(v) -> Column:
    return F.when(is_int(v), as_type(v, "int")).otherwise(
        F.coalesce(by_code(F.lower(as_text(v)), FIELD_ENTITY), F.lit(0)))


def field_type_code(v) -> Column:
    return F.when(is_int(v), as_type(v, "int")).otherwise(
        F.coalesce(by_code(F.lower(as_text(v)), FIELD_TYPE), F.lit(0)))


def field_entity_of_word(word) -> Column:
    return F.coalesce(by_code(F.lower(col(word)), FIELD_ENTITY), F.lit(0))


def duration_ms(ms_fields, second_fields) -> Column:
    """First whole-number field: milliseconds as they are, seconds times 1000; negative -> null."""
    parsed = [F.when(c.isNotNull(), c) for c in map(col, ms_fields)]
    parsed += [c * 1000 for c in map(col, second_fields)]
    n = F.coalesce(*parsed)
    return F.when(n >= 0, n)


def whole_number(c) -> Column:
    """Text or number as bigint, null when it is not a whole number."""
    return col(c).try_cast("bigint")


def numeric_text(c) -> Column:
    """Numeric text in its plain form; other text passes through."""
    return F.coalesce(whole_number(F.trim(col(c))).cast("string"), col(c))


def safe_id(c, mode: str = "preserve") -> Column:
    """Ids within int32 stay; larger ones become 8 hex digits of their md5, modulo 2^31-1."""
    if mode == "drop":
        return F.lit(None).cast("bigint")
    n = col(c).cast("bigint")
    hashed = F.conv(F.substring(F.md5(n.cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(INT32_MAX)
    return F.when(n <= INT32_MAX, n).otherwise(hashed)
