"""Writing crosswalks, payloads and traces. All writes can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import store

# Columns each create request sends.
PAYLOAD = {
    "project": ["title", "code", "description", "access"],
    "suite": ["title", "description", "preconditions", "parent_id"],
    "milestone": ["title", "description", "status", "due_date"],
    "environment": ["title", "slug", "host", "description"],
    "shared_step": ["title", "steps"],
    "plan": ["title", "description", "cases"],
}


def save_crosswalk(cw: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """Replace the slices (entity, scope) that ``cw`` has; the others stay as they are. See `store`."""
    store.save(cw, path, order)


def replace_scope(worker: DataFrame, path: str, scope: str) -> None:
    """Replace all slices of one scope by a worker's. Slices of it that the worker doesn't have are gone, as with
    `crosswalk.replace_slices` in memory. The path may be new."""
    store.replace_scope(worker, path, scope)


def payload(df: DataFrame, entity: str, keys: list[str] = ()) -> DataFrame:
    """Columns the create request sends, after the keys that tell rows apart."""
    return df.select(*keys, *PAYLOAD[entity])


def append_trace(events: DataFrame, path: str) -> None:
    """Append events as JSON lines."""
    events.write.mode("append").json(path)
