"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from .base import QUERIES, SQL


def load() -> None:
    """Import the query modules, which register themselves."""
    import importlib
    for name in ("scans", "rows", "lookups", "ordered", "composed", "streams"):
        importlib.import_module(f"{__name__}.{name}")


__all__ = ["QUERIES", "SQL", "load"]
