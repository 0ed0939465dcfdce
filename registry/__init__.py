"""Named queries over the given tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result in DuckDB's SQL."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def load_all() -> None:
    import importlib

    for module in (
        "signals", "reposts", "sources", "merges", "joins", "pages",
        "sheets", "runs", "jobs", "links", "identity", "ingest", "flows",
    ):
        importlib.import_module(f"registry.{module}")
