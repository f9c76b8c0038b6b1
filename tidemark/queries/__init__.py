"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from tidemark.queries.registry import QUERIES, Query

MODULES = ("experiments", "corpus", "chat", "telemetry", "jobs", "tokens", "files", "streams")


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        import_module(f"tidemark.queries.{name}")
    return dict(QUERIES)
