"""Where the query modules keep what they register."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    """Queries and SQL twins of a module, and the decorator that adds to both."""
    queries: dict = {}
    oracles: dict = {}

    def register(name: str, sql: str | None = None):
        def keep(fn):
            queries[name] = fn
            if sql:
                oracles[name] = sql
            return fn

        return keep

    return queries, oracles, register
