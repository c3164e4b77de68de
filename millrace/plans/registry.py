"""A table of queries and of the SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict[str, Callable], dict[str, str], Callable]:
    """Empty tables, and a decorator that registers a query under its function's name with its SQL."""
    queries: dict[str, Callable] = {}
    oracles: dict[str, str] = {}

    def query(sql: str | None) -> Callable:
        def register(f: Callable) -> Callable:
            queries[f.__name__] = f
            if sql:
                oracles[f.__name__] = sql
            return f

        return register

    return queries, oracles, query
