"""Where a module of queries puts them."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    """Queries by name, and their SQL where it can say them."""

    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable:
        def add(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return add
