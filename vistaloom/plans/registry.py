"""How query modules register what they offer."""

from __future__ import annotations


class Registry:
    """Queries and their DuckDB SQL by name."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.oracle_sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def register(f):
            self.queries[f.__name__] = f
            if sql:
                self.oracle_sql[f.__name__] = sql
            return f

        return register
