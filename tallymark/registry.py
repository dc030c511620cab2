"""Registration of queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from tallymark.sources.ledger_view import LEDGER_SQL

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, ledger: bool = False):
    """Register a function (spark, sf_dir) -> DataFrame under its name; ``ledger`` puts the ledger view before the SQL."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            body = sql.strip()
            if ledger:
                body = f"WITH {LEDGER_SQL.strip()}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {LEDGER_SQL.strip()} {body}"
            ORACLES[f.__name__] = body
        return f

    return add
