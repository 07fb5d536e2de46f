"""The queries of the recording operators, by name, with their SQL."""

from __future__ import annotations

from . import kept, made, seen, spoken


def queries() -> dict:
    return {**spoken.QUERIES, **seen.QUERIES, **kept.QUERIES, **made.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**spoken.SQL, **seen.SQL, **kept.SQL, **made.SQL}
