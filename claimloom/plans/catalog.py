"""All registered queries."""

from __future__ import annotations

from claimloom.plans import registry, sqltext

from claimloom.plans import (  # noqa: F401  (each module registers its queries)
    ingest,
    scalars,
    checks,
    history,
    joins,
    gold,
    boards,
    measures,
    streams,
    audits,
)


def queries():
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sqltext.full(text) for name, text in registry.SQL.items()}
