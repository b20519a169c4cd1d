"""Every graph query by name, with the SQL that gives the same rows."""

from __future__ import annotations

from evigraph.plans import queries as plans


def queries() -> dict:
    return dict(plans.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(plans.SQL)
