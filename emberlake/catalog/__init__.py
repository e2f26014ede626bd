"""Queries registered over the given tables."""

from __future__ import annotations


def _load() -> None:
    from emberlake.catalog import (  # noqa: F401
        queries_core, queries_files, queries_forms, queries_more, queries_profiles, queries_relational,
        queries_reports, queries_upkeep,
    )


def queries() -> dict:
    from emberlake.catalog import registry

    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    from emberlake.catalog import registry

    _load()
    return dict(registry.SQL)
