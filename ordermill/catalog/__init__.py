"""Queries over the given tables and the SQL each one is checked against."""

from __future__ import annotations


def _load() -> None:
    from . import checks, ingest, metrics, orders, reports, scalars  # noqa: F401  (importing a module registers its queries)


def all_queries() -> dict:
    from .registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from .registry import ORACLES

    _load()
    return dict(ORACLES)
