"""Registered queries over the supplied tables, each with equivalent SQL."""

from __future__ import annotations

from importlib import import_module

from sluice.catalog.registry import ORACLE, QUERIES, Query

MODULES = ("validation", "star", "operations", "jobs", "streams", "master")


def _load() -> None:
    for name in MODULES:
        import_module(f"sluice.catalog.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
