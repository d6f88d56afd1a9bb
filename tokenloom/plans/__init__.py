"""Registered queries."""

from __future__ import annotations

from importlib import import_module

from tokenloom.plans.catalog import ORACLES, QUERIES

MODULES = ("corpus", "loader", "vocabulary", "analytics", "streams")


def _load() -> None:
    for name in MODULES:
        import_module(f"tokenloom.plans.{name}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
