"""Checked queries: every operator bound to the test tables."""

from __future__ import annotations

from importlib import import_module

from laurel.catalog import registry

MODULES = (
    "ordered_queries",
    "rollup_queries",
    "feature_queries",
    "join_queries",
    "column_queries",
    "source_queries",
    "model_queries",
    "stream_queries",
)


def _load() -> None:
    for name in MODULES:
        import_module(f"laurel.catalog.{name}")


def queries():
    _load()
    return dict(registry.QUERIES)


def oracle_sql():
    _load()
    return dict(registry.ORACLES)
