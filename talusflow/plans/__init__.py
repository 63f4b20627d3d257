"""Whole jobs, and the queries over the driver tables."""

from importlib import import_module

_QUERY_MODULES = ("feature_queries", "warehouse_queries", "statistics_queries", "model_queries",
                  "io_queries")


def _registry():
    for name in _QUERY_MODULES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")


def all_queries() -> dict:
    return dict(_registry().QUERIES)


def all_checks() -> dict:
    return dict(_registry().CHECKS)
