"""All queries of the core."""

from __future__ import annotations

import importlib

from tallyloom.plans.registry import Registry

MODULES = ("pipeline", "filters", "joins", "aggregates", "scalars", "entities", "rules", "learning", "streams", "more", "parsed", "models", "staged")


def core() -> Registry:
    """The queries of every core module."""
    out = Registry()
    for name in MODULES:
        part = importlib.import_module(f"tallyloom.plans.{name}").registry
        for query, f in part.queries.items():
            out.add(query, part.sql.get(query))(f)
    return out
