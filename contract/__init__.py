"""The registered queries and, for each, the SQL that must give the same rows."""

from __future__ import annotations

import importlib

MODULES = ["model", "business", "history", "loads", "shapes", "quality", "validation", "audit", "protection", "refreshing", "digests"]


def load_all():
    from . import registry
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return registry.QUERIES, registry.ORACLE
