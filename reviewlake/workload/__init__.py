"""The registered queries: each runs an operator over the given tables, with equal SQL where SQL can say it."""

from __future__ import annotations

from importlib import import_module
from types import ModuleType

SECTIONS = ("io", "text", "rows", "counts", "samples", "vectors", "models", "scores", "products")


def load() -> ModuleType:
    """The registry with every section registered."""
    for section in SECTIONS:
        import_module(f"reviewlake.workload.{section}")
    return import_module("reviewlake.workload.registry")
