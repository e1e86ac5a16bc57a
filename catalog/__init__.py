"""Registered queries: each operator on the driver tables, with its SQL counterpart."""

from __future__ import annotations

import importlib

MODULES = ["scalars", "sources", "tables", "linking", "vocabulary", "rules", "acceptance", "analytics"]


def load():
    """Import every query module and return the registry."""
    for name in MODULES:
        importlib.import_module(f"catalog.{name}")
    return importlib.import_module("catalog.registry")
