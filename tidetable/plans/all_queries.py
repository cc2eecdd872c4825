"""Imports every query module, which registers its queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ("queries_relational", "queries_series", "queries_models", "queries_publication", "queries_files")


def load() -> None:
    for name in MODULES:
        import_module(f"tidetable.plans.{name}")
