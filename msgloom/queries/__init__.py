"""Queries over the given tables, one or more for every operator."""

from __future__ import annotations

from importlib import import_module

AREAS = ("events", "notifications", "leads", "tables_and_files", "streams")


def load_all() -> None:
    """Import every module, which registers its queries."""
    for area in AREAS:
        import_module(f"{__name__}.{area}")
