"""Whole imports, and the registered queries."""

from __future__ import annotations

import importlib

_MODULES = ("table_queries", "search_queries", "file_queries", "record_queries", "format_queries", "layout_queries")


def all_queries():
    """Registered queries and their SQL, by name."""
    for name in _MODULES:
        importlib.import_module(f"docweave.plans.{name}")
    from docweave.plans.registry import QUERIES, SQL

    return QUERIES, SQL
