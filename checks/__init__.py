"""Registered queries and the SQL that checks them."""

from __future__ import annotations

import importlib

from checks.registry import ORACLES, QUERIES

_MODULES = (
    "masks", "phrases", "index_strings", "joins_filters", "lexicons", "charsets",
    "profiles", "tables", "messages", "archives", "files", "corpora",
)


def load_all() -> None:
    """Register the queries of every module."""
    for module in _MODULES:
        importlib.import_module(f"checks.{module}")


__all__ = ["ORACLES", "QUERIES", "load_all"]
