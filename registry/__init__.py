"""Registered queries with their oracle SQL."""

import importlib

from .base import ORACLE, QUERIES

for _group in ("stock", "trade", "people", "market", "tables"):
    importlib.import_module(f"{__name__}.{_group}")

__all__ = ["ORACLE", "QUERIES"]
