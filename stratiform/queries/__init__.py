"""Registered queries over the driver's tables, each with DuckDB SQL for the same rows where SQL can express it."""

from __future__ import annotations

from importlib import import_module

from stratiform.queries.base import ORACLE_SQL, QUERIES

for _name in ("filters", "orders", "rollups", "cohorts", "texts", "profiles", "images", "curations", "imaging", "series", "stages", "states"):
    import_module(f"stratiform.queries.{_name}")

__all__ = ["ORACLE_SQL", "QUERIES"]
