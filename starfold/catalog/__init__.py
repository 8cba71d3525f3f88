"""Registered queries: every operator and job as a query over the given tables, with its SQL equivalent."""

from __future__ import annotations

from importlib import import_module

from .registry import ORACLES, QUERIES

for _module in ("questions", "model", "relational", "merging", "expressions", "cleaning", "rules", "derivations", "storage", "loads"):
    import_module(f"{__name__}.{_module}")

__all__ = ["ORACLES", "QUERIES"]
