"""All queries of the core, by name."""

from __future__ import annotations

import importlib

MODULES = ("reference_queries", "document_queries")


def _all(name: str) -> dict:
    out: dict = {}
    for m in MODULES:
        try:
            module = importlib.import_module(f"lavra.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"lavra.plans.{m}":
                raise
            continue
        out |= getattr(module, name, dict)()
    return out


def queries() -> dict:
    return _all("queries")


def oracle_sql() -> dict:
    return _all("oracle_sql")
