"""The pN_ queries of the problems in this subpackage, and their SQL."""

from __future__ import annotations

import importlib

MODULES = ("p1_queries", "p2_queries", "p3_queries", "p4_queries", "p5_queries", "p6_queries", "p7_queries", "p8_queries", "p9_queries")


def _all(name: str) -> dict:
    out: dict = {}
    for m in MODULES:
        try:
            module = importlib.import_module(f"lavra.llm.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"lavra.llm.{m}":
                raise
            continue
        out |= getattr(module, name, dict)()
    return out


def queries() -> dict:
    return _all("queries")


def oracle_sql() -> dict:
    return _all("oracle_sql")
