"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

import importlib

GROUPS = ["io", "cleaning", "gold", "features", "news", "risk", "models"]


def _modules():
    return [importlib.import_module(f"tanisight.plans.registry.{g}") for g in GROUPS]


def queries() -> dict:
    return {name: fn for m in _modules() for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in _modules() for name, text in m.SQL.items()}
