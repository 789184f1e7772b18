"""Queries bound to the input tables."""

from __future__ import annotations

import importlib

from rowmill.plans.registry import CATALOG, Bound

MODULES = (
    "projection", "joining", "aggregation", "windowing", "sorting", "scalars",
    "mutation", "layout", "quality", "normalization", "recursion",
    "commerce", "banking", "analytics", "tenancy", "scenarios", "generated", "streams",
)


def load_catalog() -> dict[str, Bound]:
    for module in MODULES:
        importlib.import_module(f"rowmill.plans.{module}")
    return CATALOG
