"""The operators bound to the driver tables, one module per group."""

from __future__ import annotations

import importlib

MODULES = [
    "sources", "relational", "aggregates", "ordered", "scalars", "tickets", "customers", "forecasts", "models",
    "streams",
]


def load_all() -> None:
    """Import every plan module once, which registers its queries."""
    for name in MODULES:
        importlib.import_module(f"turnstone.plans.{name}")
