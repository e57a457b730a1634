"""Every operator as a query over the given tables, next to the SQL it must agree with."""

from __future__ import annotations

import importlib

MODULES = (
    "sources", "sinks", "filters", "joins", "aggregates", "windows", "sets", "functions",
    "texts", "similarity", "forecasting", "streams", "jobs",
)


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"clickloom.catalog.{name}")
