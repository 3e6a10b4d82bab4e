"""Every registered query: a DataFrame builder and, where SQL can say it, its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

MODULES = ("scans", "scalars", "page_rows", "cards", "extraction", "history", "vectors", "keyed", "sinks")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"queries.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
