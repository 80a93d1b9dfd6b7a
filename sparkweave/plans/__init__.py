"""Queries bound to the input tables, one module per operator family."""

import importlib
import pkgutil

from sparkweave.plans.registry import CHECKS, QUERIES

for _m in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.startswith("q_")):
    importlib.import_module(f"{__name__}.{_m}")

__all__ = ["CHECKS", "QUERIES"]
