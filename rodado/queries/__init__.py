"""Registered queries with their SQL twins."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable


def _collect(name: str) -> dict:
    out: dict = {}
    for m in sorted(x.name for x in pkgutil.iter_modules(__path__)):
        out |= getattr(importlib.import_module(f"{__name__}.{m}"), name, {})
    return out


def queries() -> dict[str, Callable]:
    return _collect("QUERIES")


def sql() -> dict[str, str]:
    return _collect("SQL")
