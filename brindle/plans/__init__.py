"""Registered queries: one module per area, each key with its callable and, where SQL can say it, an oracle."""

from __future__ import annotations

import importlib
import pkgutil

from brindle.plans.registry import ORACLES, QUERIES


def load():
    """All queries and oracles, in registration order."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{module}")
    return dict(QUERIES), dict(ORACLES)
