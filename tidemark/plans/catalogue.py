"""All registered queries; importing the modules fills the registry."""

from __future__ import annotations

import importlib

from tidemark.plans.registry import ENTRIES

for _module in ("layers", "checks", "operations", "reads", "streams"):
    importlib.import_module(f"tidemark.plans.{_module}")

__all__ = ["ENTRIES"]
