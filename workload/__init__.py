"""The library's operators run on the test tables, each with an equivalent SQL text."""

from __future__ import annotations

import importlib

SECTIONS = ("published", "scans", "joining", "grouping", "windowing", "scalars", "measures", "business", "checks")


def load_all() -> None:
    """Register every query."""
    for section in SECTIONS:
        importlib.import_module(f"workload.{section}")
