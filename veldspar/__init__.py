"""Veldspar: document-source analytics and corpus preparation on PySpark.

The parts are modules of their own: functions, operators, sources, streaming and plans, and llm where it is installed.
"""

from __future__ import annotations

import importlib

__all__ = ["functions", "operators", "plans", "runtime", "sources", "streaming"]


def __getattr__(name: str):
    if name in __all__:
        return importlib.import_module(f"{__name__}.{name}")
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
