"""A PySpark-native search-projection engine, and operators for training data beside it."""

from __future__ import annotations

import importlib

#: What the package offers at its root, loaded when it is asked for.
_HOMES = {
    "Session": "engine.session", "capabilities": "engine.session", "Settings": "engine.settings", "Limits": "engine.limits", "KeyRing": "engine.cursor",
    "Schema": "engine.layout", "Field": "engine.layout", "SearchProfile": "engine.layout", "DocumentProfile": "engine.layout", "Layout": "engine.layout",
    "compile_layout": "engine.layout", "Generations": "engine.generation", "Search": "engine.search", "EngineError": "engine.errors",
    "project_stream": "streaming.sink", "outcomes": "streaming.outcomes",
}
__all__ = list(_HOMES)


def __getattr__(name: str):
    if name not in _HOMES:
        raise AttributeError(name)
    return getattr(importlib.import_module(f"tidemark.{_HOMES[name]}"), name)
