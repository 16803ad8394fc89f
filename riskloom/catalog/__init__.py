"""Registered jobs over the given tables."""

from __future__ import annotations

from importlib import import_module

from riskloom.catalog import registry

_MODULES = ("expressions", "features", "profiles", "quality", "modelling", "operations", "streams")


def _load() -> None:
    for name in _MODULES:
        import_module(f"riskloom.catalog.{name}")


def jobs() -> dict[str, registry.Job]:
    _load()
    return dict(registry.JOBS)


def oracles() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
