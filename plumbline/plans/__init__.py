"""Registered queries; importing this package fills the registry."""

from __future__ import annotations

from importlib import import_module

MODULES: tuple[str, ...] = ("listings", "checks", "titles", "programme", "texts", "resolution", "stages", "linked", "remembered", "served")


def load() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
