"""Runnable queries over the given tables, one module per area."""

import importlib
import pkgutil


def load_all() -> None:
    """Import every module of this package so that its queries register."""
    for info in pkgutil.iter_modules(__path__):
        if info.name not in ("registry", "views"):
            importlib.import_module(f"{__name__}.{info.name}")
