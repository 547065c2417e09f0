"""Registered queries with their SQL checks."""

from importlib import import_module

MODULES = ("lists", "texts", "packages", "pages", "storage", "streams", "jobs")


def load():
    """Imports every query module and returns the registry."""
    for name in MODULES:
        import_module(f"listprep.queries.{name}")
    return import_module("listprep.queries.registry")
