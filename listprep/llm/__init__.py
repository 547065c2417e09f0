"""Operators of a training-data pipeline; nothing else in the library imports this package."""

from importlib import import_module

MODULES = (
    "classifier",
    "licenses",
    "exact",
    "simhash",
    "mixing",
    "suffixes",
    "toxicity",
    "secrets",
    "bpe",
    "quality",
    "fingerprints",
    "search",
    "repair",
)


def load():
    """Imports every operator module and returns the registry of their queries."""
    for name in MODULES:
        import_module(f"listprep.llm.{name}")
    return import_module("listprep.llm.registry")
