"""All registered queries."""

from importlib import import_module

from . import registry

MODULES = ["customers", "feeds", "cleaning", "joining", "summaries", "trading", "texts", "models", "streams"]


def load():
    for name in MODULES:
        import_module(f"millrace.plans.{name}")
    return registry.QUERIES, registry.ORACLES
