"""Composed jobs and the registry of named queries."""

import importlib

_MODULES = (
    "lakeops.plans.q_keyed",
    "lakeops.plans.q_runs",
    "lakeops.plans.q_text",
    "lakeops.plans.q_vectors",
    "lakeops.plans.q_aggregates",
    "lakeops.plans.q_sources",
    "lakeops.plans.q_streams",
)


def load_all() -> None:
    for module in _MODULES:
        importlib.import_module(module)
