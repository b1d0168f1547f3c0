"""All registered queries."""

from __future__ import annotations

from corpusops.plans import (
    queries_compare, queries_cost, queries_gold, queries_prepare, queries_score, queries_streaming,
    queries_telemetry, queries_validate,
)
from corpusops.plans.registry import Query, Registry

MODULES = (
    queries_prepare, queries_validate, queries_gold, queries_score, queries_compare, queries_telemetry,
    queries_cost, queries_streaming,
)


def all_queries() -> dict[str, Query]:
    registry = Registry()
    for module in MODULES:
        module.register(registry)
    return registry.queries
