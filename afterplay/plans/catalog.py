"""All named queries, in the order of the operator groups."""

from afterplay.plans import (  # noqa: F401  # isort: skip
    queries_sources,
    queries_rows,
    queries_players,
    queries_split,
    queries_prepare,
    queries_metrics,
    queries_models,
    queries_profile,
)
from afterplay.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
