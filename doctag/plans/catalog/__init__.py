"""All catalog queries, by name."""

from doctag.plans.catalog import (  # noqa: F401
    cleaning,
    dataset,
    features,
    models,
    rules,
    sampling,
    tokens,
)
from doctag.plans.catalog.registry import QUERIES

__all__ = ["QUERIES"]
