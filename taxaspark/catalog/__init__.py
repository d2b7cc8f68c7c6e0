"""Registered queries over the driver's tables (importing this module fills the registry)."""

from . import basic, composites, geo, names, pipeline, predictors, scoring  # noqa: F401  (registration side effects)
from .registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
