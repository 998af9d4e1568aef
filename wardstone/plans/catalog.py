"""All named queries; importing this module registers them."""

from wardstone.plans import (  # noqa: F401
    evaluation,
    feature_queries,
    modelling,
    profiling,
    scoring_queries,
    segment_rates,
    statistics,
)
from wardstone.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
