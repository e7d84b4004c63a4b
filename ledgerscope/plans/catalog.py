"""Import every query module so the registry is complete."""

from ledgerscope.plans import q_features, q_models, q_patterns, q_report, q_scoring, q_streaming  # noqa: F401
from ledgerscope.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
