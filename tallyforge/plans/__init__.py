"""All named queries."""

from tallyforge.plans import loan_queries, model_queries, table_queries  # noqa: F401
from tallyforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
