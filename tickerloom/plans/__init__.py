"""Registered queries over the given tables."""

from tickerloom.plans import q_agg, q_jobs, q_text
from tickerloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "q_agg", "q_jobs", "q_text"]
