"""All registered queries."""

from tidemark.plans import event_queries, feed_queries, job_queries, ledger_queries, record_queries, state_queries  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
