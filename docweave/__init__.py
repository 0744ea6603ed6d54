"""Keep search documents, key-value state and job queues in step with relational tables, on Spark."""

from docweave.session import build_session, configure

__all__ = ["build_session", "configure"]
