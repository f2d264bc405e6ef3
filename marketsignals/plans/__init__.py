"""Query plans: named queries (with DuckDB oracles) and run compositions."""

from .registry import ORACLES, QUERIES


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (alert_queries, extract_queries, feed_queries, flagship, mart_queries,  # noqa: F401
                   store_queries, text_queries, usage_queries)


__all__ = ["QUERIES", "ORACLES", "load_all"]
