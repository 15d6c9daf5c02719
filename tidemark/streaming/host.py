"""How a running query ends: drained, or at once."""

from __future__ import annotations

from pyspark.sql.streaming.query import StreamingQuery


def close(query: StreamingQuery) -> None:
    """End after all that has arrived by now is processed."""
    try:
        if query.isActive:
            query.processAllAvailable()
    finally:
        query.stop()


def shutdown_fast(query: StreamingQuery) -> None:
    """End without waiting: an unfinished batch runs again at the next start, from its checkpoint."""
    query.stop()
