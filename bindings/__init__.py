"""Binds the library to the driver's tables: Bronze logs, queries and their SQL oracles."""

from __future__ import annotations


def load():
    """All registered queries and oracles."""
    from bindings import (queries_ingest, queries_model, queries_quality, queries_relational,  # noqa: F401
                          queries_repair, queries_stream)
    from bindings.registry import ORACLES, QUERIES
    return QUERIES, ORACLES
