"""Ready-made queries over the benchmark tables, each with the same query in SQL where SQL can say it."""

from tidemark.catalog import (  # noqa: F401
    aggregations,
    alignment,
    corrections,
    derivations,
    flags,
    infills,
    lineage,
    minutes,
    networks,
    quality,
    storage,
)
from tidemark.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
