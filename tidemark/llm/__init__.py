"""Operators for training data, and their queries."""

from tidemark.llm import (  # noqa: F401
    binary_packing,
    decontaminate,
    language,
    license_scan,
    linefreq,
    merkle,
    neighbours,
    packing,
    quality,
    simhash,
    toxicity,
    urls,
    whitening,
)
from tidemark.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
