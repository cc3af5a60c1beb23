"""All registered queries; importing this module fills the registry."""

from kindred.plans import (  # noqa: F401
    evaluation_queries,
    linkage_queries,
    quality_queries,
    retrieval_queries,
    storage_queries,
    text_queries,
)
from kindred.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
