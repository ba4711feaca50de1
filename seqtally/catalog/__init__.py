"""Registered queries: each operator run on views that give the test tables sequencing shapes."""

from seqtally.catalog.registry import REGISTRY
from seqtally.catalog import alignment_queries, hit_queries, sample_queries, source_queries, table_queries  # noqa: F401  (register on import)

__all__ = ["REGISTRY"]
