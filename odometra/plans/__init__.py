"""Registered queries of the engine."""

from . import io_queries, model_queries, more_queries, pair_queries, scalar_queries, similarity_queries, stats_queries, temporal_queries

MODULES = (temporal_queries, stats_queries, scalar_queries, pair_queries, model_queries, similarity_queries, io_queries, more_queries)

QUERIES = {k: v for m in MODULES for k, v in m.REGISTRY.queries.items()}
ORACLES = {k: v for m in MODULES for k, v in m.REGISTRY.oracles.items()}
