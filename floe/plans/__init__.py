"""All named queries; importing this package fills ``REGISTRY``."""

from floe.plans import model_queries, record_queries, text_queries, window_queries  # noqa: F401
from floe.plans import stream_queries  # noqa: F401  (after the batch twins)
from floe.plans.registry import REGISTRY, Query, query

__all__ = ["REGISTRY", "Query", "query"]
