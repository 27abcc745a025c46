"""Imports every query module, which registers its queries."""

from tidemark.catalog import catalog, check_queries, load_queries, metric_queries, model_queries  # noqa: F401
