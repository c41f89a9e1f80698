"""Registered queries: each a Spark callable plus, where SQL can say it, its reference SQL."""

from shopgrain.catalog import (  # noqa: F401
    change_queries,
    forecast_queries,
    layout_queries,
    metric_queries,
    models,
    quality_checks,
    relational,
    silver_streams,
    stream_queries,
)
from shopgrain.catalog.registry import REGISTRY, Query  # noqa: F401
