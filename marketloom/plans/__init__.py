"""Named queries over the driver's tables."""

from importlib import import_module

from marketloom.plans.registry import QUERIES, Query

_MODULES = ["flow_queries", "adjust_queries", "bar_queries", "reference_queries", "source_queries", "stream_queries"]


def load_queries() -> dict[str, Query]:
    for module in _MODULES:
        import_module(f"marketloom.plans.{module}")
    return QUERIES
