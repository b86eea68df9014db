"""End-to-end jobs and the registered queries."""

from importlib import import_module

MODULES = ["mapping_queries", "analytics_queries", "quality_queries", "search_queries", "report_queries", "lake_queries"]


def all_queries():
    from statlake.plans.registered import QUERIES
    for m in MODULES:
        import_module(f"statlake.plans.{m}")
    return QUERIES
