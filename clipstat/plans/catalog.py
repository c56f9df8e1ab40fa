"""All registered queries. Importing the query modules fills the registry."""

from __future__ import annotations

import importlib

from clipstat.plans.registry import CHECKS, QUERIES, spark_queries

for _name in ("queries_posts", "queries_stats", "queries_media", "queries_report", "queries_sources"):
    importlib.import_module(f"clipstat.plans.{_name}")

__all__ = ["CHECKS", "QUERIES", "spark_queries"]
