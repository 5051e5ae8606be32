"""All registered queries and SQL texts, gathered from the query modules."""

from __future__ import annotations

from checks import job_queries, ml_queries, route_queries, sensor_queries, summary_queries

_MODULES = (sensor_queries, summary_queries, route_queries, ml_queries, job_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
