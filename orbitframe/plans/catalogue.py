"""All queries over the driver's tables, and their SQL."""

from orbitframe.plans import aggregates, decisions, filters, joins, rasters, scalars, spatial  # noqa: F401
from orbitframe.plans.registry import catalogue

QUERIES = catalogue.queries
ORACLE_SQL = catalogue.sql
