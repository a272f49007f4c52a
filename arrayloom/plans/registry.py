"""All registered queries of the reference operators, by name, with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arrayloom.plans import aggregates, joins, scalars, sources

FLAGSHIP = "j06_extract_classify_summary"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for module in (scalars, aggregates, joins, sources):
    QUERIES |= module.QUERIES
    ORACLE_SQL |= module.ORACLE_SQL
