"""The queries of this repository by name, with the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cases, journeys
from .plans import linkage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = cases.QUERIES | journeys.QUERIES | linkage.QUERIES
ORACLE_SQL: dict[str, str] = cases.ORACLE_SQL | journeys.ORACLE_SQL | linkage.ORACLE_SQL
