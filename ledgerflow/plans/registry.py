"""All registered queries outside the training-data subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.plans import change_queries, check_queries, detail_queries, io_queries, release_queries, resolve_queries, stream_queries, study_queries, tracking_queries

_MODULES = (change_queries, resolve_queries, check_queries, stream_queries, tracking_queries, study_queries, io_queries, release_queries, detail_queries)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _m in _MODULES:
    QUERIES |= _m.QUERIES
    ORACLE_SQL |= _m.ORACLE_SQL
