"""All registered queries and their SQL; those of optional subpackages are added by the caller."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scholarmesh.plans import detail_queries, entity_queries, experiment_queries, record_queries, score_queries, text_queries

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (entity_queries, score_queries, text_queries, record_queries, experiment_queries, detail_queries)


def flagship(spark: SparkSession, directory: str) -> DataFrame:
    return entity_queries.entity_score(spark, directory)


def queries() -> dict[str, Query]:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.SQL.items()}
