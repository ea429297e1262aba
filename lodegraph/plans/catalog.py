"""All queries of the core by name, with their SQL; modules register themselves in MODULES."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodegraph.plans import q_extra, q_graph, q_more, q_quality, q_rest, q_retrieval, q_sources, q_steps, q_tables, repairs

MODULES = (repairs, q_sources, q_tables, q_graph, q_quality, q_retrieval, q_more, q_extra, q_steps, q_rest)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["p6_report"](spark, sf_dir)
