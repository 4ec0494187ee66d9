"""All queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import data_queries, feed_queries, offer_queries, relational_queries, value_queries

MODULES = (data_queries, relational_queries, value_queries, offer_queries, feed_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, text in m.SQL.items()}
