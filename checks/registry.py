"""Where check queries and their SQL are collected."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sentilake.session import shared_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def scratch(spark: SparkSession) -> str:
    """A fresh path under the shared checkpoint folder, or a temporary one on a local session."""
    return shared_path(spark, "check")
