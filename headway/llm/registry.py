"""Queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.llm.common import settings
from headway.plans.registry import Tables
from headway.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan under a name; ``sql`` gives the same rows in ANSI SQL."""

    def register(plan: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            apply_defaults(spark)
            settings(spark)
            return plan(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register
