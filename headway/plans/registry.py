"""Registered queries: a Spark plan and, where one exists, equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.session import BOUNDED, BY_FILE, DEFAULTS, apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables by attribute name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, df: DataFrame, key: str) -> DataFrame:
        """Small rows dealt out over the cores, ahead of dear work on each."""
        return df.repartition(self.spark.sparkContext.defaultParallelism * 2, key)


_SHARED: dict[tuple[str, str, str], object] = {}


def shared(plan: Callable[[Tables], object]) -> Callable[[Tables], object]:
    """What several queries need of one folder is made once per application (its staged tables are read again)."""

    def made(t: Tables) -> object:
        key = (t.spark.sparkContext.applicationId, t.folder, f"{plan.__module__}.{plan.__name__}")
        if key not in _SHARED:
            _SHARED[key] = plan(t)
        return _SHARED[key]

    return made


def query(name: str, sql: str | None = None, by_file: bool = False):
    """Register a plan under a name; ``sql`` gives the same rows in ANSI SQL.

    ``by_file`` is for plans whose rows meet within their file only (``BY_FILE``).
    """
    settings = {**DEFAULTS, **BOUNDED, **(BY_FILE if by_file else {})}

    def register(plan: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            apply_defaults(spark, settings)
            return plan(Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register
