"""All registered queries of the engine's own operators, with their SQL where it can say the same."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quadrat.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder, read when they are named."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of Tables as a query."""

    def put(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, path: ship(spark) or f(Tables(spark, path))
        if sql:
            SQL[name] = sql
        return f

    return put


for _module in ("relational", "diversity", "series", "space", "validation", "storage", "models", "more", "blocks", "curves", "images", "designs", "ordination", "phenology"):
    importlib.import_module(f"quadrat.plans.{_module}")
