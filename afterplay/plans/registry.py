"""Named queries. Each takes a session and a folder of tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from afterplay.session import pin_utc

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFunction
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query; ``sql`` is the same result in ANSI SQL, where SQL can say it."""

    def register(function: QueryFunction) -> QueryFunction:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(pin_utc(spark), folder)

        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, run, sql)
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
