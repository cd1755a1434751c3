"""Name -> Spark query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with the SQL that must agree."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


class Tables:
    """The driver's parquet tables, read by attribute."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")
