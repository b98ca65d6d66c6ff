"""Where queries are kept by name, and how they get at tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The tables of a folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        """Registers a function of Tables under its name, with its SQL."""

        def wrap(f):
            if f.__name__ in self.queries:
                raise ValueError(f"there are two queries {f.__name__}")
            self.queries[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
            if sql:
                self.sql[f.__name__] = sql
            return f

        return wrap


catalogue = Registry()
query = catalogue.add
