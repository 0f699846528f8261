"""Registration of queries and of the SQL that gives the same result."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixtures import FIXTURES, SHARED, SPREAD, duckdb_sql, fixture_sql, inputs
from postsieve.session import new_folder, spread


class Context:
    """Tables and fixtures of one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._known: dict[str, DataFrame] = {}
        self._shared: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in FIXTURES:
                text = re.sub(
                    r"\$rows\((\w+)\)\$", lambda m: str(self(m[1]).count()),
                    fixture_sql(name, "spark"),
                )
                tables = {table: self._written(table) if table in SHARED else self(table) for table in inputs(text)}
                if name in SPREAD:
                    tables[SPREAD[name]] = spread(tables[SPREAD[name]])
                self._known[name] = self.spark.sql(text, **tables)
            else:
                self._known[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._known[name]

    def _written(self, name: str) -> DataFrame:
        """A fixture that several others read; it is computed once."""
        if name not in self._shared:
            path = new_folder(self.spark, name)
            self(name).write.parquet(path)
            self._shared[name] = self.spark.read.schema(self(name).schema).parquet(path)
        return self._shared[name]


Query = Callable[[Context], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if SQL can express it, its check."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = duckdb_sql(sql)
        return fn

    return register


def runnable(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    """The form the driver calls."""
    return lambda spark, sf_dir: fn(Context(spark, sf_dir))
