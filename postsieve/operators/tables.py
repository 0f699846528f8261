"""Unions, set operations and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def keys_without(df: DataFrame, key: str, *others: DataFrame) -> DataFrame:
    """Rows whose key is in none of the other tables."""
    for other in others:
        df = df.join(other.select(key), key, "left_anti")
    return df


def keys_in(df: DataFrame, key: str, other: DataFrame) -> DataFrame:
    """Rows whose key is in the other table."""
    return df.join(other.select(key), key, "left_semi")


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of both tables."""
    return a.select(key).intersect(b.select(key))


def flatten_lists(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row per item of a nested list."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(F.flatten(F.col(column))).alias(out))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the named columns that exist."""
    return df.drop(*columns)


def project(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Named projection; a mapping renames from its keys to its values."""
    pairs = columns.items() if isinstance(columns, Mapping) else zip(columns, columns)
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in pairs])


def upper_names(df: DataFrame) -> DataFrame:
    """Upper-case column names."""
    return df.toDF(*[c.upper() for c in df.columns])
