"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.functions.rewrite import evaluated_once
from postsieve.operators.dedup import marked
from postsieve.operators.lookup import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, stored
from postsieve.rules.domains import EXCLUDED_SUBJECTS, PRIVATE_DOMAINS
from postsieve.rules.mask_rules import FAILED_TEXT
from postsieve.rules.phrase_rules import TRIM_TAG


def drop_senders(
    df: DataFrame, senders: DataFrame, column: str = "from", max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows whose sender is not exactly one of ``senders(token)``.

    A null sender is kept.  Up to ``max_rows`` senders go to every task.  Of
    more a bit filter goes out, with the senders that it marks without being
    listed, which are found on this column alone: the rows stay where they are.
    """
    listed = senders.select(F.col("token").alias("__key")).dropna().distinct()
    listed, rows, size = stored(listed)
    is_listed = F.col(column) == F.col("__key")
    if rows <= max_rows and size <= MAX_BROADCAST_BYTES:
        return df.join(F.broadcast(listed), is_listed, "left_anti")
    if df.select(column).schema[0].dataType != listed.schema[0].dataType:
        return df.join(listed, is_listed, "left_anti")
    others = marked(df.select(column).distinct(), column, listed).filter("__again").join(listed, is_listed, "left_anti")
    others, rows, size = stored(others.select(F.col(column).alias("__other")))
    if rows > max_rows or size > MAX_BROADCAST_BYTES:
        return df.join(listed, is_listed, "left_anti")
    found = marked(df, column, listed).join(F.broadcast(others), F.col(column) == F.col("__other"), "left")
    return found.filter(~F.col("__again") | F.col("__other").isNotNull()).select(*[F.col(f"`{c}`") for c in df.columns])


def drop_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` is none of a short list; null is kept."""
    return df.filter(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def drop_subjects(
    df: DataFrame, column: str = "subject", subjects: Sequence[str] = EXCLUDED_SUBJECTS
) -> DataFrame:
    """Drop web-form notices by their exact subject."""
    return drop_values(df, column, subjects)


def keep_listed(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Rows whose ``column`` is one of ``allowed(token)``."""
    listed = allowed.select(F.col("token").alias("__allowed"))
    return df.join(listed, F.col(column) == F.col("__allowed"), "left_semi")


def keep_manual(df: DataFrame, column: str = "autoclass") -> DataFrame:
    """Documents that were not classified automatically."""
    return df.filter(~F.col(column))


def keep_complete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without a null in the named columns."""
    return df.dropna(subset=list(columns))


def drop_failed(df: DataFrame, column: str = "body_clean") -> DataFrame:
    """Rows that were masked; the text is masked once, not again by the filter."""
    df = df.withColumn(column, evaluated_once(F.col(column)))
    return df.filter(~is_failed(column))


def is_failed(column: str = "body_clean") -> Column:
    """Whether masking failed."""
    return F.contains(F.col(column), F.lit(FAILED_TEXT))


def is_trimmed(column: str = "body_clean") -> Column:
    """Whether a quoted reply was cut off."""
    return F.contains(F.col(column), F.lit(TRIM_TAG))


def keep_trimmed(df: DataFrame, column: str = "body_clean") -> DataFrame:
    """Rows whose quoted reply was cut off; the text is cleaned once."""
    df = df.withColumn(column, evaluated_once(F.col(column)))
    return df.filter(is_trimmed(column))


def contains_any(col: Column, values: Sequence[str]) -> Column:
    """Whether the text holds any of a short list of substrings."""
    return reduce(Column.__or__, (F.contains(col, F.lit(v)) for v in values))


def sender_class(
    sender: Column, company_domains: Sequence[str],
    private_domains: Sequence[str] = PRIVATE_DOMAINS,
) -> Column:
    """``company``, ``private`` or ``other`` by domains in the sender."""
    lower = F.lower(sender)
    return (
        F.when(contains_any(lower, company_domains), "company")
        .when(contains_any(lower, private_domains), "private")
        .otherwise("other")
    )
