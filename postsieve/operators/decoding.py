"""Charset proposal and decoding of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.functions.charset import decode_body, propose_charset
from postsieve.functions.headers import UNKNOWN_ENCODING
from postsieve.functions.rewrite import evaluated_once


def with_proposal(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``encproposal``, ``encconf`` and ``language``."""
    return df.withColumn("__enc", propose_charset(F.col(body))).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("__enc.encoding").alias("encproposal"),
        F.col("__enc.confidence").alias("encconf"),
        F.col("__enc.language").alias("language"),
    )


def with_decoded_body(
    df: DataFrame, body: str = "body", out: str = "body_dc", other_charsets: bool = True
) -> DataFrame:
    """Decode by the declared charset, else the proposed one, else UTF-8.

    The result is null where no decoder fits.
    """
    declared = F.when(F.col("encoding") != UNKNOWN_ENCODING, F.col("encoding"))
    charset = F.coalesce(declared, F.col("encproposal"), F.lit("utf-8"))
    return df.withColumn(out, decode_body(F.col(body), charset, other_charsets))


def drop_undecoded(df: DataFrame, column: str = "body_dc") -> DataFrame:
    """Rows whose body was decoded; it is decoded once, not again by the filter below all joins."""
    df = df.withColumn(column, evaluated_once(F.col(column)))
    return df.filter(F.col(column).isNotNull())


def count_decoded(df: DataFrame, column: str = "body_dc") -> DataFrame:
    """Rows by whether their body was decoded."""
    return df.groupBy(F.col(column).isNotNull().alias("decoded")).agg(
        F.count("*").alias("n_rows")
    )


def charset_agreement(df: DataFrame) -> DataFrame:
    """Number of rows whose declared and proposed charsets agree."""
    return df.agg(
        F.count_if(F.upper("encoding") == F.upper("encproposal")).alias("agreeing"),
        F.count("*").alias("n_rows"),
    )
