"""Lookups whose size decides how they reach the tasks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.session import new_folder

#: largest lookup, in rows, that is copied to every task
MAX_BROADCAST_ROWS = 1_000_000
#: largest lookup, in bytes by Spark's own estimate, of which any row reaches the driver
MAX_BROADCAST_BYTES = 256 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Size of the result as the optimizer estimates it; runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def stored(df: DataFrame, name: str = "lookup") -> tuple[DataFrame, int, int]:
    """``df`` written to the shared folder and read back, its rows, and the bytes of its values as texts."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    rows, size = df.agg(F.count("*"), F.sum(sum(texts[1:], texts[0]).cast("long"))).first()
    return df, rows, size or 0


def collect_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int | None = MAX_BROADCAST_BYTES
) -> pa.Table | None:
    """The rows of ``df`` if there are at most ``max_rows``, else ``None``.

    At most ``max_rows + 1`` rows reach the driver.  The estimate, which is far
    too large behind an aggregate or a join, only tells whether the table is
    written first: then its rows and bytes are counted, and if they are too
    many, no row reaches the driver.  With ``None`` bytes are not asked for.
    """
    if max_rows <= 0:
        return None
    if max_bytes is not None and estimated_bytes(df) > max_bytes:
        df, rows, size = stored(df)
        if rows > max_rows or size > max_bytes:
            return None
    table = df.limit(max_rows + 1).toArrow()
    return table if table.num_rows <= max_rows else None


def with_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """``df`` written to the shared folder and read back, with a narrow id for every row.

    The ids are part of the written table, so they stay the same however often
    and wherever it is read; null and repeated keys do not matter.
    """
    path = new_folder(df.sparkSession, "rows")
    numbered = df.withColumn(name, F.monotonically_increasing_id())
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def lookup_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct upper-cased non-null values of one column, as ``token``."""
    return (
        df.select(F.upper(F.col(column)).alias("token"))
        .filter(F.col("token").isNotNull())
        .distinct()
    )
