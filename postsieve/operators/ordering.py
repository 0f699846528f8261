"""Top and bottom rows, slices, samples, running totals, point lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsieve.session import shared_folder

def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of an order; each task keeps ``n`` rows at most."""
    return df.orderBy(*order).limit(n)


def number_rows(df: DataFrame, *order: Column, out: str = "row_nr") -> DataFrame:
    """Zero-based position of every row in a total order, without one big sort.

    Rows are range-partitioned and checkpointed, so that the partition sizes
    and the numbered rows come from the same data even if executors are lost.
    Only one row per partition goes through a single task.
    """
    shared_folder(df.sparkSession)
    parts = (
        df.repartitionByRange(*order)
        .withColumn("__part", F.spark_partition_id())
        .checkpoint()
    )
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return (
        parts.withColumn("__within", within)
        .join(offsets, "__part")
        .withColumn(out, F.col("__offset") + F.col("__within"))
        .drop("__part", "__within", "__offset")
    )


def slice_rows(df: DataFrame, start: int, stop: int, *order: Column) -> DataFrame:
    """Rows ``start`` to ``stop`` of a total order, end excluded."""
    numbered = number_rows(df, *order, out="__nr")
    return numbered.filter(F.col("__nr").between(start, stop - 1)).drop("__nr")


def sample_rows(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their key.

    The same on every run and for every partitioning.
    """
    rank = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(rank, F.col(key)).limit(n)


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows with one key; the predicate reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def running_total(
    df: DataFrame, order: str, value: str, out: str = "total", block: int = 10_000
) -> DataFrame:
    """Sum of ``value`` over all rows whose ``order`` is not larger, for any sortable ``order``.

    Values of equal ``order`` are added first.  The sums are range-partitioned
    into as many parts as their number asks for, about ``block`` in each, so a
    sparse order (time stamps, names) makes no large part; one row per part goes
    through a single task.
    """
    shared_folder(df.sparkSession)
    sums = df.groupBy(F.col(order).alias("__order")).agg(F.sum(value).alias("__sum")).checkpoint()
    n_parts = max(1, -(-sums.count() // block))
    parts = (
        sums.repartitionByRange(n_parts, "__order")
        .withColumn("__part", F.spark_partition_id())
        .checkpoint()
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        parts.groupBy("__part").agg(F.sum("__sum").alias("__all"))
        .select("__part", F.coalesce(F.sum("__all").over(before), F.lit(0)).alias("__base"))
    )
    upto = Window.partitionBy("__part").orderBy("__order")
    totals = parts.withColumn("__upto", F.sum("__sum").over(upto)).join(bases, "__part").select(
        "__order", (F.col("__base") + F.coalesce("__upto", F.lit(0))).alias(out))
    return df.join(totals, F.col(order).eqNullSafe(F.col("__order"))).drop("__order")
