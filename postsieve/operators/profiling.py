"""Counts, describes and step reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postsieve.functions.tokens import word_count

#: percentiles of page counts per type
PAGE_PERCENTILES = (0.5, 0.8, 0.9, 0.95, 0.99)
#: percentiles of text lengths
CHAR_PERCENTILES = (0.5, 0.8, 0.9, 0.92, 0.95, 0.98, 0.99)
#: percentiles of word counts
WORD_PERCENTILES = (0.5, 0.8, 0.9, 0.95, 0.99)


def _describe(value: Column, percentiles: Sequence[float]) -> list[Column]:
    # exact percentiles of integers: the partial aggregates hold one counter
    # per distinct value, whatever the number of rows
    quantiles = F.percentile(value, F.array(*[F.lit(p) for p in percentiles]))
    return [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        quantiles.alias("__quantiles"),
        F.max(value).alias("max"),
    ]


def _spread(df: DataFrame, percentiles: Sequence[float]) -> DataFrame:
    columns = []
    for name in df.columns:
        if name == "__quantiles":
            columns += [
                F.col(name)[i].alias(f"p{round(p * 100)}") for i, p in enumerate(percentiles)
            ]
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def describe_by(
    df: DataFrame, key: str, value: str, percentiles: Sequence[float] = PAGE_PERCENTILES
) -> DataFrame:
    """Count, mean, standard deviation, extremes and percentiles per key."""
    return _spread(df.groupBy(key).agg(*_describe(F.col(value), percentiles)), percentiles)


def describe(df: DataFrame, value: Column, percentiles: Sequence[float]) -> DataFrame:
    """The same over the whole table, for one integer expression."""
    return _spread(
        df.select(value.alias("__value")).agg(*_describe(F.col("__value"), percentiles)),
        percentiles,
    )


def describe_chars(
    df: DataFrame, column: str, percentiles: Sequence[float] = CHAR_PERCENTILES
) -> DataFrame:
    """Describe text lengths in characters."""
    return describe(df, F.length(column), percentiles)


def describe_words(
    df: DataFrame, column: str, percentiles: Sequence[float] = WORD_PERCENTILES
) -> DataFrame:
    """Describe text lengths in words."""
    return describe(df, word_count(F.col(column)), percentiles)


def pages_by_type(
    df: DataFrame, key: str = "doctype", pages: str = "pagecount", top: int | None = None
) -> DataFrame:
    """Documents and pages per type, most pages first.

    The page total is the truncated product of mean and count; mean and
    deviation are rounded half to even.
    """
    grouped = df.groupBy(key).agg(
        F.count(pages).alias("count"), F.avg(pages).alias("__mean"),
        F.stddev_samp(pages).alias("__std"),
    )
    out = grouped.select(
        key, "count", F.bround("__mean", 1).alias("mean"), F.bround("__std", 1).alias("std"),
        (F.col("__mean") * F.col("count")).cast("bigint").alias("pcount"),
    )
    return out if top is None else out.orderBy(F.desc("pcount"), F.asc(key)).limit(top)


def value_counts(df: DataFrame, column: str, nulls: bool = False) -> DataFrame:
    """Rows per value; nulls count only with ``nulls``."""
    if not nulls:
        df = df.filter(F.col(column).isNotNull())
    return df.groupBy(column).agg(F.count("*").alias("count"))


def value_shares(df: DataFrame, column: str, digits: int = 3) -> DataFrame:
    """Share of each value among the non-null ones.

    The total is a scalar subquery over the counts, not an unpartitioned
    window, so the values never gather in one task.
    """
    counts = value_counts(df, column)
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.select(column, F.bround(F.col("count") / total, digits).alias("share"))


def distinct_count(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-null values of each column."""
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values, null included."""
    return df.select(column).distinct()


def volume(df: DataFrame, pages: str = "pagecount") -> DataFrame:
    """Documents and pages of a table."""
    return df.agg(F.count("*").alias("documents"), F.sum(pages).alias("pages"))


def mean_lengths(df: DataFrame, *columns: str) -> DataFrame:
    """Mean characters and words of each column."""
    return df.agg(*[
        aggregate
        for c in columns
        for aggregate in (
            F.avg(F.length(c)).alias(f"{c}_chars"),
            F.avg(word_count(F.col(c))).alias(f"{c}_words"),
        )
    ])


def table_profile(df: DataFrame) -> DataFrame:
    """Type and non-null count of each column, in one pass over the table."""
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}")
                       for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column_name"),
            F.lit(dtype).alias("data_type"), F.col(f"c{i}").alias("non_null"),
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ])
    return counted.select(F.inline(rows))


def step_report(df: DataFrame, step: str, hit: Column) -> DataFrame:
    """Rows before a filter, hits, rows left and share of hits."""
    return df.agg(
        F.count("*").alias("rows_before"), F.count_if(hit).alias("hits"),
    ).select(
        F.lit(step).alias("step"), "rows_before", "hits",
        (F.col("rows_before") - F.col("hits")).alias("rows_after"),
        F.bround(F.col("hits") / F.col("rows_before"), 3).alias("share"),
    )


class StepReport:
    """Rows after each step of a build, counted while its result runs.

    The counts belong to the first action on the result; asking for them before
    that waits for it.  A stage that runs again because its output was lost
    counts its rows again.
    """

    def __init__(self):
        self._steps: list[tuple[str, Observation]] = []
        self._apart: list[DataFrame] = []

    def count(self, df: DataFrame, step: str) -> DataFrame:
        """``df`` with its rows counted as ``step``."""
        seen = Observation()
        self._steps.append((step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def count_apart(self, df: DataFrame) -> None:
        """Run ``df``, with steps of its own, when the counts are asked for.

        For narrow rows whose steps the result takes otherwise.
        """
        self._apart.append(df)

    def rows(self) -> list[tuple[int, str, int]]:
        """Number, name and rows of every step."""
        while self._apart:
            self._apart.pop().write.format("noop").mode("overwrite").save()
        return [(number, step, seen.get["rows"]) for number, (step, seen) in enumerate(self._steps, 1)]

    def table(self, spark: SparkSession) -> DataFrame:
        """The same as a table, with the share of the first step's rows that is left."""
        counted = spark.createDataFrame(self.rows(), "step_nr int, step string, n_rows bigint")
        first = F.lit(self.rows()[0][2] if self._steps else None).cast("double")
        return counted.withColumn("share", F.bround(F.col("n_rows") / F.nullif(first, F.lit(0.0)), 3))
