"""Readers of containers, reports and lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.operators.lookup import lookup_values
from postsieve.operators.ordering import number_rows, running_total
from postsieve.schemas import MAIL_CONTAINER


def load_containers(
    spark: SparkSession, root: str, glob: str = "*.parquet", first: str | None = None,
    schema: T.StructType = MAIL_CONTAINER,
) -> DataFrame:
    """All container files below ``root`` in one scan, with their load order.

    ``file_seq`` sorts files by name, the file named ``first`` in front;
    ``row_seq`` is the position in the file.  The given schema fills columns
    an early file lacks with nulls, so no footers are merged.
    """
    files = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .parquet(root)
    )
    name = F.col("_metadata.file_name")
    return files.select(
        "*", F.col("_metadata.file_path").alias("path"), name.alias("file_name"), file_sequence(name, first).alias("file_seq"),
        F.col("_metadata.row_index").alias("row_seq"),
    )


def file_sequence(name: Column, first: str | None = None) -> Column:
    """Sort key of a container file."""
    ahead = F.lit(False) if first is None else name == F.lit(first)
    return F.concat(F.when(ahead, "0").otherwise("1"), name)


def load_counts(container: DataFrame, order: str = "file_seq") -> DataFrame:
    """Each file in load order: its dense number from 0, rows and running total of rows.

    ``order`` is any sort key of the files, such as the loader's own.
    """
    counts = container.groupBy(order).agg(F.count("*").alias("added"))
    return number_rows(running_total(counts, order, "added"), F.col(order), out="file_nr")


# Characters of a header name that are replaced or dropped.
_NAME_CHARACTERS = str.maketrans({" ": "_", "\u00a0": None})


def normalize_names(df: DataFrame) -> DataFrame:
    """Upper-case header names without outer white space (no-break spaces included);
    inner spaces become underscores, inner no-break spaces go."""
    names = (name.strip().translate(_NAME_CHARACTERS) for name in df.columns)
    return df.toDF(*(name.upper() for name in names))


def read_report(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    sep: str = ";",
) -> DataFrame:
    """A delimited report with normalised header names.

    All columns are text unless ``schema`` types them.  Its names are matched
    with the header's, whatever the order of the file; a name the header lacks
    is an error, columns the schema lacks are left out.
    """
    report = normalize_names(spark.read.option("sep", sep).option("header", True).csv(path))
    if schema is None:
        return report
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    missing = [f.name for f in fields if f.name.upper() not in report.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return report.select(*[F.col(f"`{f.name.upper()}`").cast(f.dataType).alias(f.name.upper()) for f in fields])


def load_blocklist(spark: SparkSession, path: str, column: str = "kommunikation") -> DataFrame:
    """The blocklist table as distinct upper-cased ``token``."""
    return lookup_values(spark.read.parquet(path), column)
