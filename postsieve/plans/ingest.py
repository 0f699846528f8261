"""Raw messages and XML archives to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.functions import headers as H
from postsieve.operators.archive import ARCHIVE_COLUMNS, field_nesting, parse_archives
from postsieve.schemas import MAIL_CONTAINER
from postsieve.session import new_folder
from postsieve.sources.files import scan_archives, scan_messages
from postsieve.sources.messages import read_message_batch


def ingest_messages(
    spark: SparkSession, root: str, nbr: int | str = "all", attachments: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Message files below ``root`` as container and error list."""
    return read_message_batch(scan_messages(spark, root), nbr, attachments)


def ingest_archives(
    spark: SparkSession, root: str, name: str = "Export.xml",
    wrappers: tuple[str, ...] | None = None, all_bodies: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Mail bodies of the archives below ``root``, and the archives that cannot be read.

    Elements that may enclose fields are named in ``wrappers``, or found by one
    pass over the files.  Every archive is then parsed once: what comes of it
    is written to the shared folder, and both results read that.
    """
    archives = scan_archives(spark, root, name)
    nesting = field_nesting(archives) if wrappers is None else wrappers
    parsed = parse_archives(archives.withColumn("file", F.struct("file", "error")), wrappers=nesting, all_bodies=all_bodies)
    path = new_folder(spark, "archives")
    parsed.select("file.file", "file.error", *parsed.columns[1:]).write.parquet(path)
    written = spark.read.parquet(path)
    error = F.coalesce("error", F.when(F.col("broken"), "not well-formed"))
    return (
        written.filter("has_body").select("file", *ARCHIVE_COLUMNS),
        written.select(F.col("file").alias("path"), error.alias("error")).filter("error is not null"),
    )


def archive_container(mails: DataFrame, received_format: str, key: str = "file") -> DataFrame:
    """Mail bodies of archives as a mail container, for the mail build.

    The archive's key becomes the mail's id, and orders the load; date and time
    come from the time of receipt, null where it does not have the format.
    Attachments are not read.  The container is written to the shared folder,
    as the mail build reads it several times: every archive is parsed once.
    """
    received = F.try_to_timestamp("received", F.lit(received_format))
    known = {
        "mid": F.col(key).cast("string"), "encoding": F.lit("utf-8"), "type": F.col("doc_type"),
        "date": H.format_date(received), "time": H.format_time(received), "from": F.col("from"),
        "subject": F.col("subject"), "body": F.encode("body", "utf-8"), "nbr_files": F.lit(H.NOT_READ),
        "files": F.array().cast("array<string>"), "specfiles": F.array().cast("array<string>"),
        "nbr_specfiles": F.lit(0),
    }
    known["message_id"] = H.message_id(known["date"], known["time"], F.col("subject"))
    container = mails.select(*[
        known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name) for field in MAIL_CONTAINER])
    path = new_folder(mails.sparkSession, "archives")
    container.write.parquet(path)
    return mails.sparkSession.read.schema(container.schema).parquet(path)
