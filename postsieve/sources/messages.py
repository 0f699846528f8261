"""Raw messages (RFC 822 bytes) to mail containers.

Headers and the usual form of dates are read by column expressions.  MIME
structure, and dates of any other form, cannot be expressed with columns, so
the messages of an Arrow batch are parsed in Python; everything that follows
from the parsed fields is a column expression again.
"""

from __future__ import annotations

import email
import mimetypes
from email.header import decode_header, make_header
from email.message import Message

import pyarrow as pa
from dateutil import parser as date_parser
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.functions import headers as H
from postsieve.functions.headers import GENERATED_NAME
from postsieve.functions.rewrite import evaluated_once
from postsieve.schemas import HEADER, MAIL_CONTAINER
from postsieve.session import new_folder

_MIME = "struct<sent:string,encoding:string,subject:string,body:binary,files:array<string>,error:string>"
_MIME_ARROW = pa.struct([
    ("sent", pa.string()), ("encoding", pa.string()), ("subject", pa.string()), ("body", pa.binary()),
    ("files", pa.list_(pa.string())), ("error", pa.string())])


def _first_part(message: Message) -> bytes | None:
    while message.is_multipart():
        message = message.get_payload(0)
    return message.get_payload(decode=True)


def _extension(kind: str) -> str:
    """HTML and other text by rule, everything else by the system's guess."""
    group, _, subtype = kind.partition("/")
    if "html" in subtype:
        return ".html"
    return ".txt" if "text" in (group, subtype) else mimetypes.guess_extension(kind) or ".bin"


def _part_name(part: Message, number: int) -> str:
    name = part.get_filename()
    if name:
        return name
    kind = part.get_content_type()
    return f"{GENERATED_NAME}-{number:08d}{_extension(kind)}"


def _attachment_names(message: Message) -> list[str]:
    parts = (p for p in message.walk() if p.get_content_maintype() != "multipart")
    return [_part_name(part, number) for number, part in enumerate(parts, start=1)]


def _parse(content: bytes, sent_known: bool, attachments: bool) -> dict:
    message = email.message_from_bytes(content)
    fragments = decode_header(message["subject"])
    subject = str(make_header([
        (text.decode("ascii", "replace"), None) if isinstance(text, bytes) and not charset else (text, charset)
        for text, charset in fragments
    ]))
    # the sender's own clock: the offset is dropped, not converted
    sent = None if sent_known else date_parser.parse(message["date"]).replace(tzinfo=None)
    return {
        "sent": sent and sent.strftime("%Y-%m-%d %H:%M:%S"), "encoding": fragments[0][1], "subject": subject,
        "body": _first_part(message), "files": _attachment_names(message) if attachments else [],
    }


def _mime(attachments: bool):
    """Arrow function: subject, first part and attachment names of messages, or why there are none."""

    @F.arrow_udf(_MIME)
    def parse(contents: pa.Array, sent_known: pa.Array) -> pa.Array:
        rows = []
        for content, known in zip(contents.to_pylist(), sent_known.to_pylist(), strict=True):
            try:
                rows.append(_parse(bytes(content), known, attachments))
            except Exception as error:  # noqa: BLE001 - listed, not fatal
                rows.append({"error": f"{type(error).__name__}: {error}"})
        return pa.array(rows, _MIME_ARROW)

    return parse


def read_headers(messages: DataFrame) -> DataFrame:
    """The eleven header fields of (mid, content), by column expressions alone.

    Date and time are null where the date has not the form of RFC 2822.
    """
    fields = messages.select("mid", H.header_block(F.col("content")).alias("__head"))
    found = fields.select("mid", *[c.alias(name) for name, c in H.header_columns(F.col("__head")).items()])
    sent = H.sent_time(F.col("date_raw"))
    return found.withColumns({"date": H.format_date(sent), "time": H.format_time(sent)}).select(
        "mid", *[F.col(f"`{f.name}`") for f in HEADER])


def parse_messages(messages: DataFrame, attachments: bool = True) -> DataFrame:
    """(mid, content) to header and parsed fields plus ``error``, one row per message."""
    headed = messages.select("mid", "content", H.header_block(F.col("content")).alias("__head"))
    headed = headed.select("mid", "content", *[c.alias(name) for name, c in H.header_columns(F.col("__head")).items()])
    headed = headed.withColumn("__sent", H.sent_time(F.col("date_raw")))
    # a filter on the error must not parse every message a second time
    mime = evaluated_once(_mime(attachments)(F.col("content"), F.col("__sent").isNotNull()))
    parsed = headed.withColumn("__mime", mime)
    sent = F.coalesce("__sent", F.try_to_timestamp("__mime.sent", F.lit("yyyy-MM-dd HH:mm:ss")))
    return parsed.withColumns({"date": H.format_date(sent), "time": H.format_time(sent)}).select(
        "mid", *[F.col(f"`{f.name}`") for f in HEADER],
        *[F.col(f"__mime.{name}").alias(name) for name in ("encoding", "subject", "body", "files", "error")])


def header_fields(parsed: DataFrame) -> DataFrame:
    """The eleven header fields of each parsed message."""
    return parsed.select("mid", *[F.col(f"`{f.name}`") for f in HEADER])


def message_errors(parsed: DataFrame) -> DataFrame:
    """Messages that could not be parsed."""
    return parsed.filter(F.col("error").isNotNull()).select("mid", "error")


def to_container(parsed: DataFrame, attachments: bool = True) -> DataFrame:
    """Parsed messages without errors as a mail container."""
    files = F.col("files")
    specific = H.specific_files(files)
    good = parsed.filter(F.col("error").isNull())
    return good.select(
        "mid",
        H.known_encoding(F.col("encoding")).alias("encoding"),
        F.col("ctype").alias("type"),
        "date", "time", "from", "to", "cc", "subject", "body",
        H.file_count(files, attachments).cast("int").alias("nbr_files"),
        "files",
        H.message_id(F.col("date"), F.col("time"), F.col("sub")).alias("message_id"),
        F.current_timestamp().alias("tmstmp"),
        "cte", "umid",
        specific.alias("specfiles"),
        F.size(specific).alias("nbr_specfiles"),
    ).select(*[f"`{name}`" for name in MAIL_CONTAINER.names])


def read_message_batch(
    messages: DataFrame, nbr: int | str = "all", attachments: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Container and error list of the first ``nbr`` messages by id, or of all.

    The ids are sorted alone; contents are read for the chosen ids only.  Every
    message is parsed once: what comes of it is written to the shared folder,
    and both results read that.
    """
    if nbr != "all":
        chosen = messages.select("mid").orderBy("mid").limit(int(nbr))
        messages = messages.join(chosen, "mid", "left_semi")
    spark, path = messages.sparkSession, new_folder(messages.sparkSession, "messages")
    parsed = parse_messages(messages, attachments)
    parsed.write.parquet(path)
    parsed = spark.read.schema(parsed.schema).parquet(path)
    return to_container(parsed, attachments), message_errors(parsed)
