"""Columns derived from mail headers and attachment lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsieve.functions.charset import decode_body
from postsieve.functions.rewrite import bind

#: attachment count of mails whose attachments were not read
NOT_READ = 999
#: part of every generated attachment name
GENERATED_NAME = "msg-part"
#: charset of mails that declare none
UNKNOWN_ENCODING = "unknown"


# Names of the header fields that are kept.
HEADER_NAMES = {
    "to": "To", "from": "From", "cc": "Cc", "bcc": "Bcc", "sub": "Subject", "date_raw": "Date",
    "ctype": "Content-Type", "cte": "Content-Transfer-Encoding", "umid": "Message-ID",
}
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_DATE = (
    r"(?i)^\s*(?:[a-z]+\s*,\s*)?(\d{1,2})\s+(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+(\d{4})"
    r"\s+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s|$)"
)


def header_block(content: Column) -> Column:
    """The header lines of a raw message, up to its first empty line; UTF-8, else ISO-8859-1."""
    text = content.cast("string")
    text = F.when(F.is_valid_utf8(text), text).otherwise(F.decode(content, "iso-8859-1"))

    def before(text: Column) -> Column:
        ends = [F.nullif(F.locate(end, text), F.lit(0)) for end in ("\n\n", "\r\n\r\n")]
        end = F.when(F.regexp_like(F.substring(text, 1, 2), F.lit(r"^\r?\n")), F.lit(1)).otherwise(F.least(*ends))
        return F.when(end.isNull(), text).otherwise(F.substring(text, F.lit(1), end - 1))

    return bind(text, before)


def header_value(block: Column, name: str) -> Column:
    """Value of the first header of a name, folded lines included; null if there is none."""
    pattern = rf"(?dim)^{name}:[ \t]*([^\r\n]*(?:\r?\n[ \t][^\r\n]*)*)"
    return F.get(F.regexp_extract_all(block, F.lit(pattern), F.lit(1)), F.lit(0))


def header_columns(block: Column) -> dict[str, Column]:
    """The kept header fields of a header block."""
    return {name: header_value(block, title) for name, title in HEADER_NAMES.items()}


def sent_time(date_raw: Column) -> Column:
    """The sender's own clock of a date in the form of RFC 2822, the offset dropped; null for other forms."""
    def part(n: int) -> Column:
        return F.regexp_extract(date_raw, _DATE, n)

    month = ((F.instr(F.lit(_MONTHS), F.lower(part(2))) + 2) / 3).cast("int")
    clock = F.concat(
        part(3), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(part(1), 2, "0"), F.lit(" "),
        F.lpad(part(4), 2, "0"), F.lit(":"), part(5), F.lit(":"), F.coalesce(F.nullif(part(6), F.lit("")), F.lit("00")))
    return F.when(date_raw.rlike(_DATE), F.try_to_timestamp(clock, F.lit("yyyy-MM-dd HH:mm:ss")))


def format_date(timestamp: Column) -> Column:
    """``dd-mm-yyyy``."""
    return F.date_format(timestamp, "dd-MM-yyyy")


def format_time(timestamp: Column) -> Column:
    """``HH:MM:SS``."""
    return F.date_format(timestamp, "HH:mm:ss")


def sent_timestamp(date: Column, time: Column) -> Column:
    """The two text columns as one timestamp, null where unparsable."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit("dd-MM-yyyy HH:mm:ss"))


def message_id(date: Column, time: Column, subject_raw: Column) -> Column:
    """Date, time and length of the undecoded subject."""
    return F.concat_ws("_", date, time, F.length(subject_raw).cast("string"))


def specific_files(files: Column) -> Column:
    """Attachment names that the sender gave."""
    return F.filter(files, lambda name: ~F.contains(name, F.lit(GENERATED_NAME)))


def file_count(files: Column, attachments_read: bool = True) -> Column:
    """Number of attachments, or the marker value if they were not read."""
    return F.size(files) if attachments_read else F.lit(NOT_READ)


def known_encoding(encoding: Column) -> Column:
    """Declared charset, or the marker text."""
    return F.coalesce(encoding, F.lit(UNKNOWN_ENCODING))


# An encoded word: charset, B or Q, payload.
_WORD = r"=\?([^?\s]+)\?([bBqQ])\?([^?]*)\?="


def _quoted_bytes(payload: Column) -> Column:
    """Bytes of a Q payload: underscores are spaces, ``=XX`` is a byte."""
    units = F.regexp_extract_all(F.replace(payload, F.lit("_"), F.lit(" ")), F.lit("(=[0-9A-Fa-f]{2}|(?s:.))"), F.lit(1))
    digits = F.transform(units, lambda u: F.when(u.rlike("^=[0-9A-Fa-f]{2}$"), F.substring(u, 2, 2)).otherwise(
        F.hex(u.cast("binary"))))
    return F.unhex(F.array_join(digits, ""))


def decode_subject(subject: Column, first_only: bool = False) -> Column:
    """Subject with its encoded words decoded, plain parts in between unchanged.

    White space between two encoded words goes.  A word whose charset is
    unknown or whose payload is malformed stays as it is; malformed bytes go.
    ``first_only`` keeps the first fragment of a subject that begins encoded.
    """
    close = F.regexp_replace(subject, r"\?=\s+(?==\?[^?\s]+\?[bBqQ]\?[^?]*\?=)", "?=")
    pieces = F.regexp_extract_all(close, F.lit(rf"({_WORD}|(?s:.)+?(?={_WORD}|$))"), F.lit(1))

    def decoded(piece: Column) -> Column:
        charset, payload = F.regexp_extract(piece, _WORD, 1), F.regexp_extract(piece, _WORD, 3)
        data = F.when(F.lower(F.regexp_extract(piece, _WORD, 2)) == "b", F.try_to_binary(payload, F.lit("base64"))).otherwise(
            _quoted_bytes(payload))
        text = decode_body(data, charset, other_charsets=False)
        return F.when(piece.rlike(f"^{_WORD}$"), F.coalesce(text, piece)).otherwise(piece)

    encoded = F.transform(pieces, decoded)
    if first_only:
        encoded = F.when(subject.rlike(f"^{_WORD}"), F.slice(encoded, 1, 1)).otherwise(encoded)
    return F.when(subject.contains("=?"), F.array_join(encoded, "")).otherwise(subject)
