"""Raw messages built from orders and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Context, query
from postsieve.functions import headers as H
from postsieve.session import spread
from postsieve.sources.messages import (
    header_fields,
    message_errors,
    parse_messages,
    read_headers,
    read_message_batch,
    to_container,
)

# one message per order: plain, multipart with attachments, nested multipart
_HEADERS = (
    "concat('From: kunde', cast(o_custkey as string), '@mail.example', '\n', 'To: service@bank.example', '\n', "
    "case when o_orderkey % 4 = 0 then concat('Cc: kopie@mail.example', '\n') else '' end, "
    "'Subject: ', case when o_orderkey % 5 = 0 then concat('=?utf-8?B?', base64(encode(concat('Grüße ', cast(o_orderkey as string)), 'UTF-8')), '?=') "
    "else concat('Vertrag ', cast(o_orderkey as string)) end, '\n', "
    "case when o_orderkey % 19 = 0 then '' else concat('Date: ', date_format(o_orderdate, 'EEE, dd MMM yyyy'), ' ', "
    "lpad(cast(o_orderkey % 24 as string), 2, '0'), ':', lpad(cast(o_orderkey % 60 as string), 2, '0'), ':07 +0200', '\n') end, "
    "'Message-ID: <', cast(o_orderkey as string), '@mail.example>', '\n')"
)
_TEXT = "concat('Inhalt ', cast(o_orderkey as string))"
_PLAIN = f"concat('Content-Type: text/plain; charset=utf-8', '\n', 'Content-Transfer-Encoding: 8bit', '\n', '\n', {_TEXT})"
_MIXED = (
    "concat('MIME-Version: 1.0', '\n', 'Content-Type: multipart/mixed; boundary=b1', '\n', '\n', '--b1', '\n', "
    f"'Content-Type: text/plain', '\n', '\n', {_TEXT}, '\n', '--b1', '\n', "
    "'Content-Type: application/pdf; name=vertrag.pdf', '\n', 'Content-Disposition: attachment; filename=vertrag.pdf', '\n', '\n', 'x', '\n', "
    "'--b1', '\n', 'Content-Type: application/octet-stream', '\n', '\n', 'y', '\n', '--b1--', '\n')"
)
_NESTED = (
    "concat('MIME-Version: 1.0', '\n', 'Content-Type: multipart/mixed; boundary=b1', '\n', '\n', '--b1', '\n', "
    "'Content-Type: multipart/alternative; boundary=b2', '\n', '\n', '--b2', '\n', "
    f"'Content-Type: text/plain', '\n', '\n', {_TEXT}, '\n', '--b2', '\n', 'Content-Type: text/html', '\n', '\n', '<p>x</p>', '\n', "
    "'--b2--', '\n', '--b1', '\n', 'Content-Type: image/png; name=bild.png', '\n', '\n', 'z', '\n', '--b1--', '\n')"
)
MESSAGE = (
    f"encode(concat({_HEADERS}, case o_orderkey % 3 when 0 then {_PLAIN} when 1 then {_MIXED} else {_NESTED} end), 'UTF-8')"
)


def raw_messages(ctx: Context):
    """(mid, content) with one message per order."""
    return spread(ctx("orders")).select(
        F.format_string("m%012d", "o_orderkey").alias("mid"), F.expr(MESSAGE).alias("content")
    )


_MID = "concat('m', lpad(cast(o_orderkey as string), 12, '0'))"
_DATE = "strftime(o_orderdate, '%d-%m-%Y')"
_TIME = "concat(lpad(cast(o_orderkey % 24 as string), 2, '0'), ':', lpad(cast(o_orderkey % 60 as string), 2, '0'), ':07')"
_RAW_SUBJECT = (
    "case when o_orderkey % 5 = 0 then concat('=?utf-8?B?', to_base64(encode(concat('Grüße ', cast(o_orderkey as string)))), '?=') "
    "else concat('Vertrag ', cast(o_orderkey as string)) end"
)
_SUBJECT = "concat(case when o_orderkey % 5 = 0 then 'Grüße ' else 'Vertrag ' end, cast(o_orderkey as string))"
_FILES = (
    "case o_orderkey % 3 when 0 then 'msg-part-00000001.txt' "
    "when 1 then 'msg-part-00000001.txt|vertrag.pdf|msg-part-00000003.bin' "
    "else 'msg-part-00000001.txt|msg-part-00000002.html|bild.png' end"
)
_GOOD = "from {orders} where o_orderkey % 19 <> 0"
_SPECIFIC = "case o_orderkey % 3 when 0 then '' when 1 then 'vertrag.pdf' else 'bild.png' end"


def _parsed(ctx: Context):
    return parse_messages(raw_messages(ctx))


@query(
    "s9_message_batch",
    f"select {_MID} as mid, case when o_orderkey % 5 = 0 then 'utf-8' else 'unknown' end as encoding, "
    f"{_DATE} as date, {_TIME} as time, {_SUBJECT} as subject, 999 as nbr_files, 0 as nbr_specfiles, "
    f"concat('Inhalt ', cast(o_orderkey as string)) as body {_GOOD}",
)
def s9(ctx: Context):
    container, _ = read_message_batch(raw_messages(ctx))
    return container.select(
        "mid", "encoding", "date", "time", "subject", "nbr_files", "nbr_specfiles",
        F.decode("body", "utf-8").alias("body"),
    )


@query(
    "s9_first_messages",
    f"select {_MID} as mid from (select * from {{orders}} order by o_orderkey limit 100) t where o_orderkey % 19 <> 0",
)
def s9_first(ctx: Context):
    container, _ = read_message_batch(raw_messages(ctx), nbr=100)
    return container.select("mid")


@query(
    "m1_header_fields",
    f"select {_MID} as mid, 'service@bank.example' as \"to\", concat('kunde', cast(o_custkey as string), '@mail.example') as \"from\", "
    f"case when o_orderkey % 4 = 0 then 'kopie@mail.example' end as cc, cast(null as string) as bcc, {_RAW_SUBJECT} as sub, "
    "concat(strftime(o_orderdate, '%a, %d %b %Y '), left(" + _TIME + ", 8), ' +0200') as date_raw, "
    f"{_DATE} as date, {_TIME} as time, case o_orderkey % 3 when 0 then 'text/plain; charset=utf-8' "
    "else 'multipart/mixed; boundary=b1' end as ctype, case o_orderkey % 3 when 0 then '8bit' end as cte, "
    f"concat('<', cast(o_orderkey as string), '@mail.example>') as umid {_GOOD}",
)
def m1(ctx: Context):
    return read_headers(raw_messages(ctx)).filter("date is not null")


@query(
    "m1_parsed_header_fields",
    f"select {_MID} as mid, {_RAW_SUBJECT} as sub, {_DATE} as date, {_TIME} as time {_GOOD}",
)
def m1_parsed(ctx: Context):
    return header_fields(_parsed(ctx).filter("error is null")).select("mid", "sub", "date", "time")


@query(
    "m2_format_dates",
    "select o_orderkey, strftime(o_orderdate, '%d-%m-%Y') as date, strftime(o_orderdate, '%H:%M:%S') as time from {orders}",
)
def m2(ctx: Context):
    sent = F.col("o_orderdate")
    return ctx("orders").select(
        "o_orderkey", H.format_date(sent).alias("date"), H.format_time(sent).alias("time")
    )


@query("m3_first_part", f"select {_MID} as mid, concat('Inhalt ', cast(o_orderkey as string)) as body {_GOOD}")
def m3(ctx: Context):
    return _parsed(ctx).filter("error is null").select("mid", F.decode("body", "utf-8").alias("body"))


@query("m4_attachment_names", f"select {_MID} as mid, {_FILES} as files {_GOOD}")
def m4(ctx: Context):
    good = _parsed(ctx).filter("error is null")
    return good.select("mid", F.array_join("files", "|").alias("files"))


@query("m5_specific_files", f"select {_MID} as mid, {_SPECIFIC} as specfiles {_GOOD}")
def m5(ctx: Context):
    return to_container(_parsed(ctx)).select("mid", F.array_join("specfiles", "|").alias("specfiles"))


@query(
    "m6_file_counts",
    f"select {_MID} as mid, case o_orderkey % 3 when 0 then 1 else 3 end as nbr_files, "
    f"case o_orderkey % 3 when 0 then 0 else 1 end as nbr_specfiles {_GOOD}",
)
def m6(ctx: Context):
    return to_container(_parsed(ctx)).select("mid", "nbr_files", "nbr_specfiles")


@query(
    "m7_message_id",
    f"select {_MID} as mid, concat({_DATE}, '_', {_TIME}, '_', cast(length({_RAW_SUBJECT}) as string)) as message_id {_GOOD}",
)
def m7(ctx: Context):
    return to_container(_parsed(ctx)).select("mid", "message_id")


@query("m8_decode_subject", f"select o_orderkey, {_SUBJECT} as subject from {{orders}}")
def m8(ctx: Context):
    raw = F.when(
        F.col("o_orderkey") % 5 == 0,
        F.concat(F.lit("=?utf-8?B?"), F.base64(F.encode(F.concat(
            F.lit("Grüße "), F.col("o_orderkey").cast("string")), "UTF-8")), F.lit("?=")),
    ).otherwise(F.concat(F.lit("Vertrag "), F.col("o_orderkey").cast("string")))
    return ctx("orders").select("o_orderkey", H.decode_subject(raw).alias("subject"))


@query("m10_message_errors", f"select {_MID} as mid from {{orders}} where o_orderkey % 19 = 0")
def m10(ctx: Context):
    return message_errors(_parsed(ctx)).select("mid")
