"""Joins, anti joins, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Context, query
from postsieve.functions.index_string import parse_positions
from postsieve.operators import filters, joins, lexicon
from postsieve.operators.profiling import step_report
from postsieve.rules.domains import EXCLUDED_SUBJECTS, PRIVATE_DOMAINS

_JOIN = (
    "select coalesce(i.doc_key, b.doc_key) as doc_key, length(i.indexstring) as index_chars, "
    "length(b.rawbody) as body_chars from {{fx_index}} i {how} join {{fx_body}} b on i.doc_key = b.doc_key"
)


def _aligned(ctx: Context, complete: bool):
    # only the lengths are asked for: no text goes through the join
    index = ctx("fx_index").select("doc_key", F.length("indexstring").alias("index_chars"))
    body = ctx("fx_body").select("doc_key", F.length("rawbody").alias("body_chars"))
    return joins.align_index_and_body(index, body, complete=complete).select("doc_key", "index_chars", "body_chars")


@query("j1_index_and_body_full", _JOIN.format(how="full"))
def j1(ctx: Context):
    return _aligned(ctx, complete=False)


@query("j2_index_and_body_complete", _JOIN.format(how="inner"))
def j2(ctx: Context):
    return _aligned(ctx, complete=True)


@query(
    "j1_last_file_wins",
    "select l_orderkey as doc_key, max(cast(l_linenumber * 1000000 + l_partkey as bigint)) as place from {lineitem} group by l_orderkey",
)
def j1_last(ctx: Context):
    files = ctx("lineitem").select(
        F.col("l_orderkey").alias("doc_key"),
        (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("place"),
    )
    return joins.last_per_key(files, "doc_key", "place")


_BATCH = "100000 + o_orderkey % 90000"


def _with_report(ctx: Context):
    docs = parse_positions(ctx("fx_index").withColumn(
        "indexstring", F.replace("indexstring", F.lit("﻿"), F.lit("")))).select("doc_key", "batchid")
    return joins.with_report(docs, ctx("fx_report"))


@query(
    "j3_with_report",
    "select lpad(cast(o_orderkey as string), 8, '0') as doc_key, "
    f"{_BATCH} as batchid, stapel_id, automatisch_klassifiziert, status "
    f"from {{orders}} left join {{fx_report}} on {_BATCH} = stapel_id",
)
def j3(ctx: Context):
    return _with_report(ctx)


@query(
    "j4_matched",
    f"select count(*) as matched from {{orders}} join {{fx_report}} on {_BATCH} = stapel_id",
)
def j4(ctx: Context):
    return _with_report(ctx).agg(joins.matched().alias("matched"))


@query(
    "f2_report_not_classified",
    "select stapel_id, status from {fx_report} where automatisch_klassifiziert = 0",
)
def f2_report(ctx: Context):
    report = ctx("fx_report").filter(F.col("automatisch_klassifiziert") == 0)
    return report.select("stapel_id", "status")


_HIT_SENDERS = (
    "select row_seq from (select row_seq, unnest(string_split(replace(replace(sender, '<', ' '), '>', ' '), ' ')) as tok "
    "from {fx_mail}) t where upper(tok) in (select upper(token) from {fx_blocklist})"
)


def _blocklist(ctx: Context):
    from postsieve.operators.lookup import lookup_values

    return lookup_values(ctx("fx_blocklist"), "token")


@query(
    "j5_blocklist_sender",
    f"select row_seq, sender from {{fx_mail}} where row_seq not in ({_HIT_SENDERS})",
)
def j5_sender(ctx: Context):
    mails = ctx("fx_mail").select("row_seq", "sender")
    return lexicon.drop_listed(mails, "sender", _blocklist(ctx), "row_seq")


@query(
    "j5_blocklist_sender_joined",
    f"select row_seq, sender from {{fx_mail}} where row_seq not in ({_HIT_SENDERS})",
)
def j5_sender_joined(ctx: Context):
    mails = ctx("fx_mail").select("row_seq", "sender")
    return lexicon.drop_listed(mails, "sender", _blocklist(ctx), "row_seq", max_rows=0)


@query(
    "j5_blocklist_report",
    "select 'blocklist' as step, rows_before, hits, rows_before - hits as rows_after, "
    "round_even(hits / rows_before, 3) as share from (select count(*) as rows_before, "
    f"count(*) filter (where row_seq in ({_HIT_SENDERS})) as hits from {{fx_mail}}) t",
)
def j5_report(ctx: Context):
    mails = ctx("fx_mail").select("row_seq", "sender")
    flagged = lexicon.flag_listed(mails, "sender", _blocklist(ctx), "row_seq")
    return step_report(flagged, "blocklist", F.col("blocked"))


def _text_hits() -> str:
    from checks.sql import tokens

    return (
        f"select doc_id from (select doc_id, unnest({tokens('text')}) as tok from {{fx_documents}}) t "
        "where upper(tok) in (select upper(token) from {fx_blocklist})"
    )


@query("j5_blocklist_text", f"select doc_id from {{fx_documents}} where doc_id not in ({_text_hits()})")
def j5_text(ctx: Context):
    docs = ctx("fx_documents").select("doc_id", "text")
    return lexicon.drop_listed(docs, "text", _blocklist(ctx), "doc_id").select("doc_id")


@query(
    "j6_drop_senders",
    "select row_seq, sender from {fx_mail} where sender is null or sender not in (select token from {fx_senders})",
)
def j6(ctx: Context):
    mails = ctx("fx_mail").select("row_seq", "sender")
    return filters.drop_senders(mails, ctx("fx_senders"), "sender")


@query(
    "j7_allowed_types",
    "select o_orderkey, concat('Typ', cast(o_custkey % 25 as string)) as doctype from {orders} "
    "where concat('Typ', cast(o_custkey % 25 as string)) in (select token from {fx_allowed})",
)
def j7(ctx: Context):
    docs = ctx("orders").select(
        "o_orderkey", F.concat(F.lit("Typ"), (F.col("o_custkey") % 25).cast("string")).alias("doctype")
    )
    return filters.keep_listed(docs, "doctype", ctx("fx_allowed"))


_SUBJECTS = ", ".join(f"'{s}'" for s in EXCLUDED_SUBJECTS)


@query(
    "f1_drop_subjects",
    f"select row_seq, subject from {{fx_mail}} where subject is null or subject not in ({_SUBJECTS})",
)
def f1(ctx: Context):
    return filters.drop_subjects(ctx("fx_mail").select("row_seq", "subject"))


@query(
    "f3_keep_complete",
    "select row_seq from {fx_mail} where sender is not null and subject is not null and message_id is not null",
)
def f3(ctx: Context):
    mails = ctx("fx_mail").select("row_seq", "sender", "subject", "message_id")
    return filters.keep_complete(mails, "sender", "subject", "message_id").select("row_seq")


_COMPANY = ("bank.example", "partner.bank.example")


@query(
    "f5_sender_class",
    "select row_seq, case when "
    + " or ".join(f"contains(lower(sender), '{d}')" for d in _COMPANY) + " then 'company' when "
    + " or ".join(f"contains(lower(sender), '{d}')" for d in PRIVATE_DOMAINS)
    + " then 'private' else 'other' end as class from {fx_mail}",
)
def f5(ctx: Context):
    return ctx("fx_mail").select(
        "row_seq", filters.sender_class(F.col("sender"), _COMPANY).alias("class")
    )


@query(
    "f6_sender_contains",
    "select count(*) as n_rows from {fx_mail} where contains(sender, 'service@bank.example')",
)
def f6(ctx: Context):
    found = filters.contains_any(F.col("sender"), ["service@bank.example"])
    return ctx("fx_mail").filter(found).agg(F.count("*").alias("n_rows"))
