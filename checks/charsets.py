"""Charset proposal and decoding of derived bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Context, query
from postsieve.functions.headers import known_encoding
from postsieve.operators import decoding
from postsieve.plans.mail_corpus import undecoded_mails


def _bodies(ctx: Context):
    """Four variants: UTF-8, UTF-8 with a mark, Latin-1, UTF-8 with a bad byte."""
    text = F.col("text")
    utf8, latin = F.encode(text, "UTF-8"), F.encode(text, "ISO-8859-1")
    body = (
        F.when(F.col("variant") == 0, utf8)
        .when(F.col("variant") == 1, F.concat(F.unhex(F.lit("EFBBBF")), utf8))
        .when(F.col("variant") == 2, latin)
        .otherwise(F.concat(utf8, F.unhex(F.lit("FF"))))
    )
    return ctx("fx_plain").select(
        "doc_key", known_encoding(F.col("encoding")).alias("encoding"), body.alias("body")
    )


_ASCII = "not regexp_matches(text, '[^\x01-\x7f]')"
_PROPOSAL = (
    "case when variant = 1 then 'utf-8-sig' when variant = 3 then 'iso-8859-1' "
    f"when text = '' then null when {_ASCII} then 'ascii' when variant = 2 then 'iso-8859-1' else 'utf-8' end"
)
_PROPOSED = (
    f"select doc_key, coalesce(encoding, 'unknown') as encoding, text, variant, {_PROPOSAL} as encproposal from {{fx_plain}}"
)
# declared UTF-8 keeps the mark and drops the bad byte; the proposals do the reverse
_DECODED = (
    "case when encoding = 'nonsense-8' then null "
    "when encoding = 'UTF-8' and variant = 1 then concat('﻿', text) "
    "when encoding = 'unknown' and variant = 3 then concat(text, 'ÿ') else text end"
)


@query("e1_propose_charset", f"select doc_key, encproposal from ({_PROPOSED}) t")
def e1(ctx: Context):
    return decoding.with_proposal(_bodies(ctx)).select("doc_key", "encproposal")


_BRANCH = "cast(doc_key % 9 as int)"


@query(
    "e1_all_branches",
    f"select doc_key, case {_BRANCH} when 0 then case when text = '' then null when {_ASCII} then 'ascii' else 'utf-8' end "
    "when 1 then 'utf-8-sig' when 2 then 'utf-16' when 3 then 'utf-16' when 4 then 'utf-32' when 5 then 'utf-32' "
    "when 6 then 'windows-1252' end as encproposal, "
    f"cast(case {_BRANCH} when 0 then case when text = '' then 0 when {_ASCII} then 1 else 0.99 end "
    "when 6 then 0.73 when 7 then 0 when 8 then 0 else 1 end as double) as encconf, '' as language, "
    f"case {_BRANCH} when 6 then concat(text, '€') when 7 then '' when 8 then null else text end as body_dc from {{fx_plain}}",
)
def e1_branches(ctx: Context):
    def marked(mark: str, charset: str):
        return F.concat(F.unhex(F.lit(mark)), F.encode("text", charset))

    variants = [
        F.encode("text", "UTF-8"), marked("EFBBBF", "UTF-8"), marked("FFFE", "UTF-16LE"), marked("FEFF", "UTF-16BE"),
        marked("0000FEFF", "UTF-32"), marked("0000FEFF", "UTF-32"),
        F.concat(F.encode("text", "ISO-8859-1"), F.unhex(F.lit("80"))), F.unhex(F.lit("")),
    ]
    body = F.lit(None).cast("binary")
    for number, variant in enumerate(variants):
        body = F.when(F.col("doc_key") % 9 == number, variant).otherwise(body)
    bodies = ctx("fx_plain").select("doc_key", F.lit("unknown").alias("encoding"), body.alias("body"))
    return decoding.with_decoded_body(decoding.with_proposal(bodies)).select(
        "doc_key", "encproposal", "encconf", "language", "body_dc")


@query("e4_undecoded_rows", f"select doc_key, encoding from ({_PROPOSED}) t where encoding = 'nonsense-8'")
def e4_undecoded(ctx: Context):
    return undecoded_mails(_bodies(ctx)).select("doc_key", "encoding")


def _decoded(ctx: Context):
    return decoding.with_decoded_body(decoding.with_proposal(_bodies(ctx)))


@query(
    "e2_decode_declared",
    f"select doc_key, {_DECODED} as body_dc from ({_PROPOSED}) t where encoding <> 'unknown'",
)
def e2(ctx: Context):
    declared = _bodies(ctx).filter("encoding <> 'unknown'")
    return decoding.with_decoded_body(decoding.with_proposal(declared)).select("doc_key", "body_dc")


@query(
    "e3_decode_proposed",
    f"select doc_key, {_DECODED} as body_dc from ({_PROPOSED}) t where encoding = 'unknown'",
)
def e3(ctx: Context):
    return _decoded(ctx).filter("encoding = 'unknown'").select("doc_key", "body_dc")


@query("e4_drop_undecoded", f"select doc_key from ({_PROPOSED}) t where encoding <> 'nonsense-8'")
def e4(ctx: Context):
    return decoding.drop_undecoded(_decoded(ctx)).select("doc_key")


@query(
    "e4_count_decoded",
    f"select encoding <> 'nonsense-8' as decoded, count(*) as n_rows from ({_PROPOSED}) t group by 1",
)
def e4_count(ctx: Context):
    return decoding.count_decoded(_decoded(ctx))


@query(
    "e5_charset_agreement",
    f"select count(*) filter (where upper(encoding) = upper(encproposal)) as agreeing, count(*) as n_rows from ({_PROPOSED}) t",
)
def e5(ctx: Context):
    return decoding.charset_agreement(decoding.with_proposal(_bodies(ctx)))


@query("e5_proposal_counts", f"select encproposal, count(*) as count from ({_PROPOSED}) t group by 1")
def e5_counts(ctx: Context):
    from postsieve.operators.profiling import value_counts

    return value_counts(decoding.with_proposal(_bodies(ctx)), "encproposal", nulls=True)


@query("m9_unknown_encoding", "select doc_key, coalesce(encoding, 'unknown') as encoding from {fx_plain}")
def m9(ctx: Context):
    return _bodies(ctx).select("doc_key", "encoding")
