"""Phrase rules: every group alone and both profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as Q
from checks.registry import Context, query
from postsieve.functions import phrases as P
from postsieve.functions.rewrite import rewrite
from postsieve.operators.filters import keep_trimmed


def _body(expression: str) -> str:
    return f"select row_seq, {expression} as cleaned from {{fx_mail}}"


def _steps(name: str, expression: str, steps) -> None:
    @query(name, _body(expression))
    def run(ctx: Context):
        return ctx("fx_mail").select("row_seq", rewrite(F.col("body"), steps()).alias("cleaned"))


@query("c1_replace_controls", _body(Q.controls("body")))
def c1(ctx: Context):
    return ctx("fx_mail").select("row_seq", P.replace_controls(F.col("body")).alias("cleaned"))


_steps("c2_replace_rulers", Q.rulers("body"), P.ruler_steps)
@query("c2_unfolded_documents", f"select doc_id, {Q.rulers(Q.controls('text'))} as cleaned from {{documents}}")
def c2_documents(ctx: Context):
    cleaned = rewrite(P.replace_controls(F.col("text")), P.ruler_steps())
    return ctx("documents").select("doc_id", cleaned.alias("cleaned"))


_steps("c3_drop_titles", Q.titles("body"), P.title_steps)
_steps("c4_trim_reply", Q.reply("body"), P.reply_steps)
_steps("c5_tag_salutations", Q.salutations("body"), P.salutation_steps)
_steps("c6_tag_closings", Q.closings("body"), P.closing_steps)
_steps("c7_tag_footers", Q.footers("body"), P.footer_steps)


@query(
    "c8_tag_organisation",
    f"select doc_key, {Q.organisation('rawbody')} as cleaned from {{fx_body}}",
)
def c8(ctx: Context):
    cleaned = rewrite(F.col("rawbody"), P.organisation_steps())
    return ctx("fx_body").select("doc_key", cleaned.alias("cleaned"))


@query("c9_truncate", "select doc_id, substr(text, 1, 10000) as cleaned from {documents}")
def c9(ctx: Context):
    return ctx("documents").select("doc_id", P.truncate(F.col("text"), P.P.MAX_CHARS).alias("cleaned"))


@query("c_clean_subject", f"select row_seq, {Q.subject('subject')} as cleaned from {{fx_mail}}")
def clean_subject(ctx: Context):
    return ctx("fx_mail").select("row_seq", P.clean_subject(F.col("subject")).alias("cleaned"))


@query(
    "c_clean_mail",
    f"select row_seq, {Q.subject('subject')} as subject, {Q.mail_body('body')} as body_clean from {{fx_mail}}",
)
def clean_mail(ctx: Context):
    mails = ctx("fx_mail").select("row_seq", "subject", "body")
    return P.clean_mail(mails).drop("body")


@query(
    "c_clean_capture",
    f"select doc_key, {Q.capture_body('rawbody')} as body_clean from {{fx_body}}",
)
def clean_capture(ctx: Context):
    return P.clean_capture(ctx("fx_body")).drop("rawbody")


@query(
    "c_clean_mail_strict",
    "select row_seq, "
    + Q.regex(
        Q.regex("body", "|".join(
            sorted({p.replace("{team}", Q.HOUSE.team).replace("{contact}", Q.HOUSE.contact)
                    for p in Q.P.SALUTATIONS}, key=lambda p: (-len(p), p))), "<Anrede>"),
        "|".join(sorted(Q.P.CLOSINGS, key=lambda p: (-len(p), p))), "<MFG>")
    + " as cleaned from {fx_mail}",
)
def clean_mail_strict(ctx: Context):
    steps = P.salutation_steps(compat=False) + P.closing_steps(compat=False)
    return ctx("fx_mail").select("row_seq", rewrite(F.col("body"), steps).alias("cleaned"))


@query(
    "f4_find_trimmed",
    f"select row_seq from {{fx_mail}} where contains({Q.mail_body('body')}, '<TRIM EOFT>')",
)
def find_trimmed(ctx: Context):
    mails = P.clean_mail(ctx("fx_mail").select("row_seq", "subject", "body"))
    return keep_trimmed(mails).select("row_seq")
