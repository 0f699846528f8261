"""Regex masks: every rule alone, the whole sequence, tags per language."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as Q
from checks.registry import Context, query
from postsieve.functions.masks import finish, count_tag, mask_one, strip, with_masked_text
from postsieve.operators.filters import drop_failed, is_failed
from postsieve.rules.mask_rules import MASK_SEQUENCE, WHITESPACE

_RULES = list(dict.fromkeys(MASK_SEQUENCE))


def _register(position: int, rule) -> None:
    @query(
        f"r{position:02}_mask_{rule.key}",
        f"select doc_key, {Q.mask_one('text', rule)} as masked from {{fx_pii}}",
    )
    def one(ctx: Context):
        return ctx("fx_pii").select("doc_key", mask_one(F.col("text"), rule).alias("masked"))


for _position, _rule in enumerate(_RULES, start=1):
    _register(_position, _rule)


@query("r23_strip_ends", f"select doc_key, trim(text, {Q.quote(WHITESPACE)}) as masked from {{fx_pii}}")
def strip_ends(ctx: Context):
    return ctx("fx_pii").select("doc_key", strip(F.col("text")).alias("masked"))


@query("r_mask_sequence", f"select doc_key, {Q.mask_chain('text')} as masked from {{fx_pii}}")
def mask_sequence(ctx: Context):
    return with_masked_text(ctx("fx_pii"), "text", "masked").drop("text")


@query(
    "r_mask_documents",
    f"select doc_id, {Q.mask_chain('text')} as masked from {{fx_documents}}",
)
def mask_documents(ctx: Context):
    return with_masked_text(ctx("fx_documents"), "text", "masked").select("doc_id", "masked")


@query(
    "r_mask_missing",
    "select doc_key, case when text is null then 'ANONYMIZATION FAILED' else masked end as masked from "
    f"(select doc_key, text, {Q.mask_chain('text')} as masked from "
    "(select doc_key, case when doc_key % 3 = 0 then null else text end as text from {fx_pii}) p) t",
)
def mask_missing(ctx: Context):
    texts = ctx("fx_pii").withColumn("text", F.when(F.col("doc_key") % 3 != 0, F.col("text")))
    return with_masked_text(texts, "text", "masked").drop("text")


_TAGS = ("<DATUM>", "<TELFAX>", "<EMAIL>", "<VIN>", "<KFZKZ>", "<PLZ>", "<URL>", "<666666>")
_NAMES = [t.strip("<>").lower().replace("666666", "digits6") for t in _TAGS]


@query(
    "flagship_tags_by_language",
    "select lang, count(*) as documents, "
    + ", ".join(
        f"cast(sum((length(m) - length(replace(m, '{tag}', ''))) // {len(tag)}) as bigint) as {name}"
        for tag, name in zip(_TAGS, _NAMES)
    )
    + f" from (select lang, {Q.mask_chain(Q.rulers(Q.controls('text')))} as m from {{fx_documents}}) t group by lang",
)
def tags_by_language(ctx: Context):
    from postsieve.functions.phrases import replace_controls, replace_rulers

    docs = ctx("fx_documents").select(
        "lang", replace_rulers(replace_controls(F.col("text"))).alias("text")
    )
    masked = with_masked_text(docs, "text")
    return masked.groupBy("lang").agg(
        F.count("*").alias("documents"),
        *[F.sum(count_tag(F.col("text"), tag)).alias(name)
          for tag, name in zip(_TAGS, _NAMES)],
    )


@query(
    "f4_drop_failed",
    "select row_seq, subject_clean from (select row_seq, "
    f"{Q.mask_chain(Q.subject('subject'))} as subject_clean from {{fx_mail}}) t "
    "where not contains(subject_clean, 'ANONYMIZATION FAILED')",
)
def f4_drop_failed(ctx: Context):
    from postsieve.functions.phrases import clean_subject

    mails = ctx("fx_mail").select("row_seq", clean_subject(F.col("subject")).alias("subject"))
    return drop_failed(with_masked_text(mails, "subject", "subject_clean"), "subject_clean").select(
        "row_seq", "subject_clean"
    )


@query(
    "f4_count_failed",
    "select count(*) filter (where subject is null) as failed, count(*) as n_rows from {fx_mail}",
)
def f4_count_failed(ctx: Context):
    from postsieve.functions.masks import mask_text

    subjects = ctx("fx_mail").select(mask_text(F.col("subject")).alias("subject"))
    return subjects.agg(
        F.count_if(is_failed("subject")).alias("failed"), F.count("*").alias("n_rows")
    )
