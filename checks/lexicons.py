"""Tokens, lexicon build, token and span masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as Q
from checks.registry import Context, query
from postsieve.functions.tokens import tokens, words
from postsieve.operators import lexicon
from postsieve.operators.spans import mask_spans


def _gazetteers(ctx: Context):
    return {
        "postcode": ctx("fx_postcode"), "first_name": ctx("fx_first_name"),
        "surname": ctx("fx_surname"), "city": ctx("fx_city"), "street": ctx("fx_street"),
    }


def _lexicon(ctx: Context):
    return lexicon.build_lexicon(_gazetteers(ctx), [ctx("fx_stop")])


_STEPS = (
    "stop as (select upper(token) as token from {fx_stop}), "
    "first0 as (select distinct upper(token) as token from {fx_first_name} where length(token) > 3), "
    "sur0 as (select distinct upper(token) as token from {fx_surname} where length(token) > 3), "
    "city0 as (select distinct upper(rtrim(token)) as token from {fx_city} where length(rtrim(token)) > 3), "
    "street as (select distinct upper(token) as token from {fx_street} where length(token) > 3), "
    "sur as (select token from sur0 where token not in (select token from stop)), "
    "first as (select token from first0 where token not in (select token from sur) "
    "and token not in (select token from city0) and token not in (select token from stop)), "
    "city as (select token from city0 where token not in (select token from sur) "
    "and token not in (select token from first) and token not in (select token from stop)), "
    "plz as (select distinct upper(token) as token from {fx_postcode} where upper(token) not in (select token from city)), "
    "lex as (select token, 'postcode' as source, '<PLZ>' as tag, 1 as priority from plz "
    "union all select token, 'first_name', '<VORNAME>', 4 from first "
    "union all select token, 'surname', '<NACHNAME>', 5 from sur "
    "union all select token, 'city', '<STADT>', 6 from city "
    "union all select token, 'street', '<STRASSE>', 7 from street)"
)


def _with_lexicon(select: str) -> str:
    return f"select * from (with {_STEPS} {select}) r"


@query("n4_build_lexicon", _with_lexicon("select token, source, tag, priority from lex"))
def n4(ctx: Context):
    return _lexicon(ctx).select("token", "source", "tag", "priority")


@query("n4_lexicon_sizes", _with_lexicon("select source, count(*) as entries from lex group by source"))
def n4_sizes(ctx: Context):
    return lexicon.lexicon_sizes(_lexicon(ctx))


@query("j8_lexicon_difference", _with_lexicon("select token from first"))
def j8(ctx: Context):
    return _lexicon(ctx).filter("source = 'first_name'").select("token")


@query("n5_tokens", f"select doc_key, array_to_string({Q.tokens('text')}, ' ') as tokens from {{fx_pii}}")
def n5(ctx: Context):
    return ctx("fx_pii").select("doc_key", F.array_join(tokens(F.col("text")), " ").alias("tokens"))


@query("n5_words", f"select doc_id, array_to_string({Q.words('text')}, ' ') as words from {{fx_documents}}")
def n5_words(ctx: Context):
    return ctx("fx_documents").select("doc_id", F.array_join(words(F.col("text")), " ").alias("words"))


_POSTCODES = (
    "select d.doc_key, string_agg(case when p.token is not null then '<PLZ>' else d.tok end, ' ' order by d.i) as masked "
    f"from (select doc_key, unnest({Q.tokens('text')}) as tok, generate_subscripts({Q.tokens('text')}, 1) as i from {{fx_pii}}) d "
    "left join (select distinct upper(token) as token from {fx_postcode}) p on upper(d.tok) = p.token group by d.doc_key"
)


@query("n2_mask_postcodes", _POSTCODES)
def n2(ctx: Context):
    return lexicon.mask_postcodes(ctx("fx_pii"), "text", ctx("fx_postcode"), "doc_key", "masked").drop("text")


@query("n2_mask_postcodes_joined", _POSTCODES)
def n2_joined(ctx: Context):
    return lexicon.mask_postcodes(
        ctx("fx_pii"), "text", ctx("fx_postcode"), "doc_key", "masked", max_rows=0
    ).drop("text")


_GAZETTEERS = _with_lexicon(
    "select d.doc_id, coalesce(string_agg(coalesce(l.tag, d.tok), ' ' order by d.i), '') as masked from "
    f"(select doc_id, unnest({Q.words('text')}) as tok, generate_subscripts({Q.words('text')}, 1) as i from {{fx_documents}}) d "
    "left join (select token, min_by(tag, priority) as tag from lex where source <> 'postcode' or length(token) < 10 group by token) l "
    "on upper(d.tok) = l.token group by d.doc_id "
    f"union all select doc_id, '' as masked from {{fx_documents}} where len({Q.words('text')}) = 0"
)


@query("n3_mask_gazetteers", _GAZETTEERS)
def n3(ctx: Context):
    docs = ctx("fx_documents").select("doc_id", "text")
    return lexicon.mask_gazetteers(docs, "text", _lexicon(ctx), "doc_id", "masked").drop("text")


@query("n3_mask_gazetteers_joined", _GAZETTEERS)
def n3_joined(ctx: Context):
    docs = ctx("fx_documents").select("doc_id", "text")
    return lexicon.mask_gazetteers(
        docs, "text", _lexicon(ctx), "doc_id", "masked", max_rows=0
    ).drop("text")


@query(
    "n1_mask_spans",
    "select doc_key, concat(case when doc_key % 3 = 0 then concat('<PER>', substr(text, 6, 3)) else substr(text, 1, 8) end, "
    "'<LOC>', substr(text, 13, 8), '<ORG>', substr(text, 26)) as masked from {fx_pii}",
)
def n1(ctx: Context):
    spans = F.expr(
        "filter(array(named_struct('start', 20, 'end', 25, 'label', 'ORG'), "
        "named_struct('start', 8, 'end', 12, 'label', 'LOC'), "
        "named_struct('start', 14, 'end', 18, 'label', 'MISC'), "
        "named_struct('start', 0, 'end', 5, 'label', 'PER')), s -> s.label <> 'PER' or doc_key % 3 = 0)"
    )
    return ctx("fx_pii").select("doc_key", mask_spans(F.col("text"), spans).alias("masked"))
