"""Profiles, counts, de-duplication, order."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as Q
from checks.registry import Context, query
from postsieve.operators import dedup, ordering, profiling


def _docs(ctx: Context):
    return ctx("orders").select(
        F.col("o_orderkey").alias("doc_key"),
        F.concat(F.lit("Typ"), (F.col("o_custkey") % 25).cast("string")).alias("doctype"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderkey") % 13 + 1).alias("pagecount"),
        (F.col("o_orderkey") % 2 == 1).alias("autoclass"),
    )


_DOCS = (
    "(select o_orderkey as doc_key, concat('Typ', cast(o_custkey % 25 as string)) as doctype, "
    "case when o_orderkey % 17 <> 0 then o_orderkey % 13 + 1 end as pagecount, "
    "o_orderkey % 2 = 1 as autoclass from {orders}) d"
)


def _describe(value: str, percentiles) -> str:
    return (
        f"count({value}) as count, avg({value}) as mean, stddev_samp({value}) as std, min({value}) as min, "
        + ", ".join(f"quantile_cont({value}, {p}) as p{round(p * 100)}" for p in percentiles)
        + f", max({value}) as max"
    )


@query(
    "a1_describe_pages",
    f"select doctype, {_describe('pagecount', profiling.PAGE_PERCENTILES)} from {_DOCS} group by doctype",
)
def a1(ctx: Context):
    return profiling.describe_by(_docs(ctx), "doctype", "pagecount")


@query(
    "a2_pages_by_type",
    "select doctype, count(pagecount) as count, round_even(avg(pagecount), 1) as mean, "
    "round_even(stddev_samp(pagecount), 1) as std, cast(trunc(avg(pagecount) * count(pagecount)) as bigint) as pcount "
    f"from {_DOCS} group by doctype order by pcount desc, doctype limit 20",
)
def a2(ctx: Context):
    return profiling.pages_by_type(_docs(ctx), top=20)


@query(
    "a3_value_counts",
    f"select pagecount, count(*) as count from {_DOCS} where pagecount is not null group by pagecount",
)
def a3(ctx: Context):
    return profiling.value_counts(_docs(ctx), "pagecount")


@query("a3_value_counts_with_nulls", "select encoding, count(*) as count from {fx_mail} group by encoding")
def a3_nulls(ctx: Context):
    return profiling.value_counts(ctx("fx_mail"), "encoding", nulls=True)


@query(
    "a4_value_shares",
    f"select doctype, round_even(count(*) / (select count(*) from {_DOCS}), 3) as share from {_DOCS} group by doctype",
)
def a4(ctx: Context):
    return profiling.value_shares(_docs(ctx), "doctype")


@query(
    "a5_distinct_count",
    "select count(distinct sender) as sender, count(distinct subject) as subject from {fx_mail}",
)
def a5(ctx: Context):
    return profiling.distinct_count(ctx("fx_mail"), "sender", "subject")


@query("a5_distinct_values", "select distinct sender from {fx_mail}")
def a5_values(ctx: Context):
    return profiling.distinct_values(ctx("fx_mail"), "sender")


@query(
    "a6_volume",
    f"select count(*) as documents, cast(sum(pagecount) as bigint) as pages from {_DOCS}",
)
def a6(ctx: Context):
    return profiling.volume(_docs(ctx))


@query("a7_describe_chars", f"select {_describe('length(text)', profiling.CHAR_PERCENTILES)} from {{documents}}")
def a7(ctx: Context):
    return profiling.describe_chars(ctx("documents"), "text")


@query(
    "a8_describe_words",
    f"select {_describe('n', profiling.WORD_PERCENTILES)} from (select {Q.word_count('text')} as n from {{fx_documents}}) t",
)
def a8(ctx: Context):
    return profiling.describe_words(ctx("fx_documents"), "text")


@query(
    "a9_mean_lengths",
    "select avg(length(subject)) as subject_chars, "
    f"avg({Q.word_count('subject')}) as subject_words, avg(length(body)) as body_chars, "
    f"avg({Q.word_count('body')}) as body_words from {{fx_mail}}",
)
def a9(ctx: Context):
    return profiling.mean_lengths(ctx("fx_mail"), "subject", "body")


@query(
    "a10_count_repeats",
    "select count(*) - count(distinct coalesce(message_id, '')) as repeats from {fx_mail}",
)
def a10(ctx: Context):
    return dedup.count_repeats(ctx("fx_mail"), "message_id")


_PROFILED = ("message_id", "sender", "subject", "encoding", "row_seq")


@query(
    "a11_table_profile",
    " union all ".join(
        f"select {i} as position, '{c}' as column_name, '{'bigint' if c == 'row_seq' else 'string'}' as data_type, "
        f"count({c}) as non_null from {{fx_mail}}"
        for i, c in enumerate(_PROFILED)
    ),
)
def a11(ctx: Context):
    return profiling.table_profile(ctx("fx_mail").select(*_PROFILED))


@query(
    "a12_step_report",
    "select 'manual' as step, count(*) as rows_before, count(*) filter (where autoclass) as hits, "
    "count(*) filter (where not autoclass) as rows_after, "
    f"round_even(count(*) filter (where autoclass) / count(*), 3) as share from {_DOCS}",
)
def a12(ctx: Context):
    return profiling.step_report(_docs(ctx), "manual", F.col("autoclass"))


@query(
    "d1_keep_first",
    "select message_id, sender, subject, file_seq, row_seq, md5(body) as body from (select *, row_number() over "
    "(partition by message_id order by file_seq, row_seq) as nr from {fx_mail}) t where nr = 1",
)
def d1(ctx: Context):
    mails = ctx("fx_mail").select("message_id", "sender", "subject", "file_seq", "row_seq", "body")
    first = dedup.keep_first(mails, "message_id", "file_seq", "row_seq")
    return first.withColumn("body", F.md5("body"))


@query("w1_running_total", (
    "select file_seq, added, cast(sum(added) over (order by file_seq) as bigint) as total from "
    "(select file_seq, count(*) as added from {fx_mail} group by file_seq) t"
))
def w1(ctx: Context):
    counts = ctx("fx_mail").groupBy("file_seq").agg(F.count("*").alias("added"))
    return ordering.running_total(counts, "file_seq", "added", block=5)


@query(
    "o1_top_types",
    f"select doctype, count(*) as count from {_DOCS} group by doctype order by count desc, doctype limit 5",
)
def o1(ctx: Context):
    counts = profiling.value_counts(_docs(ctx), "doctype")
    return ordering.top(counts, 5, F.desc("count"), F.asc("doctype"))


@query(
    "o1_bottom_types",
    f"select doctype, count(*) as count from {_DOCS} group by doctype order by count, doctype limit 5",
)
def o1_bottom(ctx: Context):
    counts = profiling.value_counts(_docs(ctx), "doctype")
    return ordering.top(counts, 5, F.asc("count"), F.asc("doctype"))


@query(
    "o2_slice_rows",
    "select doc_key, n_chars from (select doc_id as doc_key, n_chars from {documents} order by n_chars desc, doc_id limit 50 offset 100) t",
)
def o2(ctx: Context):
    docs = ctx("documents").select(F.col("doc_id").alias("doc_key"), "n_chars")
    return ordering.slice_rows(docs, 100, 150, F.desc("n_chars"), F.asc("doc_key"))


@query(
    "o2_number_rows",
    "select o_orderkey, row_number() over (order by o_totalprice, o_orderkey) - 1 as row_nr from {orders}",
)
def o2_number(ctx: Context):
    orders = ctx("orders").select("o_orderkey", "o_totalprice")
    numbered = ordering.number_rows(orders, F.asc("o_totalprice"), F.asc("o_orderkey"))
    return numbered.select("o_orderkey", "row_nr")


@query(
    "o3_sample_rows",
    "select doc_id from {documents} order by md5(concat('4711:', cast(doc_id as string))), doc_id limit 10",
)
def o3(ctx: Context):
    return ordering.sample_rows(ctx("documents").select("doc_id"), 10, "doc_id", 4711)


@query("o4_lookup", "select doc_id, n_chars from {documents} where doc_id = 17")
def o4(ctx: Context):
    return ordering.lookup(ctx("documents"), "doc_id", 17).select("doc_id", "n_chars")
