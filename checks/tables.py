"""Unions, sets, projections, lookup tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Context, query
from postsieve.operators import tables
from postsieve.operators.lookup import lookup_values


@query(
    "u1_union_containers",
    "select row_seq, sender, cast(null as string) as subject from {fx_mail} where file_seq = 0 "
    "union all select row_seq, sender, subject from {fx_mail} where file_seq <> 0",
)
def u1(ctx: Context):
    mails = ctx("fx_mail").select("row_seq", "file_seq", "sender", "subject")
    early = mails.filter("file_seq = 0").drop("subject")
    later = mails.filter("file_seq <> 0")
    return tables.union_tables([early, later]).drop("file_seq")


@query(
    "u2_keys_without",
    "select row_seq from {fx_mail} where coalesce(subject, '') not in "
    "('Kontaktanfrage Internet Auftritt Banking', 'Eingang einer Kontaktanfrage')",
)
def u2(ctx: Context):
    mails = ctx("fx_mail").select("row_seq", "subject")
    first = mails.filter(F.col("subject") == "Kontaktanfrage Internet Auftritt Banking")
    second = mails.filter(F.col("subject") == "Eingang einer Kontaktanfrage")
    return tables.keys_without(mails, "row_seq", first, second).select("row_seq")


@query("u2_keys_in", "select o_orderkey from {orders} where o_orderkey in (select l_orderkey from {lineitem})")
def u2_in(ctx: Context):
    lines = ctx("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return tables.keys_in(ctx("orders").select("o_orderkey"), "o_orderkey", lines)


@query("u2_common_keys", "select o_custkey as key from {orders} intersect select c_custkey from {customer} where c_acctbal < 0")
def u2_common(ctx: Context):
    buyers = ctx("orders").select(F.col("o_custkey").alias("key"))
    debtors = ctx("customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("key"))
    return tables.common_keys(buyers, debtors, "key")


@query(
    "u3_flatten_lists",
    "select o_orderkey, o_orderkey % 7 as item from {orders} union all "
    "select o_orderkey, o_custkey from {orders} union all select o_orderkey, 3 as item from {orders}",
)
def u3(ctx: Context):
    nested = ctx("orders").select(
        "o_orderkey",
        F.array(F.array(F.col("o_orderkey") % 7, F.col("o_custkey")), F.array(F.lit(3))).alias("lists"),
    )
    return tables.flatten_lists(nested, "lists", "item")


@query("p1_drop_columns", "select message_id, sender, subject, row_seq from {fx_mail}")
def p1(ctx: Context):
    return tables.drop_columns(
        ctx("fx_mail"), ["date", "time", "body", "encoding", "file_seq", "no_such_column"]
    )


@query("p2_project", "select row_seq as label, sender as absender from {fx_mail}")
def p2(ctx: Context):
    return tables.project(ctx("fx_mail"), {"row_seq": "label", "sender": "absender"})


@query("p3_upper_names", 'select n_nationkey as "N_NATIONKEY", n_name as "N_NAME" from {nation}')
def p3(ctx: Context):
    return tables.upper_names(ctx("nation").select("n_nationkey", "n_name"))


@query("s8_lookup_values", "select distinct upper(token) as token from {fx_words} where token is not null")
def s8(ctx: Context):
    return lookup_values(ctx("fx_words"), "token")
