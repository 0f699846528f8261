"""Registered queries against their SQL, and the shape of important plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from checks import ORACLES, QUERIES
from checks.compare import result_hash
from checks.fixtures import _BASE
from checks.registry import Context, runnable

SF_DIR = "/root/testdata/sf0.001"

#: run on every test run; ``ALL_QUERIES=1`` runs all of them
SAMPLE = (
    "flagship_tags_by_language", "r_mask_sequence", "c_clean_mail", "c_clean_capture",
    "k2_fill_median", "k7_parse_keys", "j1_index_and_body_full", "j5_blocklist_text",
    "e3_decode_proposed", "n2_mask_postcodes_joined", "x3_first_body", "d1_keep_first",
    "a2_pages_by_type", "w1_running_total", "o2_number_rows", "m4_attachment_names",
    "l1_capture_corpus", "l2_mail_corpus",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in _BASE:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES if os.environ.get("ALL_QUERIES") else SAMPLE)
def test_query_matches_sql(spark, duck, name):
    df = runnable(QUERIES[name])(spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    rows = [tuple(r) for r in df.collect()]
    assert result_hash(df.columns, rows) == result_hash(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 4


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_masking_does_not_shuffle(spark):
    from postsieve.functions.masks import with_masked_text

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = _plan(with_masked_text(documents.select("doc_id", "text"), "text"))
    assert "Exchange" not in plan and "Python" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_lookup_and_filters_reach_the_scan(spark):
    from postsieve.operators.ordering import lookup

    plan = _plan(lookup(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id", 3))
    assert "EqualTo(doc_id,3)" in plan


def test_blocklist_check_does_not_shuffle(spark):
    from checks.joins_filters import _blocklist
    from postsieve.operators.lexicon import drop_listed

    ctx = Context(spark, SF_DIR)
    kept = drop_listed(ctx("documents").select("doc_id", "text"), "text", _blocklist(ctx), "doc_id")
    plan = _plan(kept)
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def test_bodies_are_read_once(spark, tmp_path):
    """The medians come from the index and the keys of the bodies."""
    from postsieve.plans.capture_corpus import build_capture_corpus

    ctx = Context(spark, SF_DIR)
    for name in ("fx_index", "fx_body"):
        ctx(name).write.parquet(f"{tmp_path}/{name}")
    index, body = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("fx_index", "fx_body"))
    corpus = build_capture_corpus((index, body))
    plan = spark._jvm.PythonSQLUtils.explainString(corpus._jdf.queryExecution(), "formatted")
    assert "Subqueries" in plan and "ReadSchema: struct<doc_key:string>" in plan
    assert plan.count("rawbody:string") == 1


def test_pair_and_joined_table_give_the_same(spark):
    from postsieve.operators.joins import align_index_and_body
    from postsieve.plans.capture_corpus import parse_capture, rejected_capture

    ctx = Context(spark, SF_DIR)
    pair = (ctx("fx_index"), ctx("fx_body"))
    joined = align_index_and_body(*pair, complete=True)
    for tagged_only in (True, False):
        left, right = parse_capture(pair, tagged_only), parse_capture(joined, tagged_only)
        columns = [c for c in left.columns]
        assert left.exceptAll(right.select(*columns)).count() == 0 and left.count() == right.count()
        assert rejected_capture(pair, tagged_only).count() == rejected_capture(joined, tagged_only).count()


def test_bins_of_archives_are_cut_in_pieces(spark, monkeypatch):
    from checks import archives as A
    from checks.registry import Context
    from pyspark.sql import functions as F

    ctx = Context(spark, "unused")
    # 200 orders of bin 5 (cut off) and bin 8 (readable); the first order of bin 8 has no body
    orders = spark.range(200).select((F.col("id") * 64 + F.lit(5) + 3 * (F.col("id") % 2)).alias("order"))
    ctx._known["fx_bins"] = orders.select(
        F.concat(F.lit("F"), (F.col("order") % 64).cast("string")).alias("file"), (F.col("order") % 64).alias("order_key"),
        F.lit(1).alias("proc"), (F.col("order") * 10 + 1).alias("line"), F.concat(F.lit("D"), F.col("order").cast("string")).alias("doc_id"),
        F.when(F.col("order") > 200, "1").otherwise("0").alias("is_body"), F.col("order").alias("part"))
    monkeypatch.setattr(A, "_ORDERS_PER_PIECE", 1000)
    archives = A.scan_archives(spark, A._written(ctx)).count()
    assert archives > 20
    assert [(r.bin, r.error) for r in A.x3_errors(ctx).collect()] == [(5, "not well-formed")]
    assert [r.doc_id for r in A.s4(ctx).collect()] == ["D328"]


def test_no_text_goes_through_the_join_of_lengths(spark):
    from checks.joins_filters import _aligned
    from checks.registry import Context

    ctx = Context(spark, "unused")
    ctx._known["fx_index"] = spark.createDataFrame([("a", "xy")], "doc_key string, indexstring string")
    ctx._known["fx_body"] = spark.createDataFrame([("a", "xyz")], "doc_key string, rawbody string")
    plan = _aligned(ctx, True)
    assert [tuple(r) for r in plan.collect()] == [("a", 2, 3)]
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "rawbody" not in text.partition("Join")[0]


def test_words_are_computed_once_for_all_gazetteers(spark):
    ctx = Context(spark, SF_DIR)
    assert "explode" not in _plan(ctx("fx_first_name")) and "explode" in _plan(ctx("fx_words"))
    assert ctx("fx_surname").exceptAll(ctx("fx_words").filter("token like 'and%' or token like 'er%'")).count() == 0


def test_small_files_are_written_without_a_folder_each(spark, tmp_path):
    from checks.files import s1
    from checks.named import write_texts
    from pyspark.sql import functions as F

    rows = [(1, b"ein"), (1, b"ein"), (-2, "für".encode()), (3, b"\xff"), (4, None), (5, b""), (None, b"x")]
    texts = spark.createDataFrame(rows, "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))
    write_texts(texts, "doc_id", "text", f"{tmp_path}/texts", "\u0003")
    files = {path.name: path.read_bytes() for path in (tmp_path / "texts").iterdir()}
    assert files == {
        "text-1.txt": b"ein\x03ein\x03", "text--2.txt": "für\x03".encode(), "text-3.txt": b"\xff\x03",
        "text-4.txt": b"\x03", "text-5.txt": b"\x03", "text-null.txt": b"x\x03"}

    ctx = Context(spark, "unused")
    ctx._known["documents"] = texts
    assert sorted((r.chars, r.is_valid_utf8) for r in s1(ctx).collect()) == [
        (0, True), (0, True), (1, False), (1, True), (3, True), (7, True)]
    write_texts(texts.limit(0), "doc_id", "text", f"{tmp_path}/none")
    assert [*(tmp_path / "none").iterdir()] == []


def test_archives_are_gathered_as_narrow_rows(spark):
    from checks.archives import archives
    from pyspark.sql import functions as F

    ctx = Context(spark, "unused")
    ctx._known["fx_bins"] = spark.createDataFrame(
        [("F2", 2, 1, 11, "D1", "1", 4), ("F2", 2, 0, 12, "D2", "0", 5), ("F2", 2, 1, 10, "D3", None, 6), ("F11", 11, 0, 20, None, "1", 7)],
        "file string, order_key long, proc int, line long, doc_id string, is_body string, part long")
    built = archives(ctx, "fx_bins", F.lit(0))
    gathered = next(x for x in built._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in x)
    assert "collect_list" in gathered and "<DOCUMENT" not in gathered
    found = {r.bin: r.xml for r in built.collect()}
    # processes in order, documents by line; one with a null attribute has no text
    assert found[2].startswith('<STACK StackID="S2"><PROCESS ProcessID="P0"><DOCUMENT DocID="D2" ExportName="T0" AlteredBy="A2">')
    assert found[2].endswith('</DOCUMENT></PROCESS></STACK>') and found[2].count("<DOCUMENT") == 2 and "D3" not in found[2]
    assert found[11] == '<STACK StackID="S11"><PROCESS ProcessID="P0"></PROCESS></STACK>'


def test_bodies_are_filtered_before_they_are_joined(spark):
    from postsieve.operators.profiling import StepReport
    from postsieve.plans.capture_corpus import build_all_records, build_capture_corpus

    def text(doctype, flag, pages="3"):
        return (f'"Klasse1","Inhalt","{{Batch ID}}","100001","{{Document ID}}","7","DocumentType","{doctype}",'
                f'"ClassificationResultWithConfiden","{doctype};0.5;A","PageCount","{pages}","{{Document Count}}","1",'
                f'"{{$InputChannel}}","Mail","{{$sourceSystem}}","Q","AutoClassificationConfidence","{flag}"')

    index = spark.createDataFrame(
        [("a", text("Typ1", 0)), ("b", text("Typ1", 1)), ("c", text("Typ2", 0, "")), ("d", text("Typ1", 0)), ("d", text("Typ1", 0)),
         ("e", text("Typ1", 0)), ("f", text("Typ1", 0)), (None, text("Typ1", 0)), ("g", None), ("h", text("Typ1", "x"))],
        "doc_key string, indexstring string")
    body = spark.createDataFrame(
        [("a", "frei"), ("b", "frei"), ("c", "frei c"), ("d", "eins"), ("d", "zwei"), ("e", "das ist GESPERRT"), ("f", None),
         (None, "ohne"), ("g", "frei"), ("h", "frei"), ("k", "allein")], "doc_key string, rawbody string")
    listed = spark.createDataFrame([("GESPERRT",)], "token string")
    types = spark.createDataFrame([("Typ1",)], "token string")
    joined = index.join(body, "doc_key")

    def built(docs, build, **more):
        steps = StepReport()
        corpus = build(docs, blocklist=listed, steps=steps, **more)
        columns = [c for c in corpus.columns if c not in ("pagecount", "doccount")]
        return sorted(map(str, corpus.select(*columns).collect())), steps.rows(), corpus

    for build, more in ((build_capture_corpus, {}), (build_all_records, {"types": types})):
        rows, steps, corpus = built((index, body), build, **more)
        assert (rows, steps) == built(joined, build, **more)[:2]
        assert "bitmap_construct_agg" in _plan(corpus)
    # of one table the medians count a document once for each of its bodies, so pages are not compared
    assert [s[2] for s in built((index, body), build_capture_corpus)[1]] == [8, 7, 6, 6]
