"""Operators on small tables, compared with plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postsieve.operators import archive, dedup, filters, joins, lexicon, ordering, tables
from postsieve.operators.lookup import collect_if_small
from postsieve.sources import files, sinks
from postsieve.sources.tables import load_containers, normalize_names


def _mails(spark):
    rng = random.Random(7)
    # one id holds a third of all rows
    rows = [
        (None if i % 50 == 0 else "hot" if rng.random() < 0.33 else f"m{rng.randrange(200)}", i % 7, i)
        for i in range(3000)
    ]
    return rows, spark.createDataFrame(rows, "message_id string, file_seq int, row_seq int")


def test_keep_first(spark):
    rows, df = _mails(spark)
    first = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        first.setdefault(row[0], row)
    kept = dedup.keep_first(df, "message_id", "file_seq", "row_seq")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(first.values(), key=str)
    again = dedup.keep_first(kept, "message_id", "file_seq", "row_seq")
    assert again.exceptAll(kept).count() == 0 and again.count() == kept.count()
    assert dedup.count_repeats(df, "message_id").first().repeats == len(rows) - len(first)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeats_are_found_on_narrow_columns(spark):
    _, df = _mails(spark)
    df = df.withColumn("body", F.repeat(F.lit("x"), F.col("row_seq")))
    plan = _plan(dedup.keep_first(df, "message_id", "row_seq"))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan and "Window" not in plan
    # too many repeated ids: bits mark the rows that may be repeated, and only those are aggregated
    plan = _plan(dedup.keep_first(df, "message_id", "row_seq", max_keys=0))
    assert "partial_min_by" in plan and "bitmap_construct_agg" in plan and "Window" not in plan


def test_keep_first_in_every_way(spark, monkeypatch):
    """Many and few repeated ids, a full bit filter, rows that share the first place, null places."""
    rows, df = _mails(spark)
    expected = sorted(map(tuple, dedup.keep_first(df, "message_id", "file_seq", "row_seq").collect()), key=str)
    many = dedup.keep_first(df, "message_id", "file_seq", "row_seq", max_keys=3)
    assert sorted(map(tuple, many.collect()), key=str) == expected
    monkeypatch.setattr(dedup, "FILTER_BITS", 64)
    many = dedup.keep_first(df, "message_id", "file_seq", "row_seq", max_keys=3)
    assert sorted(map(tuple, many.collect()), key=str) == expected
    shared = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("c", None, "n"), ("c", 1, "m"), (None, 3, "q")],
        "id string, place int, t string")
    for max_keys in (10, 0):
        kept = dedup.keep_first(shared, "id", "place", max_keys=max_keys)
        assert sorted(map(tuple, kept.collect()), key=str) == [
            ("a", 1, "x"), ("b", 1, "z"), ("c", None, "n"), (None, 3, "q")]
    assert dedup.keep_first(df.limit(0), "message_id", "row_seq").count() == 0


def test_blocklist_both_ways(spark):
    texts = [(1, "von Böse@mail.example, an"), (2, "nichts"), (3, None), (4, ""), (5, "(BÖSE@mail.example)")]
    df = spark.createDataFrame(texts, "id int, text string")
    blocklist = spark.createDataFrame([("BÖSE@MAIL.EXAMPLE",)], "token string")
    for max_rows in (10, 0):
        kept = lexicon.drop_listed(df, "text", blocklist, "id", max_rows)
        assert sorted(r.id for r in kept.collect()) == [2, 3, 4]


def test_lookups_do_not_depend_on_size(spark):
    """Null and repeated keys, repeated texts, a token with two tags."""
    rows = [(None, "Hans fragt"), (None, None), (1, "Hans fragt"), (1, "nichts"), (2, "BÖSE Hans hans"), (None, "böse")]
    df = spark.createDataFrame(rows, "id int, text string")
    names = spark.createDataFrame([("HANS", "<VORNAME>"), ("HANS", "<A>")], "token string, tag string")
    listed = spark.createDataFrame([("BÖSE",), ("BÖSE",)], "token string")
    for function, table in ((lexicon.tag_tokens, names), (lexicon.flag_listed, listed)):
        small, large = (Counter(map(tuple, function(df, "text", table, "id", max_rows=n).collect())) for n in (100, 0))
        assert small == large and small.total() == len(rows)
    tagged = lexicon.tag_tokens(df, "text", names, "id").filter("id = 2").first().text
    assert tagged == "BÖSE <A> <A>"
    kept = lexicon.drop_listed(df, "text", listed, "id", max_rows=0)
    assert Counter(r.text for r in kept.collect()) == {"Hans fragt": 2, None: 1, "nichts": 1}


def test_only_the_used_part_of_a_large_lookup_goes_out(spark):
    df = spark.createDataFrame([(i, f"der Hans {i}") for i in range(50)] + [(99, None)], "id int, text string")
    names = spark.range(100_000).select(F.concat(F.lit("N"), "id").alias("token"), F.lit("<N>").alias("tag")).unionByName(
        spark.createDataFrame([("HANS", "<VORNAME>")], "token string, tag string"))
    tagged = lexicon.tag_tokens(df, "text", names, "id", max_rows=10)
    plan = _plan(tagged)
    assert "ArrowEvalPython" in plan and "Join" not in plan and "Exchange" not in plan
    assert {r.text for r in tagged.filter("id < 3").collect()} == {f"der <VORNAME> {i}" for i in range(3)}
    assert tagged.filter("id = 99").first().text is None
    # joined: the tokens cross under narrow ids, and null texts are rows like any other
    joined = lexicon.tag_tokens(df, "text", names, "id", max_rows=0)
    assert "md5" not in _plan(joined)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, tagged.collect()))


def test_size_estimate_keeps_large_tables_away_from_the_driver(spark):
    from postsieve.operators.lookup import estimated_bytes

    df = spark.range(1_000_000)
    assert estimated_bytes(df) >= 8_000_000 and collect_if_small(df, max_bytes=1000) is None


def test_lexicon_is_one_aggregate(spark):
    tables = {k: spark.createDataFrame([(w,) for w in v], "token string") for k, v in {
        "postcode": ["12345", "BERN"], "first_name": ["Anna", "Bern", "Meier", "Auto"], "surname": ["Meier", "Auto"],
        "city": ["Bern ", "Anna", "Meier", "Ulm"]}.items()}
    stops = [spark.createDataFrame([("auto",)], "token string")]
    got = lexicon.build_lexicon(tables, stops)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert {(r.token, r.source) for r in got.collect()} == {
        ("12345", "postcode"), ("MEIER", "surname"), ("BERN", "city"), ("ANNA", "city")}


def test_hot_token_and_size_check(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("und der Hans "), F.col("id").cast("string")).alias("text"))
    names = spark.createDataFrame([("HANS", "<VORNAME>"), ("7", "<X>")], "token string, tag string")
    results = []
    for max_rows in (100, 1):
        tagged = lexicon.tag_tokens(df, "text", names, "id", max_rows=max_rows)
        results.append(sorted(map(tuple, tagged.collect())))
    assert results[0] == results[1]
    assert results[0][7] == (7, "und der <VORNAME> <X>") and results[0][8][1].endswith(" 8")
    assert collect_if_small(df, 2999) is None and collect_if_small(df, 3000).num_rows == 3000


def test_lexicon_differences_and_lengths(spark):
    def table(*tokens):
        return spark.createDataFrame([(t,) for t in tokens], "token string")

    built = lexicon.build_lexicon({
        "first_name": table("Anna", "Berlin", "Meier", "Kurz", "Ute", None),
        "surname": table("Meier", "gehen", "Kurz"),
        "city": table("Berlin  ", "Anna", "Meier"),
        "postcode": table("12345", "BERLIN"),
        "vin_short": table("AB12345"), "vin_long": table("W1234567890123456"),
    }, [table("gehen", "kurz")])
    got = {(r.source, r.token) for r in built.collect()}
    assert got == {
        ("surname", "MEIER"), ("city", "BERLIN"), ("city", "ANNA"),
        ("postcode", "12345"), ("vin_short", "AB12345"), ("vin_long", "W1234567890123456"),
    }
    df = spark.createDataFrame([(1, "Meier, AB12345 in Berlin 12345!")], "id int, text string")
    masked = lexicon.mask_gazetteers(df, "text", built, "id").first().text
    assert masked == "<NACHNAME> <VIN> in <STADT> <PLZ>"


def test_senders_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "`from` string")
    senders = spark.createDataFrame([("a",), (None,)], "token string")
    assert sorted(map(str, (r[0] for r in filters.drop_senders(df, senders).collect()))) == ["None", "b"]
    kept = tables.keys_in(df, "from", senders.withColumnRenamed("token", "from"))
    dropped = tables.keys_without(df, "from", senders.withColumnRenamed("token", "from"))
    assert kept.count() + dropped.count() == df.count()


def test_sender_class(one):
    classify = lambda c: filters.sender_class(c, ["bank.example"])
    assert one("X <a@ARCOR.de>", classify) == "private"
    assert one("a@partner.bank.example", classify) == "company"
    assert one(None, classify) == "other"


def test_last_file_wins(spark):
    rows = spark.createDataFrame([("k", "b", 2), ("k", "a", 1), ("l", "c", 1)], "doc_key string, t string, o int")
    assert {(r.doc_key, r.t) for r in joins.last_per_key(rows, "doc_key", "o").collect()} == {("k", "b"), ("l", "c")}


def test_numbering_equals_sorting(spark):
    df = spark.range(500).select("id", (F.col("id") * 7919 % 10).alias("v"))
    numbered = ordering.number_rows(df, F.asc("v"), F.desc("id")).collect()
    assert [r.row_nr for r in sorted(numbered, key=lambda r: (r.v, -r.id))] == list(range(500))
    part = ordering.slice_rows(df, 10, 20, F.asc("v"), F.desc("id")).collect()
    assert Counter(part) == Counter(df.orderBy(F.asc("v"), F.desc("id")).offset(10).limit(10).collect())


def test_running_total_of_sparse_orders(spark):
    """Time stamps and names as order, ties, nulls, a value that holds a third of the rows."""
    rng = random.Random(2)
    rows = [(None if i % 97 == 0 else 1_500_000_000 if i % 3 == 0 else rng.randrange(2_000_000_000), i % 11) for i in range(2000)]
    df = spark.createDataFrame(rows, "s long, v long").withColumn("t", F.timestamp_seconds("s"))
    got = ordering.running_total(df, "t", "v", block=100).collect()
    first = lambda s: -1 if s is None else s
    expected = {s: sum(v for r, v in rows if first(r) <= first(s)) for s in {r[0] for r in rows}}
    assert len(got) == len(rows) and all(r.total == expected[r.s] for r in got)
    by_name = ordering.running_total(spark.createDataFrame([("b", 2), ("a", 1), ("c", 4)], "n string, v int"), "n", "v", block=1)
    assert sorted((r.n, r.total) for r in by_name.collect()) == [("a", 1), ("b", 3), ("c", 7)]


def test_blocks_of_a_running_total_follow_the_rows(spark):
    sums = spark.range(5000).select(F.pow(F.lit(1.003), "id").alias("o"), F.lit(1).alias("v"))
    parts = sums.repartitionByRange(-(-5000 // 500), "o").groupBy(F.spark_partition_id()).count()
    assert parts.agg(F.max("count")).first()[0] < 1000  # by value nearly all would share the first block
    assert ordering.running_total(sums, "o", "v", block=500).agg(F.max("total")).first()[0] == 5000


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a = ordering.sample_rows(df.repartition(3), 5, "id", 1).collect()
    b = ordering.sample_rows(df.coalesce(1), 5, "id", 1).collect()
    assert a == b and len(a) == 5


def _document(doc_id, flag, fields=""):
    return (f'<DOCUMENT DocID="{doc_id}" ExportName="T" AlteredBy="A"><FIELD Name="imp_EDOC-isBody" Value="{flag}"/>'
            f'{fields}</DOCUMENT>')


def test_archives(spark):
    body = '<FIELD Name="imp_EDOC-Body" Value="B{0}"/><G><FIELD Value="S&lt;{0}" Name="imp_EDOC-Subject"/></G>'
    archives = [
        ("none", f'<S StackID="1"><PROCESS ProcessID="p">{_document("d", 0)}</PROCESS></S>'),
        ("two", '<S StackID="2"><PROCESS ProcessID="p">' + _document("x", 0) + '</PROCESS><PROCESS ProcessID="q">'
         + _document("y", 1, body.format(1)) + _document("z", 1, body.format(2)) + "</PROCESS></S>"),
        # the id is flagged in the second process, so the first one counts too
        ("shared", '<S StackID="3"><PROCESS ProcessID="p">' + _document("d", 0, body.format(3)) + '</PROCESS>'
         '<PROCESS ProcessID="q">' + _document("d", 1) + "</PROCESS></S>"),
    ]
    df = spark.createDataFrame(archives, "file string, xml string")
    expected = {("two", "q", "y", "B1", "S<1"), ("shared", "p", "d", "B3", "S<3")}
    fields = archive.explode_fields(df, wrappers=("G",))
    in_row = archive.bodies_in_row(df, wrappers=("G",))
    for result in (archive.first_body(df), archive.archive_mails(fields), in_row):
        rows = result.select("file", "process_id", "doc_id", "body", "subject").collect()
        assert set(map(tuple, rows)) == expected
    everything = archive.archive_mails(fields, all_bodies=True)
    assert everything.exceptAll(archive.bodies_in_row(df, wrappers=("G",), all_bodies=True)).count() == 0
    assert sorted(r.body or "" for r in everything.collect()) == ["", "B1", "B2", "B3"]
    assert everything.filter("channel is not null").count() == 0


def test_first_body_at_any_depth(spark):
    """Fields of one name at several depths, in either order: the first in the file counts."""
    field = lambda n, v: f'<FIELD Name="imp_EDOC-{n}" Value="{v}"/>'
    deep = f'<A><B><C>{field("Subject", "deep")}</C></B>{field("From", "a")}</A>'
    rows = {
        "deep": _document("d", 1, deep + field("Body", "b")),
        "late": _document("d", 1, deep + field("Subject", "near") + field("From", "n")),
        "early": _document("d", 1, field("Subject", "near") + deep),
        "twice": _document("d", 1, f'<B>{field("Subject", "1")}</B><A>{field("Subject", "2")}</A><B>{field("Subject", "3")}</B>'),
        "flag below": _document("d", 0, "<A>" + field("isBody", 1) + "</A>" + field("Subject", "s")),
        "empty": "",
    }
    texts = [(k, f'<S StackID="1"><PROCESS ProcessID="p">{d}</PROCESS></S>') for k, d in rows.items()]
    df = spark.createDataFrame([*texts, ("broken", "<S><PROCESS>"), ("nothing", None)], "file string, xml string")
    assert set(archive.field_nesting(df)) == {"A", "B", "A/B/C"}
    got = {r.file: (r.subject, r["from"], r.body) for r in archive.first_body(df).collect()}
    assert got == {
        "deep": ("deep", "a", "b"), "late": ("deep", "a", None), "early": ("near", "a", None),
        "twice": ("1", None, None), "flag below": ("s", None, None)}
    plan = _plan(archive.first_body(df))
    assert plan.count("from_xml(") == 1 and "Exchange" not in plan
    assert archive.field_nesting(df.limit(0)) == ()


def test_files_and_invalid_utf8(spark, tmp_path):
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (tmp_path / "1.txt").write_text("Text\nzwei", encoding="utf-8")
    (deep / "1_index.x.txt").write_text("Index", encoding="utf-8")
    (deep / "2.txt").write_bytes(b"\xff\xfe")
    (deep / "3.csv").write_text("x")
    good, bad = files.split_invalid(files.scan_text_files(spark, str(tmp_path)))
    assert [r.path.rsplit("/", 1)[1] for r in bad.collect()] == ["2.txt"]
    index, body = files.split_index_and_body(good)
    row = joins.align_index_and_body(index, body, order="__order").first()
    assert (row.doc_key, row.indexstring, row.rawbody) == ("1", "Index", "Text\nzwei")
    assert files.scan_named_files(spark, str(tmp_path), "2.txt").count() == 1


def test_containers_in_load_order(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"message_id": ["c", "a"]}), tmp_path / "Mailcontainer_02.parquet")
    pq.write_table(pa.table({"message_id": ["a", "b"], "subject": ["x", "y"]}), tmp_path / "Mailcontainer_01.parquet")
    loaded = load_containers(spark, str(tmp_path), first="Mailcontainer_02.parquet",
                             schema="message_id string, subject string")
    kept = dedup.keep_first(loaded, "message_id", "file_seq", "row_seq")
    assert {(r.message_id, r.subject) for r in kept.collect()} == {("c", None), ("a", None), ("b", "y")}


def test_save_and_read_back(spark, tmp_path):
    import datetime as dt

    df = spark.createDataFrame([("a\t\"b\"\nc", ["x", "y"], b"\x00\xff")], "t string, f array<string>, b binary")
    text_path, table_path = sinks.save_container(df, str(tmp_path), day=dt.date(2020, 7, 5))
    assert text_path.endswith("Mailcontainer_05-07-2020.csv")
    back = sinks.read_saved_text(spark, text_path, sinks.as_text_columns(df).schema).first()
    assert (back.t, back.f, back.b) == ("a\t\"b\"\nc", '["x","y"]', "AP8=")
    assert spark.read.parquet(table_path).first() == df.first()


def test_null_and_empty_texts_are_told_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, " a ", None)], "i int, t string, u string")
    text_path, _ = sinks.save_container(df, str(tmp_path))
    assert sorted(map(tuple, sinks.read_saved_text(spark, text_path, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_a_failed_save_leaves_nothing(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1,)], "a int")

    def fail(_):
        raise OSError("second write")

    monkeypatch.setattr(sinks, "as_text_columns", fail)
    with pytest.raises(OSError, match="second write"):
        sinks.save_container(df, str(tmp_path))
    assert list(tmp_path.iterdir()) == []
    monkeypatch.undo()
    paths = sinks.save_container(df, str(tmp_path))
    with pytest.raises(FileExistsError):
        sinks.save_container(df, str(tmp_path))
    assert [spark.read.parquet(paths[1]).count(), len([p for p in tmp_path.iterdir() if not p.name.startswith(".")])] == [1, 2]


def test_a_failed_move_is_undone(spark, tmp_path):
    from postsieve.sources.publish import publish

    for name in ("a", "b", "taken"):
        (tmp_path / name).write_text(name)
    with pytest.raises(FileExistsError):
        publish(spark, [(f"{tmp_path}/a", f"{tmp_path}/moved"), (f"{tmp_path}/b", f"{tmp_path}/taken")])
    assert sorted(p.name for p in tmp_path.iterdir() if p.suffix != ".crc") == ["a", "b", "taken"]
    assert (tmp_path / "taken").read_text() == "taken"


def test_earlier_stages_are_kept(spark, tmp_path):
    folder = str(tmp_path)
    sinks.save_stage(spark.range(3), folder, "selected")
    assert sinks.save_stage(spark.range(5), folder, "selected").count() == 5
    assert sinks.stage_versions(spark, folder, "selected") == [1, 2]
    assert sinks.load_stage(spark, folder, "selected").count() == 5
    assert sinks.load_stage(spark, folder, "selected", version=1).count() == 3
    broken = spark.range(2).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        sinks.save_stage(broken, folder, "selected")
    assert sinks.stage_versions(spark, folder, "selected") == [1, 2]
    with pytest.raises(FileNotFoundError):
        sinks.load_stage(spark, folder, "other")


def test_step_report(spark):
    from postsieve.operators.profiling import StepReport

    steps = StepReport()
    df = steps.count(spark.range(100), "all")
    df = steps.count(df.filter("id % 4 = 0"), "fourth")
    assert df.count() == 25
    assert sorted(map(tuple, steps.table(spark).collect())) == [(1, "all", 100, 1.0), (2, "fourth", 25, 0.25)]


def test_archives_that_lose_bytes_are_listed(spark, tmp_path):
    head = '<?xml version="1.0" encoding="{}"?><S>{}</S>'
    for name, content in {
        "good": head.format("utf-8", "für").encode(), "latin": head.format("iso-8859-1", "für").encode("latin-1"),
        "bad": head.format("utf-8", "für").encode("latin-1"), "open": b"<S><P></S>", "odd": head.format("odd-1", "x").encode(),
        "cut": head.format("ascii", "für").encode("latin-1"),
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "Export.xml").write_bytes(content)
    errors = files.archive_errors(files.scan_archives(spark, str(tmp_path)))
    assert {r.path.split("/")[-2]: r.error for r in errors.collect()} == {
        "bad": "malformed bytes", "open": "not well-formed", "odd": "unknown charset", "cut": "malformed bytes"}


def test_entities_in_a_text(spark):
    from postsieve.operators.spans import mask_entities

    df = spark.createDataFrame([("Anna wohnt in Ulm",), ("nichts",), (None,)], "t string")
    entities = lambda t: F.when(t.startswith("Anna"), F.array(F.struct(
        F.lit(0).alias("start"), F.lit(4).alias("end"), F.lit("PER").alias("label"))))
    assert [r.t for r in mask_entities(df, "t", entities).collect()] == ["<PER> wohnt in Ulm", "nichts", None]
    assert mask_entities(df, "t", None) is df


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF(" Stapel ID ", "Auto matisch x")
    assert normalize_names(df).columns == ["STAPEL_ID", "AUTOMATISCH_X"]


def test_archive_fields_are_read_once(spark):
    xml = ('<STACK StackID="S"><PROCESS ProcessID="P"><DOCUMENT DocID="a"><FIELD Name="imp_EDOC-Body" Value="x"/></DOCUMENT>'
           '<DOCUMENT DocID="b"><FIELD Name="imp_EDOC-Body" Value="y"/></DOCUMENT>'
           '<DOCUMENT DocID="b"><FIELD Name="imp_EDOC-isBody" Value="1"/><FIELD Name="imp_EDOC-Body" Value="z"/></DOCUMENT>'
           '</PROCESS></STACK>')
    df = spark.createDataFrame([("f", xml)], "file string, xml string")
    fields = archive.explode_fields(df)
    assert [r.body for r in archive.archive_mails(fields).collect()] == ["y"]
    mails = archive.archive_mails(fields, all_bodies=True)
    assert sorted(r.body for r in mails.collect()) == ["y", "z"]
    assert mails._jdf.queryExecution().optimizedPlan().toString().count("Generate posexplode(x") == 1
    for every, bodies in ((False, ["y"]), (True, ["y", "z"])):
        assert [r.body for r in archive.bodies_in_row(df, all_bodies=every).collect()] == bodies


def test_first_body_needs_no_search_of_the_ids_for_every_document(spark):
    df = spark.createDataFrame([("f", "<A/>")], "file string, xml string")
    assert "array_contains" not in archive.bodies_in_row(df)._jdf.queryExecution().analyzed().toString()


def test_a_small_lookup_of_large_estimate_is_collected(spark):
    df = spark.range(1000).select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("token")).distinct()
    assert collect_if_small(df, max_bytes=1000).num_rows == 10


def test_bodies_are_decoded_once(spark):
    """The filter on decoded bodies stays above the decoding, also with a join below."""
    from postsieve.plans.mail_corpus import decode_mails, undecoded_mails

    bodies = spark.createDataFrame([(1, b"a"), (2, b"\xfc"), (3, None)], "k int, body binary")
    names = spark.createDataFrame([(1, "utf-8"), (2, "nonsense-8"), (3, "utf-8")], "k int, encoding string")
    mails = bodies.join(names, "k").withColumn("body", F.concat("body", F.encode(F.lit(" "), "UTF-8")))
    for result, left in ((decode_mails(mails), [1]), (undecoded_mails(mails), [2])):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        assert not any("utf" in line for line in plan.splitlines() if "Filter" in line)
        assert sorted(r.k for r in result.collect()) == left


def test_nesting_is_searched_in_the_shapes_of_the_files(spark):
    """Files that differ in attributes, texts and numbers of fields are one shape; others keep their text."""
    field = "<FIELD Name='a > b' Value=\"{}\"/>"
    xml = '<S StackID="{0}"><PROCESS ProcessID="p">{1}</PROCESS></S>'.format
    plain = [xml(i, _document(i, 1, f"<G i='{i}'>\n{field.format(i) * (i + 1)}t{i}</G>")) for i in range(3)]
    plain.append(xml(9, _document(9, 1, f"<G>{field.format(9) * 20_000}</G>")))
    df = spark.createDataFrame([(x,) for x in plain], "xml string")
    assert df.select(archive._shape(F.col("xml"))).distinct().count() == 1
    assert archive.field_nesting(df) == ("G",)
    kept = [
        xml(1, _document(1, 1, f"<H><!-- <I>{field}</I> --><![CDATA[<K>{field}</K>]]>{field}</H>")),
        xml(2, _document(2, 1, f'<n:L xmlns:n="u"><M>{field}</M></n:L>')),
        '<?xml version="1.0"?>' + xml(3, _document(3, 1, f"<O><?p <Q>?><R>{field}</R></O>")),
    ]
    nested = archive.field_nesting(spark.createDataFrame([(x,) for x in plain + kept], "xml string"))
    assert {"G", "H", "O/R"} <= set(nested) and not {"I", "H/I", "H/K", "Q"} & set(nested)


def test_archives_are_parsed_once_for_the_mail_build(spark):
    from postsieve.plans.ingest import archive_container

    xml = '<S StackID="1"><PROCESS ProcessID="p">' + _document("d", 1, '<FIELD Name="imp_EDOC-Body" Value="b"/>') + "</PROCESS></S>"
    df = spark.createDataFrame([("f", xml)], "file string, xml string")
    container = archive_container(archive.bodies_in_row(df), received_format="d.M.yyyy H:mm")
    assert [(r.mid, bytes(r.body)) for r in container.collect()] == [("f", b"b")]
    assert "from_xml(" not in _plan(container)


def test_joined_tokens_need_no_search_of_the_hits_for_every_token(spark):
    table = spark.createDataFrame([("A", "<1>"), ("B", "<2>"), (None, "<3>")], "token string, tag string")
    rows = [(1, "a, x B a"), (1, "y"), (None, "b"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "key int, text string")
    joined = lexicon.tag_tokens(df, "text", table, "key", "out", max_rows=0)
    assert sorted((r.text or "", r.out) for r in joined.filter("text IS NOT NULL").collect()) == [
        ("", ""), ("a, x B a", "<1> , x <2> <1>"), ("b", "<2>"), ("y", "y")]
    assert [r.out for r in joined.filter("text IS NULL").collect()] == [None]
    assert joined.columns == ["key", "text", "out"]
    assert "map_from_entries" not in _plan(joined)


def test_long_lists_of_senders_move_no_mail(spark, monkeypatch):
    rows = [(i, None if i % 7 == 0 else f"s{i % 40}") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, `from` string")
    senders = spark.createDataFrame([(f"s{i}",) for i in range(0, 60, 3)] * 2 + [(None,)], "token string")
    expected = sorted(i for i, s in rows if s is None or int(s[1:]) % 3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bits in (dedup.FILTER_BITS, 64):  # the small filter marks most senders
            monkeypatch.setattr(dedup, "FILTER_BITS", bits)
            # a list that goes out whole, one by its bits, and one whose wrongly marked senders are too many
            for max_rows, small in ((1000, True), (19, True), (0, bits > 64)):
                kept = filters.drop_senders(df, senders, max_rows=max_rows)
                assert kept.columns == ["id", "from"] and sorted(r.id for r in kept.collect()) == expected
                if small:
                    assert "SortMergeJoin" not in _plan(kept)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_report_fans_out_behind_a_broadcast(spark):
    from postsieve.operators.joins import with_report

    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "n"), (3, "z")], "batchid long, body string")
    report = spark.createDataFrame(
        [(1, "a")] * 3 + [(1, "b"), (2, None), (2, None), (None, "q"), (9, "r")], "stapel_id long, status string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left", "inner", "full"):
            plain = df.join(report, df["batchid"] == report["stapel_id"], how)
            expected = sorted(map(tuple, plain.collect()), key=str)
            for max_rows in (100, 0):
                joined = with_report(df, report, how=how, max_rows=max_rows)
                assert joined.columns == plain.columns and sorted(map(tuple, joined.collect()), key=str) == expected
                assert ("SortMergeJoin" in _plan(joined)) == (how == "full" or not max_rows)
        once = with_report(df, report.distinct())
        assert "Generate" not in _plan(once) and once.count() == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
