"""Message files of all shapes, and files that arrive day by day."""

from email.message import EmailMessage

from pyspark.sql import functions as F

from postsieve.plans.ingest import ingest_archives, ingest_messages
from postsieve.schemas import MAIL_CONTAINER
from postsieve.sources.files import scan_messages
from postsieve.sources.messages import header_fields, parse_messages
from postsieve.streaming import daily

DATE = "Tue, 05 May 2020 23:30:00 +0200"


def _write(folder):
    plain = EmailMessage()
    plain["From"], plain["To"], plain["Subject"], plain["Date"] = "a@mail.example", "b@mail.example", "Frage", DATE
    plain.set_content("Hällo", charset="iso-8859-1")
    (folder / "1.eml").write_bytes(plain.as_bytes())

    nested = EmailMessage()
    nested["From"], nested["Date"] = "c@mail.example", DATE
    nested["Subject"] = "Grüße an alle"
    nested["Message-ID"] = "<1@mail.example>"
    nested.set_content("Text")
    nested.add_alternative("<p>Text</p>", subtype="html")
    nested.add_attachment(b"x", maintype="application", subtype="pdf", filename="vertrag.pdf")
    nested.add_attachment(b"y", maintype="application", subtype="x-unknown-kind")
    (folder / "deep").mkdir()
    (folder / "deep" / "2.eml").write_bytes(nested.as_bytes())

    (folder / "3.eml").write_bytes(b"From: a@mail.example\nSubject: ohne Datum\n\nText")
    (folder / "4.eml").write_bytes(b"\n\n")


def test_message_files(spark, tmp_path):
    _write(tmp_path)
    container, errors = ingest_messages(spark, str(tmp_path), attachments=True)
    assert container.schema.names == MAIL_CONTAINER.names
    rows = {r.mid.rsplit("/", 1)[1]: r for r in container.collect()}
    assert sorted(rows) == ["1.eml", "2.eml"]
    assert sorted(r.mid.rsplit("/", 1)[1] for r in errors.collect()) == ["3.eml", "4.eml"]
    one, two = rows["1.eml"], rows["2.eml"]
    # the sender's clock, not UTC
    assert (one.date, one.time, one.encoding) == ("05-05-2020", "23:30:00", "unknown")
    assert bytes(one.body).decode("latin-1").strip() == "Hällo"
    assert one.message_id == "05-05-2020_23:30:00_5"
    assert (one.files, one.nbr_files, one.specfiles) == (["msg-part-00000001.txt"], 1, [])
    assert (two.encoding, two.subject, two.umid) == ("utf-8", "Grüße an alle", "<1@mail.example>")
    assert two.files == ["msg-part-00000001.txt", "msg-part-00000002.html", "vertrag.pdf", "msg-part-00000004.bin"]
    assert (two.specfiles, two.nbr_specfiles) == (["vertrag.pdf"], 1)
    assert bytes(two.body).strip() == b"Text"

    unread, _ = ingest_messages(spark, str(tmp_path), attachments=False)
    assert {(r.nbr_files, tuple(r.files)) for r in unread.collect()} == {(999, ())}
    first, first_errors = ingest_messages(spark, str(tmp_path), nbr=2)
    assert first.count() + first_errors.count() == 2


def test_header_fields(spark, tmp_path):
    _write(tmp_path)
    parsed = parse_messages(scan_messages(spark, str(tmp_path), "1.eml"))
    row = header_fields(parsed).first()
    assert (row["to"], row["from"], row.sub, row.date_raw) == ("b@mail.example", "a@mail.example", "Frage", DATE)
    assert row.bcc is None and row.ctype.startswith("text/plain")


def test_headers_without_python(spark):
    """Folded, missing, empty and repeated headers, both line ends, other charsets: as the mail library reads them."""
    import email

    from dateutil import parser as date_parser

    from postsieve.functions.headers import HEADER_NAMES
    from postsieve.sources.messages import read_headers

    dates = [DATE, "5 May 2020 7:03 GMT", "Mon, 01 Jan 2018 23:59:59 -0800 (PST)", "Tue,  5 MAY 2020 01:02:03 +0000"]
    others = ["2020-05-05 10:00", "Tue, 31 Feb 2020 10:00:00 +0000", "", "Tue, 05 May 20 10:00:00 +0000"]
    messages = [f"From: a\nDate: {d}\nSubject: s\n\nSubject: body".encode() for d in [*dates, *others]]
    messages += [
        b"SUBJECT:  folded\r\n\tover lines \r\nto:x\r\nTo: y\r\nCc:\r\n\r\nBcc: z",
        b"Subject:\n begins later\nFrom: a\nX-Subject: other\nMessage-ID: <1>\n\nx\n\ny",
        "Subject: Grüße\nFrom: ä\n\n".encode(), b"\n\nSubject: body", b"\r\nSubject: body", b"", b"Subject: end",
        b"Subject: a: b: c\nContent-Type: text/plain;\n charset=x\nContent-Transfer-Encoding: 8bit",
    ]
    df = spark.createDataFrame([(str(i), bytearray(m)) for i, m in enumerate(messages)], "mid string, content binary")
    headers = read_headers(df)
    assert "Python" not in headers._jdf.queryExecution().executedPlan().toString()
    got = {int(r.mid): r for r in headers.collect()}
    for i, message in enumerate(messages):
        known = email.message_from_bytes(message)
        for name, title in HEADER_NAMES.items():
            value = known[title]
            if value is None or str(value).isascii() and "\ufffd" not in str(value):
                assert got[i][name] == value, (i, name)
    for i, date in enumerate(dates):
        sent = date_parser.parse(date)
        assert (got[i].date, got[i].time) == (sent.strftime("%d-%m-%Y"), sent.strftime("%H:%M:%S"))
    assert all(got[len(dates) + i].date is None for i in range(len(others)))
    # the parser knows other forms of dates too
    parsed = {int(r.mid): r for r in parse_messages(df).collect()}
    assert (parsed[4].date, parsed[4].time, parsed[4].error) == ("05-05-2020", "10:00:00", None)
    assert parsed[5].error and parsed[5].date is None


def test_messages_are_parsed_once(spark, tmp_path):
    _write(tmp_path)
    for result in ingest_messages(spark, str(tmp_path)):
        assert "Python" not in result._jdf.queryExecution().executedPlan().toString()


def test_first_arrival_in_load_order(spark, tmp_path):
    """Of one trigger the first in load order; an earlier trigger goes before."""
    schema = "message_id string, file_seq int, row_seq int, body string"
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def arrive(*rows):
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(source)
        stream = daily.keep_first_arrival(daily.stream_containers(spark, source, schema))
        daily.append_new(stream, target, progress).awaitTermination()
        return sorted((r.message_id or "", r.body) for r in spark.read.schema(schema).parquet(target).collect())

    first = [("a", 1, 2, "late"), ("a", 1, 1, "first"), ("b", 2, 1, "b"), (None, 1, 5, "no id"), (None, 1, 4, "no id first")]
    known = [("", "no id first"), ("a", "first"), ("b", "b")]
    assert arrive(*first) == known
    assert arrive(("a", 3, 1, "again"), ("c", 3, 2, "c")) == [*known, ("c", "c")]


def test_first_arrival_settles_many_keys_in_one_call(spark, tmp_path):
    """Keys of one bucket share a call and a state: 1,500 mails take a few calls, not one each."""
    schema = "message_id string, file_seq int, row_seq int, body string"
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def arrive(file_seq, numbers):
        rows = [(f"m{n}" if n else None, file_seq, row, f"{file_seq}-{row}") for n in numbers for row in (2, 1)]
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(source)
        stream = daily.keep_first_arrival(daily.stream_containers(spark, source, schema), buckets=4)
        query = daily.append_new(stream, target, progress)
        query.awaitTermination()
        states = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        return states, {(r.message_id, r.body) for r in spark.read.schema(schema).parquet(target).collect()}

    name = lambda n: f"m{n}" if n else None
    early = {(name(n), "1-1") for n in range(1000)}
    assert arrive(1, range(1000)) == (4, early)
    assert arrive(2, range(500, 1500)) == (4, early | {(name(n), "2-1") for n in range(1000, 1500)})


def test_archive_files(spark, tmp_path):
    xml = ('<?xml version="1.0"?><S StackID="1"><PROCESS ProcessID="p"><DOCUMENT DocID="d" ExportName="T" AlteredBy="A">'
           '<FIELD Name="imp_EDOC-isBody" Value="1"/><FIELD Name="imp_EDOC-Body" Value="B"/></DOCUMENT></PROCESS></S>')
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "Export.xml").write_text(xml)
        (tmp_path / name / "Export2.xml").write_text(xml)
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "Export.xml").write_text(xml[:-4])
    for wrappers in (None, ("GROUP",)):
        bodies, errors = ingest_archives(spark, str(tmp_path), wrappers=wrappers)
        assert [(r.doc_id, r.body, r.subject) for r in bodies.collect()] == [("d", "B", None)] * 2
        assert [r.error for r in errors.collect()] == ["not well-formed"]


def test_archives_keep_their_charset(spark, tmp_path):
    from postsieve.sources.files import archive_errors, scan_archives

    xml = '<?xml version="1.0" encoding="{}"?><S><F Value="Grüße"/></S>'
    for name, charset in (("a", "iso-8859-1"), ("b", "utf-8"), ("c", "windows-1252")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "Export.xml").write_bytes(xml.format(charset).encode(charset))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "Export.xml").write_text("<S><F></S>")
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "Export.xml").write_text(xml.format("no-such-charset"))
    archives = scan_archives(spark, str(tmp_path))
    found = {r.file.rsplit("/", 2)[1]: r.xml for r in archives.collect()}
    assert all("Grüße" in found[k] for k in "abc") and found["e"] is None
    errors = {r.path.rsplit("/", 2)[1]: r.error for r in archive_errors(archives).collect()}
    assert errors == {"d": "not well-formed", "e": "unknown charset"}


def test_subjects_keep_every_fragment(spark):
    from email.header import decode_header, make_header

    from postsieve.functions.headers import decode_subject

    subjects = ["=?utf-8?B?R3LDvMOfZQ==?= an alle", "=?UTF-8?b?R3LDvA==?=\r\n =?utf-8?q?=C3=9Fe_an?= alle",
                "Re: =?iso-8859-1?Q?Gr=FC=DFe?=", "plain = ?text?", "", None]
    broken = ["=?utf-8?B?###?= x", "=?no-such?Q?a?= b"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate([*subjects, *broken])], "i int, s string")
    got = {r.i: r.s for r in df.select("i", decode_subject(F.col("s")).alias("s")).collect()}
    expected = [None if s is None else str(make_header(decode_header(s))) for s in subjects] + broken
    assert [got[i] for i in range(len(expected))] == expected
    first = df.select(decode_subject(F.col("s"), first_only=True).alias("s")).first()
    assert first.s == "Grüße"


def test_late_mails_stay(spark, tmp_path):
    schema = "message_id string, date string, time string"
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for n, (i, date) in enumerate((("new", "20-07-2020"), ("old", "01-01-2019"))):
        spark.createDataFrame([(i, date, "10:00:00")], schema).write.mode("append").parquet(source)
        stream = daily.drop_repeats(daily.stream_containers(spark, source, schema))
        daily.append_new(stream, target, progress).awaitTermination()
    assert sorted(r.message_id for r in spark.read.parquet(target).collect()) == ["new", "old"]


def test_daily_files_are_taken_once(spark, tmp_path):
    schema = "message_id string, date string, time string"
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def day(*ids):
        rows = [(i, "01-02-2020", "10:00:00") for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = daily.drop_repeats(daily.stream_containers(spark, source, schema))
        daily.append_new(stream, target, progress).awaitTermination()
        return sorted(r.message_id for r in spark.read.parquet(target).collect())

    day("a", "b", "a")
    assert run() == ["a", "b"]
    day("b", "c")
    assert run() == ["a", "b", "c"]
    assert run() == ["a", "b", "c"]


def test_a_filter_on_the_error_parses_once(spark):
    from postsieve.sources.messages import parse_messages

    df = spark.createDataFrame([("a", bytearray(b"From: x\n\ny"))], "mid string, content binary")
    plan = parse_messages(df).filter("error is null")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
