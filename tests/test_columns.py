"""Index strings, tokens, headers, charsets, spans."""

import pytest
from pyspark.sql import functions as F

from postsieve.functions import headers as H
from postsieve.functions import index_string as K
from postsieve.functions.charset import decode_body, propose_charset
from postsieve.functions.tokens import tokens, words
from postsieve.operators.spans import mask_spans

ITEMS = [
    "Klasse", "Inhalt", "{Batch ID}", "123456", "{Document ID}", "1234567", "DocumentType",
    "Typ1", "ClassificationResultWithConfiden", "Typ1;0.9;A|Typ2;0.1;B", "PageCount", "3.0",
    "{Document Count}", "2", "{$InputChannel}", "Mail", "{$sourceSystem}", "Q1",
    "AutoClassificationConfidence", "1",
]


def _index(items):
    return ",".join(f'"{i}"' for i in items)


def test_parse_positions(spark):
    short = _index(ITEMS[:18])
    rows = spark.createDataFrame([(_index(ITEMS),), (short,)], "indexstring string")
    full, cut = K.parse_positions(rows).collect()
    assert (full.batchid, full.docid, full.doctype) == (123456, 1234567, "Typ1")
    assert (full.pagecount, full.doccount, full.autoclass) == (3, 2, True)
    assert full.confidence == ["Typ1;0.9;A", "Typ2;0.1;B"] and full.nbr_doctypes == 2
    assert cut.autoclass is None
    chars = K.parse_positions(rows, nbr_doctypes="chars").first()
    assert chars.nbr_doctypes == len(ITEMS[9])


def test_malformed_id_is_strict_or_null(spark):
    items = [*ITEMS]
    items[3] = "abc"
    rows = spark.createDataFrame([(_index(items),)], "indexstring string")
    assert K.parse_positions(rows, strict=False).first().batchid is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        K.parse_positions(rows).collect()


def test_parse_keys(spark):
    items = [*ITEMS]
    items[11] = "3"
    missing = [*items]
    missing[15] = ""
    rows = spark.createDataFrame([(_index(items),), (_index(missing),)], "indexstring string")
    good, bad = K.parse_keys(rows).collect()
    assert not good.error and good.pagecount == 3 and good.confidence == ITEMS[9]
    assert bad.error and bad.inputchannel is None


def test_unpack_confidence(one):
    unpacked = one(ITEMS[9], K.unpack_confidence)
    assert [(u.score, u.doc_type, u.code) for u in unpacked] == [(0.9, "Typ1", "A"), (0.1, "Typ2", "B")]


def test_fill_with_median(spark):
    rows = spark.createDataFrame([(1,), (2,), (5,), (6,), (None,)], "n bigint")
    assert sorted(r.n for r in K.fill_with_median(rows, "n").collect()) == [1, 2, 3, 5, 6]


def test_tokens(one):
    text = '  "Hallo", <a.b@mail.example>! (https://x.example/a?b=1) -- it\'s '
    assert one(text, tokens) == [
        '"', "Hallo", '"', ",", "<", "a.b@mail.example", ">", "!", "(",
        "https://x.example/a?b=1", ")", "-", "-", "it's",
    ]
    assert one(text, words) == ["Hallo", "a.b@mail.example", "https://x.example/a?b=1", "it's"]
    assert one("", tokens) == [] and one(" \n", words) == []


def test_headers(one):
    both = "=?utf-8?B?R3LDvMOfZQ==?= =?utf-8?B?eA==?="
    assert one(both, H.decode_subject) == "Grüßex"
    assert one(both, lambda c: H.decode_subject(c, first_only=True)) == "Grüße"
    assert one("ohne", H.decode_subject) == "ohne"
    assert one(None, H.known_encoding) == "unknown"
    assert one("abc", lambda c: H.message_id(F.lit("01-02-2020"), F.lit("10:11:12"), c)) == "01-02-2020_10:11:12_3"


def test_charsets(spark):
    text = "Grüße – 5 €"
    cases = [
        (text.encode("utf-8"), "UTF-8", text),
        (text.encode("utf-8") + b"\xff", "utf8", text),
        ("a�b".encode("utf-8"), "utf-8", "a�b"),
        (text.encode("cp1252") + b"\x81", "windows-1252", text),
        ("Grüße 5 €".encode("iso-8859-15"), "ISO-8859-15", "Grüße 5 €"),
        ("Grüße".encode("latin-1"), "latin1", "Grüße"),
        ("Grüße".encode("latin-1"), "us-ascii", "Gre"),
        (text.encode("utf-16"), "utf-16", text),
        ("привет".encode("koi8-r"), "koi8-r", "привет"),
        (b"abc", "nonsense-8", None),
        (None, "koi8-r", None),
    ]
    df = spark.createDataFrame([(b, e) for b, e, _ in cases], "body binary, encoding string")
    got = df.select(decode_body(F.col("body"), F.col("encoding")).alias("t")).collect()
    assert [r.t for r in got] == [t for *_, t in cases]


def test_proposals(spark):
    cases = [
        (b"", None), (b"abc", "ascii"), ("ü".encode(), "utf-8"), (b"\xef\xbb\xbfabc", "utf-8-sig"),
        ("ü".encode("utf-16"), "utf-16"), (b"\xfc abc", "iso-8859-1"), (b"\x84abc\x93\xfc", "windows-1252"),
    ]
    df = spark.createDataFrame([(b,) for b, _ in cases], "body binary")
    got = df.select(propose_charset(F.col("body")).alias("p")).collect()
    assert [r.p.encoding for r in got] == [e for _, e in cases]


def test_mask_spans(spark):
    spans = "array<struct<start:int,end:int,label:string>>"
    df = spark.createDataFrame(
        [("Änna aus Köln.", [(9, 13, "LOC"), (0, 4, "PER")]), ("x y", [(0, 1, "MISC")]), ("", [])],
        f"text string, spans {spans}",
    )
    got = [r.m for r in df.select(mask_spans(F.col("text"), F.col("spans")).alias("m")).collect()]
    assert got == ["<PER> aus <LOC>.", "x y", ""]
