"""Masks: one positive and one near miss per rule, order effects, Unicode."""

import re

from pyspark.sql import functions as F

from postsieve.functions.masks import count_tag, finish, mask_one, mask_step, mask_text, with_masked_text
from postsieve.operators.filters import drop_failed
from postsieve.rules import mask_rules as M

CASES = [
    (M.INTRO, "Page 1 x\nBetreff: y Betreff: z", "<INTRO>  z", "Seite 1 Betreff: z"),
    (M.IBAN, "an DE12 3456 7890 1234 5678 90.", "an  <IBAN> .", "DE12 3456 7890 1234 5678"),
    (M.IBAN, "DE" + "1" * 20, " <IBAN> ", "DE" + "1" * 19),
    (M.LEASING_MANDATE, "LC1234X12345678", " <MREFLS> ", "LC1234X1234567"),
    (M.CREDIT_MANDATE, "CF123456789012", " <MREFCR> ", "CF12345678901"),
    (M.DATE, "am 31.12.2020 und 1.1.99", "am  <DATUM>  und  <DATUM> ", "am 31.13.2020"),
    (M.IDENTITY_CARD, "CFGHK1234", " <PASSPORT> ", "AFGHK1234"),
    (M.TAX_NUMBER, "x12/345/6789", "x <TAXNBR> ", "12/34/6789"),
    (M.TAX_ID, "49 166 582 708", " <TAXNBR> ", "09 166 582 708"),
    (M.TAX_ID, "12345678901", " <TAXNBR> ", "02345678901"),
    (M.PHONE, "Tel 0171 1234567", "Tel  <TELFAX> ", "Tel 171 1234567"),
    (M.PHONE, "+49 89 123456-12", " <TELFAX> ", "+48 89 123"),
    (M.PHONE, "(089) 12345", " <TELFAX> ", "(89) 12345"),
    (M.EMAIL, "an a.b+c@mail.example", "an  <EMAIL> ", "an a.b@mail"),
    (M.VIN_LONG, "W" + "A1" * 8, " <VIN> ", "W" + "A1" * 7),
    (M.VIN_SHORT, "AB12345", " <VIN> ", "ab12345"),
    (M.NUMBER_PLATE, "DON-Z1200 weg", " <KFZKZ> weg", "DON-Z0200 weg"),
    (M.NUMBER_PLATE, "M-AB 123x", " <KFZKZ> ", "M-AB 12."),
    (M.STAFF_NUMBER, "Q 506010", " <QNBR> ", "Q 5060"),
    (M.POSTCODE, "86609 Ort", " <PLZ>  Ort", "00609 Ort"),
    (M.DIGITS_6, "123456", " <666666> ", "12345"),
    (M.DIGITS_7, "1234567", " <7777777> ", "123456"),
    (M.DIGITS_8, "12345678", " <88888888> ", "1234567"),
    (M.DIGITS_9, "123456789", " <999999999> ", "12345678"),
    (M.DIGITS_10, "1234567890", " <1010101010> ", "123456789"),
    (M.URL, "siehe https://a.example/p?q=1 da", "siehe  <URL>  da", "siehe gopher://a.example"),
    (M.BARE_URL, "auf www.seite.example/hilfe", "auf  <URL> ", "auf seite . example"),
]


def test_rules(spark):
    columns = [
        mask_one(F.lit(text), rule)
        for rule, hit, _, miss in CASES for text in (hit, miss)
    ]
    got = list(spark.range(1).select(*columns).first())
    expected = [text for _, _, masked, miss in CASES for text in (masked, miss)]
    for case, value, wanted in zip([c for c in CASES for _ in "ab"], got, expected):
        assert value == wanted, case


def test_every_rule_has_a_case():
    assert {rule.key for rule, *_ in CASES} == {rule.key for rule in M.MASK_SEQUENCE}


def test_order_effects(one):
    # a leading zero makes a postcode a phone number
    assert one("in 01067 Ort", mask_text) == "in  <TELFAX>  Ort"
    # seven capitals count as a short vehicle id
    assert one("ACHTUNG bitte", mask_text) == "<VIN>  bitte"
    # masking twice hits the tags of the first pass
    once = one("Nr 223456 da", mask_text)
    assert once == "Nr  <666666>  da"
    assert one(once, mask_text) != once


def test_missing_text_and_strip(one):
    assert one(None, mask_text) == M.FAILED_TEXT
    assert one("  \t  Text \x85\n", mask_text) == "Text"


def _python_mask(text):
    for rule in M.MASK_SEQUENCE:
        text = re.sub(rule.pattern, rule.tag, text, flags=re.DOTALL if rule.dotall else 0)
    return text.strip()


def test_same_as_python_on_whole_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = with_masked_text(documents, "text", "masked").select("text", "masked").collect()
    assert rows and all(_python_mask(r.text) == r.masked for r in rows)


def test_same_as_python_on_unicode_identifiers(spark):
    texts = [
        "Ümläut ÄB12345 straße.müller@bücher.example 0171/1234567ä",
        "ß 86609é 123456ö  1.1.2020\u0085 www.größe.example",
        "Q-12345 Ö-AB 1234 ٣٣٣٣٣٣ DE" + "1" * 20 + "ü",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in with_masked_text(df, "text", "masked").collect():
        assert row.masked == _python_mask(row.text)


def test_long_paths_do_not_overflow_the_stack(one):
    text = "http://a" + ".b" * 20000 + " und c.d" + "/e" * 3000
    assert "<URL>" in one(text, mask_text)


def test_filter_on_masked_text_plans_quickly(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    masked = with_masked_text(documents, "text")
    assert masked.filter(~F.contains("text", F.lit("zzz"))).count() == documents.count()
    plan = drop_failed(masked, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(M.PHONE.tag) == 1


def test_nothing_left_to_mask(spark):
    from checks.registry import Context

    texts = Context(spark, "/root/testdata/sf0.001")("fx_pii")
    masked = with_masked_text(texts, "text")
    for rule in (M.IBAN, M.LEASING_MANDATE, M.CREDIT_MANDATE, M.DATE, M.IDENTITY_CARD,
                 M.TAX_NUMBER, M.TAX_ID, M.EMAIL):
        assert masked.filter(F.col("text").rlike("(?Ud)" + rule.pattern)).count() == 0, rule.key


def test_count_tag(one):
    assert one("<PLZ> und <PLZ>", lambda c: count_tag(c, "<PLZ>")) == 2


def test_hints_near_digits_miss_no_match(spark):
    """Rules are skipped by hints on the digits and their surroundings; the result is that of all rules."""
    from postsieve.functions.rewrite import apply_step, around_digits

    far = "ohne jede Ziffer steht hier ein langer Text "
    parts = [
        "DE12 3456 7890 1234 5678 42", "DE" + "1" * 20, "LC1234X12345678", "CF123456789012", "1.1.20", "31.12.2020",
        "CFGHK1234", "A1/234/56789", "49 166 582 123", "12345678901", "0171 1234567", "+49 89 1234-5", "0049(89)12345",
        "(089) 12345-6", "a.b@c.de", "WABX2123456789012", "AB12345", "DON-Z 1000 ", "m ab1234x", "Q 123456", "q-12345",
        "80331", "123456", "1234567", "12345678", "123456789", "1234567890", "1234567/123/1234", "٣٤٥٦٧٨", "x.de/a1",
    ]
    texts = [f"{a}{sep}{b}" for a in parts for b in parts[::3] for sep in ("", " ", f" {far}", "\n")]
    texts += [f"{far}{p} {far}{p}{far}" for p in parts] + ["", far, None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")

    def all_rules(col):
        for rule in M.MASK_SEQUENCE:
            col = apply_step(col, mask_step(rule))
        return finish(col)

    rows = df.select("v", mask_text(F.col("v")).alias("got"), all_rules(F.col("v")).alias("whole"),
                     around_digits(F.col("v")).alias("near")).collect()
    for row in rows:
        assert row.got == row.whole, row.v
    near = {row.v: row.near for row in rows}
    assert near[far] == "" and near["80331\n80331"] == "80331\n80331"
    text = f"{far}80331 {far}80331{far}"
    assert near[text] == f"{far[:8]}\n{far[-8:]}80331 {far[:7]}\n{far[-8:]}80331{far[:8]}\n{far[-8:]}"
