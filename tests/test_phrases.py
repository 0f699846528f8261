"""Phrase rules and their order effects."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from postsieve.functions import phrases as P
from postsieve.functions.rewrite import rewrite
from postsieve.rules import phrase_rules as R


def _mail(one, text, **options):
    return one(text, lambda c: P.clean_text(c, P.mail_steps(**options)))


def test_controls_and_rulers(one):
    assert one("a\r\n\tb c", P.replace_controls) == "a   b c"
    assert one("a--- b-_= c##", P.replace_rulers) == "a  b  c##"


def test_titles_join_words_in_compat_mode(one):
    assert _mail(one, "an Dr. Huber") == "anHuber"
    assert _mail(one, "an Drx Huber") == "anHuber"
    assert _mail(one, "an Dr. Huber", compat=False) == "an Huber"


def test_salutation_and_closing_order(one):
    assert _mail(one, "Sehr geehrter Kunde") == "<Anrede>r Kunde"
    assert _mail(one, "Sehr geehrter Kunde", compat=False) == "<Anrede> Kunde"
    assert _mail(one, "Guten Tag zusammen") == "<Anrede> zusammen"
    assert _mail(one, "Viele Grüße und MFG und MfG") == "<<MFG>> und <MFG> und <<MFG>>"
    assert _mail(one, "Viele Grüße und MFG", compat=False) == "<MFG> und <MFG>"


def test_one_pass_equals_phrase_after_phrase(spark):
    house = R.HouseTerms()
    salutations = [p.format(team=house.team, contact=house.contact) for p in R.SALUTATIONS]
    texts = [f"{a}{sep}{b}" for a in salutations for b in salutations for sep in ("", " ")]
    texts += [f"{a}{sep}{b}" for a in R.CLOSINGS for b in R.CLOSINGS for sep in ("", " ")]

    def sequence(phrases, tag):
        return lambda text: reduce(lambda t, p: t.replace(p, tag), phrases, text)

    df = spark.createDataFrame([(t,) for t in texts], "v string")
    rows = df.select(
        "v", rewrite(F.col("v"), P.salutation_steps()).alias("s"),
        rewrite(F.col("v"), P.closing_steps()).alias("c"),
    ).collect()
    for row in rows:
        assert row.s == sequence(salutations, R.SALUTATION_TAG)(row.v)
        assert row.c == sequence(R.CLOSINGS, R.CLOSING_TAG)(row.v)


def test_overlapping_house_terms_fall_back_to_the_listed_order(one):
    house = R.HouseTerms(team="Hallo Haus", contact="Morgen Gut")
    steps = P.salutation_steps(house)
    assert len(steps) == len(R.SALUTATIONS)
    assert one("Guten Morgen Gut", lambda c: rewrite(c, steps)) == "Guten <Anrede>"


def test_reply_and_footers(one):
    text = "Frage Am 1.1. schrieb service@bank.example: alt\nneu"
    assert _mail(one, text) == "Frage <TRIM EOFT>"
    assert _mail(one, "x von a gesendet von b gesendet y") == "x <VERSENDET-MIT> y"
    assert _mail(one, "Gesendet mit der tollen App da") == "<VERSENDET-MIT> da"


def test_capture_profile(one):
    text = "﻿Muster Finanzdienste Musterbank GmbH Hallo Am 1. schrieb service@bank.example: x"
    cleaned = one(text, lambda c: P.clean_text(c, P.capture_steps()))
    assert cleaned == "<ORGN><Anrede> Am 1. schrieb service@bank.example: x"


_HOUSES = (
    R.HouseTerms(), R.HouseTerms(team="Hallo Haus", contact="Morgen Gut"),
    R.HouseTerms(team="MfGs", contact="rede> x"),
)


@pytest.mark.parametrize("house", _HOUSES)
def test_batches_equal_one_rule_after_the_other(spark, house):
    parts = [p.format(team=house.team, contact=house.contact) for p in R.SALUTATIONS]
    parts += [*R.CLOSINGS, *R.TITLES, "eehrte Damen und Herren", "fG", "Dr", "Am ", "von "]
    parts += ["-", "--", "_=#", "---", " ", "x", "\n", "\r", "\t", "\xa0", "€", "😀", "<", ">"]
    parts += [f" schrieb {house.mailbox}:", "iese Nachricht wurde ", "Gesendet mit ", " gesendet",
              "App", R.BYTE_ORDER_MARK, house.organisation + " "]
    parts += [p[:k] for p in parts for k in (1, 4)] + [p[-4:] for p in parts]
    draw = random.Random(7)
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in [None, "", *texts]], "v string")
    for steps in (P.mail_steps(house), P.capture_steps(house), P.mail_steps(house, compat=False)):
        rows = df.select(
            "v", P.clean_text(F.col("v"), steps).alias("cleaned"),
            rewrite(P.replace_controls(F.col("v")), steps).alias("expected"),
        ).collect()
        assert len(rows) == len(texts) + 2
        for row in rows:
            assert row.cleaned == row.expected, row.v


def test_mails_are_cleaned_without_passes_of_java_regexes(spark):
    df = spark.range(1).selectExpr("cast(id as string) as subject", "cast(id as string) as body")
    plan = P.clean_mail(df).select("body_clean")._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan
    assert "regexp_replace" not in plan and "RLIKE" not in plan


def test_malformed_text_is_cleaned(one):
    def cleaned(col):
        return P.clean_text(F.unhex(col).cast("string"), P.mail_steps())

    assert one("4DFF0AC3A4", cleaned) == "M\ufffd ä"
    assert one("4DFFC3A4", lambda c: F.hex(cleaned(c))) == "4DFFC3A4"


def test_truncate(one):
    assert one("äbc" * 5000, lambda c: P.truncate(c, 10_000)) == ("äbc" * 5000)[:10000]
    assert one("äbc" * 5000, P.truncate) == "äbc" * 5000
