"""Phrase cleaning of mail bodies, subjects and scanned documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.functions.batches import rewrite_batches
from postsieve.functions.rewrite import Group, Step, order_matters
from postsieve.rules import phrase_rules as P


def replace_controls(col: Column) -> Column:
    """Carriage return, tab, line feed and no-break space become a space."""
    return F.regexp_replace(col, F.lit(f"[{P.CONTROL_CHARACTERS}]"), F.lit(" "))


def replace_rulers(col: Column) -> Column:
    """Runs of three or more of ``- _ = #`` become a space."""
    return F.regexp_replace(col, F.lit(P.RULER_PATTERN), F.lit(" "))


def clean_subject(col: Column) -> Column:
    """The two rules subjects get."""
    return replace_rulers(replace_controls(col))


def truncate(col: Column, max_chars: int | None = None) -> Column:
    """Keep the first ``max_chars`` characters; ``None`` keeps all."""
    return col if max_chars is None else F.substring(col, 1, max_chars)


def ruler_steps() -> list[Step | Group]:
    """Runs of ruler characters, see :func:`replace_rulers`."""
    # spelled with a first character that Python's regexes look for
    one = P.RULER_PATTERN.removesuffix("{3,}")
    return [Step(f"{one}{one}{one}+", " ")]


def _rare_rulers() -> list[Step | Group]:
    """The same for texts that mostly have none."""
    return [Group("[-_=#]{3}", tuple(ruler_steps()), starts="-_=#")]


def title_steps(compat: bool = True) -> list[Step | Group]:
    """Academic titles.

    ``compat`` treats the titles as regexes, so a dot stands for any character
    and brackets group, and joins the neighbouring words.  Otherwise titles
    are literal, longest first, and leave one space.
    """
    if compat:
        steps = tuple(
            Step("(?d)" + title, "", needs=(title.split(".")[0],)) for title in P.TITLES
        )
        return [Group("Dr|Prof|Mag|Dipl|Ph", steps, starts="DMP")]
    return [Step(t, " ", literal=True) for t in sorted(P.TITLES, key=len, reverse=True)]


def reply_steps(house: P.HouseTerms = P.HouseTerms()) -> list[Step | Group]:
    """Cut a quoted reply that follows the own mailbox's reply header."""
    pattern = P.REPLY_PATTERN.format(mailbox=re.escape(house.mailbox))
    return [Step("(?d)" + pattern, P.TRIM_TAG, needs=(f" schrieb {house.mailbox}:",))]


def _one_pass(phrases: tuple[str, ...], tag: str) -> Step:
    first = "".join(dict.fromkeys(p[0] for p in phrases))
    return Step("|".join(map(re.escape, phrases)), tag, starts=first, phrases=phrases)


def _phrase_steps(phrases: tuple[str, ...], tag: str, compat: bool) -> list[Step | Group]:
    if not compat:
        # longest first: no phrase is cut short by another one, and no tag
        # just written is matched again
        return [_one_pass(tuple(sorted(set(phrases), key=lambda p: (-len(p), p))), tag)]
    retagged = tuple(p for p in phrases if p in tag)
    others = tuple(p for p in phrases if p not in tag)
    pairs = [(a, b) for i, a in enumerate(phrases) for b in phrases[i + 1:]]
    if any(order_matters(a, b) for a, b in pairs) or len(retagged) > 1 or (
        retagged and (phrases[-1] != retagged[0] or any(retagged[0] in p for p in others))
    ):
        return [Step(phrase, tag, literal=True) for phrase in phrases]
    # same result as phrase after phrase, in one pass over the text; a phrase
    # that is part of the tag comes last in the list, so it tags the tags of
    # all others a second time
    steps = [Step(retagged[0], tag, literal=True, phrases=retagged)] if retagged else []
    twice = tag.replace(retagged[0], tag) if retagged else tag
    return [*steps, _one_pass(others, twice)]


def salutation_steps(
    house: P.HouseTerms = P.HouseTerms(), compat: bool = True
) -> list[Step | Group]:
    """Salutations become one tag."""
    phrases = tuple(
        p.format(team=house.team, contact=house.contact) for p in P.SALUTATIONS
    )
    return _phrase_steps(phrases, P.SALUTATION_TAG, compat)


def closing_steps(compat: bool = True) -> list[Step | Group]:
    """Closing formulas become one tag.

    With ``compat`` the last phrase also hits the tags just written, so that
    earlier closings end up in double brackets.
    """
    return _phrase_steps(P.CLOSINGS, P.CLOSING_TAG, compat)


def footer_steps() -> list[Step | Group]:
    """Device and app footers, from their first to their last word."""
    needs = (("iese Nachricht wurde ",), ("esendet mit ",), (" gesendet",))
    steps = tuple(
        Step("(?d)" + pattern, P.FOOTER_TAG, needs=n)
        for pattern, n in zip(P.FOOTER_PATTERNS, needs)
    )
    return [Group("esendet", steps)]


def organisation_steps(house: P.HouseTerms = P.HouseTerms()) -> list[Step | Group]:
    """Byte-order marks vanish, the own full name becomes a tag."""
    return [
        Step(P.BYTE_ORDER_MARK, "", literal=True),
        Step(house.organisation + " ", house.organisation_tag, literal=True),
    ]


def mail_steps(house: P.HouseTerms = P.HouseTerms(), compat: bool = True) -> list[Step | Group]:
    """All steps for mail bodies, after control characters are translated."""
    return (
        _rare_rulers() + title_steps(compat) + reply_steps(house)
        + salutation_steps(house, compat) + closing_steps(compat) + footer_steps()
    )


def capture_steps(house: P.HouseTerms = P.HouseTerms(), compat: bool = True) -> list[Step | Group]:
    """All steps for scanned documents: no reply cut, own name tagged."""
    return (
        _rare_rulers() + organisation_steps(house) + title_steps(compat)
        + salutation_steps(house, compat) + closing_steps(compat) + footer_steps()
    )


def clean_text(col: Column, steps: list[Step | Group]) -> Column:
    """Translate control characters, then apply ``steps``."""
    controls = [Step(c, " ", literal=True) for c in P.CONTROL_CHARACTERS]
    return rewrite_batches(col, [*controls, *steps])


def clean_mail(
    df: DataFrame, house: P.HouseTerms = P.HouseTerms(), compat: bool = True,
    subject: str = "subject", body: str = "body", out: str = "body_clean",
) -> DataFrame:
    """Clean subject and body of mails; the body goes to ``out``."""
    df = df.withColumn(subject, clean_subject(F.col(subject)))
    return df.withColumn(out, clean_text(F.col(body), mail_steps(house, compat)))


def clean_capture(
    df: DataFrame, house: P.HouseTerms = P.HouseTerms(), compat: bool = True,
    body: str = "rawbody", out: str = "body_clean",
) -> DataFrame:
    """Clean the text of scanned documents."""
    return df.withColumn(out, clean_text(F.col(body), capture_steps(house, compat)))
