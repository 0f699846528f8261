"""DuckDB expressions of the text rules."""

from __future__ import annotations

import re
from functools import reduce

from postsieve.rules import phrase_rules as P
from postsieve.rules.mask_rules import FAILED_TEXT, MASK_SEQUENCE, WHITESPACE, MaskRule

HOUSE = P.HouseTerms()


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def regex(col: str, pattern: str, replacement: str, options: str = "g") -> str:
    return f"regexp_replace({col}, {quote(pattern)}, {quote(replacement)}, '{options}')"


def literal(col: str, text: str, replacement: str) -> str:
    return f"replace({col}, {quote(text)}, {quote(replacement)})"


def mask_one(col: str, rule: MaskRule) -> str:
    return regex(col, rule.pattern, rule.tag, "gs" if rule.dotall else "g")


def mask_chain(col: str) -> str:
    masked = reduce(mask_one, MASK_SEQUENCE, col)
    return f"coalesce(trim({masked}, {quote(WHITESPACE)}), '{FAILED_TEXT}')"


def controls(col: str) -> str:
    return f"translate({col}, {quote(P.CONTROL_CHARACTERS)}, '    ')"


def rulers(col: str) -> str:
    return regex(col, P.RULER_PATTERN, " ")


def titles(col: str) -> str:
    return reduce(lambda c, t: regex(c, t, ""), P.TITLES, col)


def reply(col: str) -> str:
    pattern = P.REPLY_PATTERN.replace("{mailbox}", re.escape(HOUSE.mailbox))
    return regex(col, pattern, P.TRIM_TAG)


def salutations(col: str) -> str:
    phrases = [p.replace("{team}", HOUSE.team).replace("{contact}", HOUSE.contact)
               for p in P.SALUTATIONS]
    return reduce(lambda c, p: literal(c, p, P.SALUTATION_TAG), phrases, col)


def closings(col: str) -> str:
    return reduce(lambda c, p: literal(c, p, P.CLOSING_TAG), P.CLOSINGS, col)


def footers(col: str) -> str:
    return reduce(lambda c, p: regex(c, p, P.FOOTER_TAG), P.FOOTER_PATTERNS, col)


def organisation(col: str) -> str:
    col = literal(col, P.BYTE_ORDER_MARK, "")
    return literal(col, HOUSE.organisation + " ", HOUSE.organisation_tag)


def subject(col: str) -> str:
    return rulers(controls(col))


def mail_body(col: str) -> str:
    return footers(closings(salutations(reply(titles(rulers(controls(col)))))))


def capture_body(col: str) -> str:
    return footers(closings(salutations(titles(organisation(rulers(controls(col)))))))


# tokens: see postsieve.functions.tokens
_MARKS = r"""!-/:-@\[-`{-~„“”‚‘’«»…–—"""
TOKEN = rf"[^\s{_MARKS}](?:\S*[^\s{_MARKS}])?|[{_MARKS}]"
WORD = rf"[^\s{_MARKS}](?:\S*[^\s{_MARKS}])?"


def tokens(col: str) -> str:
    return f"regexp_extract_all({col}, {quote(TOKEN)})"


def words(col: str) -> str:
    return f"regexp_extract_all({col}, {quote(WORD)})"


def word_count(col: str) -> str:
    return f"len(list_filter(regexp_split_to_array({col}, '\\s+'), lambda w: w <> ''))"
