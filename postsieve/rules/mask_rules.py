"""Mask rules for personal data, in the order in which they are applied.

Every pattern is written in the common subset of Java, Python and RE2 syntax.
The functions module adds the dialect flags.
"""

from __future__ import annotations

from typing import NamedTuple


class MaskRule(NamedTuple):
    """One substitution: ``pattern`` is replaced by ``tag``.

    The other fields only let a text skip a regex that cannot match it.
    ``needs`` lists plain substrings of which at least one occurs in every
    match, ``hint`` is a cheaper regex found in every match, ``near_digits``
    one of a few characters around digits, ``starts`` is the character class
    of the first matched character.  ``dotall`` lets ``.`` match line breaks.
    """

    key: str
    pattern: str
    tag: str
    needs: tuple[str, ...] = ()
    hint: str = ""
    starts: str = ""
    dotall: bool = False
    near_digits: str = ""


#: a text without a run of capitals and digits skips card and vehicle ids
CAPITAL_RUN = r"[A-Z][A-Z\d]{6}"

# Patterns, tags and their order decide the result.
INTRO = MaskRule("intro", r"Page 1.*Betreff:", "<INTRO> ", ("Betreff:",), dotall=True)
IBAN = MaskRule("iban", r"\bDE(?:\d{2}(?: \d{4}){4} \d{2}|\d{20})\b", " <IBAN> ", ("DE",), near_digits=r"DE\d{2}", starts="D")
LEASING_MANDATE = MaskRule("leasing_mandate", r"\bLC\d{4}X\d{8}\b", " <MREFLS> ", ("LC",), near_digits=r"LC\d{4}X\d", starts="L")
CREDIT_MANDATE = MaskRule("credit_mandate", r"\bCF\d{12}\b", " <MREFCR> ", ("CF",), near_digits=r"CF\d{12}", starts="C")
DATE = MaskRule(
    "date",
    r"\b(?:3[01]|[0-2]?\d)\.(?:0\d|1[0-2]|\d)\.(?:[12]\d{1,3}|[1-9]\d)\b",
    " <DATUM> ",
    near_digits=r"\d\.\d{1,2}\.[1-9]\d",
    starts=r"\d",
)
IDENTITY_CARD = MaskRule(
    "identity_card", r"\b[CFGHJ-NPRTV-Z][CFGHJ-NPRTV-Z\d]{8}\b", " <PASSPORT> ", hint=CAPITAL_RUN, starts="[C-Z]"
)
TAX_NUMBER = MaskRule("tax_number", r"\w{2}/\d{3}/\d{4,5}\b", " <TAXNBR> ", ("/",), near_digits=r"/\d{3}/\d{4}")
TAX_ID = MaskRule(
    "tax_id", r"\b[1-9][0-9](?:\s\d{3}){3}\b|\b[1-9]\d{10}\b", " <TAXNBR> ",
    near_digits=r"[1-9][0-9]\s\d{3}\s\d{3}|[1-9]\d{10}", starts="[1-9]"
)
PHONE = MaskRule(
    "phone",
    r"(?:(?:(?:00|\+)49[ /-]?|0)[1-9][0-9]{1,4}[ /-]?"
    r"|(?:(?:00|\+)49\(|\(0)[1-9][0-9]{1,4}\)[ /-]?)"
    r"[0-9]{1,7}(?:[ /-]?[0-9]{1,5})?\b",
    " <TELFAX> ",
    ("0", "+49"),
    near_digits=r"(?:0|49[ /(-]?)[1-9][0-9]{1,4}\)?[ /-]?[0-9]",
    starts="[0+(]",
)
EMAIL = MaskRule("email", r"\b[\w.+-]+@[\w-]+\.[a-zA-Z0-9.-]+\b", " <EMAIL> ", ("@",))
VIN_LONG = MaskRule("vin_long", r"\b[A-Z][A-Z\d]{16}\b", " <VIN> ", hint=CAPITAL_RUN, starts="[A-Z]")
VIN_SHORT = MaskRule("vin_short", r"\b[A-Z][A-Z\d]{6}\b", " <VIN> ", hint=CAPITAL_RUN, starts="[A-Z]")
NUMBER_PLATE = MaskRule(
    "number_plate",
    r"\b[a-zA-ZöüäÖÜ]{1,3}[ -][a-zA-ZöüäÖÜ]{1,2} ?[1-9][0-9]{1,3}[^.]\b",
    " <KFZKZ> ",
    near_digits=r"[a-zA-ZöüäÖÜ][ -][a-zA-ZöüäÖÜ]{1,2} ?[1-9][0-9]",
)
STAFF_NUMBER = MaskRule("staff_number", r"\b[qQ][-\s]?\d{5,6}\b", " <QNBR> ", near_digits=r"[qQ][-\s]?\d{5}", starts="[qQ]")
POSTCODE = MaskRule("postcode", r"\b(?:0[1-9]|[1-9][0-9])[0-9]{3}\b", " <PLZ> ", near_digits="[0-9]{5}", starts="[0-9]")
DIGITS_6 = MaskRule("digits_6", r"\b\d{6}\b", " <666666> ", near_digits=r"\d{6}", starts=r"\d")
DIGITS_7 = MaskRule("digits_7", r"\b\d{7}\b", " <7777777> ", near_digits=r"\d{7}", starts=r"\d")
DIGITS_8 = MaskRule("digits_8", r"\b\d{8}\b", " <88888888> ", near_digits=r"\d{8}", starts=r"\d")
DIGITS_9 = MaskRule("digits_9", r"\b\d{9}\b", " <999999999> ", near_digits=r"\d{9}", starts=r"\d")
DIGITS_10 = MaskRule("digits_10", r"\b\d{10}\b", " <1010101010> ", near_digits=r"\d{10}", starts=r"\d")
URL = MaskRule(
    "url",
    r"\b<*(?:https?|ftp)://[\w-]+\.[\w-]+"
    r"(?:[\w.,@?^=%&:/~+#-]*[\w@?^=%&/~+#-])?>*\b",
    " <URL> ",
    ("://",),
)
BARE_URL = MaskRule(
    "bare_url",
    r"\b(?:(?:https?|ftp|smtp)://)?(?:www.)?[\w-]+\.[a-z]+(?:/[a-zA-Z0-9#]+/?)*\b",
    " <URL> ",
    hint=r"\.[a-z]",
)

MASK_SEQUENCE: tuple[MaskRule, ...] = (
    INTRO, IBAN, LEASING_MANDATE, CREDIT_MANDATE, DATE, IDENTITY_CARD, TAX_NUMBER,
    TAX_ID, PHONE, EMAIL, LEASING_MANDATE, CREDIT_MANDATE, VIN_LONG, VIN_SHORT,
    NUMBER_PLATE, STAFF_NUMBER, POSTCODE, DIGITS_6, DIGITS_7, DIGITS_8, DIGITS_9,
    DIGITS_10, URL, BARE_URL,
)

#: text stored for a value that could not be masked
FAILED_TEXT = "ANONYMIZATION FAILED"

#: characters removed from both ends of a masked text
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
