"""Phrase rules for mail bodies and scanned documents."""

from __future__ import annotations

from typing import NamedTuple


class HouseTerms(NamedTuple):
    """Terms of the organisation whose mail is cleaned; all are parameters."""

    team: str = "Team Musterbank"
    contact: str = "Herr Muster"
    mailbox: str = "service@bank.example"
    organisation: str = "Muster Finanzdienste Musterbank GmbH"
    organisation_tag: str = "<ORGN>"


# Phrases, tags and their order decide the result.
SALUTATION_TAG = "<Anrede>"
CLOSING_TAG = "<MFG>"
TRIM_TAG = "<TRIM EOFT>"
FOOTER_TAG = "<VERSENDET-MIT>"

BYTE_ORDER_MARK = "\ufeff"
CONTROL_CHARACTERS = "\r\t\n\u00a0"
RULER_PATTERN = r"[-_=#]{3,}"

TITLES = (
    " Dr. ",
    " Prof. ",
    " Mag. ",
    " Dipl.-Ing. ",
    " Dipl.-Ing. (FH) ",
    " Dipl.-Kfm. ",
    " Dipl.-Kfm. (FH) ",
    " Dipl.-Psychologin ",
    " Ph.D. ",
)

#: ``{team}`` and ``{contact}`` come from :class:`HouseTerms`
SALUTATIONS = (
    "Sehr geehrte Damen und Herren",
    "Geehrte Damen und Herren",
    "Sehr geehrtes {team}",
    "Werte Damen und Herren",
    "Sehr geehrte {contact}",
    "{contact}",
    "Sehr geehrte Frau",
    "Sehr geehrte",
    "Sehr geehrter",
    "Guten Tag",
    "Guten Tag zusammen",
    "Guten Morgen",
    "Guten Abend",
    "Hallo zusammen",
    "Hallo {team}",
    "Hallo Kundenbetreuung",
    "Hallo!",
    "Hallo",
    "Dear Sir/Madam",
)

CLOSINGS = (
    "Herzliche Grüße",
    "Mit freundlichen Grüßen",
    "Mit besten Grüßen",
    "Beste Grüße",
    "Mit freundlichem Gruß",
    "Viele Grüße",
    "Best regards",
    "Regards",
    "MfG",
    "MFG",
)

FOOTER_PATTERNS = (
    r"[dD]iese Nachricht wurde .* gesendet",
    r"[gG]esendet mit .* [aA]pp",
    r"[vV]on .* gesendet",
)

REPLY_PATTERN = r"Am .* schrieb {mailbox}:.*"

#: longest text kept, in characters
MAX_CHARS = 10_000
