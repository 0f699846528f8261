"""Charset proposal and decoding of undecoded bodies."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names under which a charset may be declared, lower case.
_UTF8 = ("utf-8", "utf8", "utf-8-sig", "u8")
_ASCII = ("us-ascii", "ascii", "646")
_LATIN1 = ("iso-8859-1", "iso8859-1", "latin-1", "latin1", "l1", "8859")
_LATIN9 = ("iso-8859-15", "iso8859-15", "latin-9", "l9")
_CP1252 = ("windows-1252", "cp1252", "1252")

# Where the two charsets differ from ISO-8859-1.  The five bytes
# without a character come last, so that translate drops them.
_CP1252_BYTES = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96"
    "\x97\x98\x99\x9a\x9b\x9c\x9e\x9f" "\x81\x8d\x8f\x90\x9d"
)
_CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_LATIN9_BYTES = "\xa4\xa6\xa8\xb4\xb8\xbc\xbd\xbe"
_LATIN9_CHARS = "€ŠšŽžŒœŸ"

#: (encoding, confidence, language) of a proposal
PROPOSAL = "struct<encoding:string,confidence:double,language:string>"


def propose_charset(body: Column) -> Column:
    """Rule-based proposal as a struct of encoding, confidence and language.

    In this order: empty body → none; byte-order mark → that Unicode charset;
    bytes below 128 only → ascii; valid UTF-8 → utf-8; bytes 80–9F in use →
    windows-1252; anything else → iso-8859-1.
    """
    text = body.cast("string")
    head = F.hex(F.substring(body, 1, 4))

    def proposal(encoding: str | None, confidence: float) -> Column:
        return F.struct(
            F.lit(encoding).cast("string").alias("encoding"),
            F.lit(confidence).alias("confidence"),
            F.lit("").alias("language"),
        )

    latin = F.decode(body, "iso-8859-1")
    return (
        F.when(body.isNull() | (F.octet_length(body) == 0), proposal(None, 0.0))
        .when(F.startswith(head, F.lit("EFBBBF")), proposal("utf-8-sig", 1.0))
        .when(head.isin("FFFE0000", "0000FEFF"), proposal("utf-32", 1.0))
        .when(F.substring(head, 1, 4).isin("FFFE", "FEFF"), proposal("utf-16", 1.0))
        .when(
            F.is_valid_utf8(text) & (F.length(text) == F.octet_length(body)),
            proposal("ascii", 1.0),
        )
        .when(F.is_valid_utf8(text), proposal("utf-8", 0.99))
        .when(latin.rlike("[\\x80-\\x9f]"), proposal("windows-1252", 0.73))
        .otherwise(proposal("iso-8859-1", 0.73))
    )


def decode_utf8(body: Column) -> Column:
    """UTF-8 text without its malformed bytes."""
    text = body.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))
    )


def _decode_other(errors: str):
    """Arrow function for charsets without a built-in decoder."""

    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for bodies, encodings in batches:
            out = pd.Series([None] * len(bodies), index=bodies.index, dtype=object)
            for encoding, group in bodies.groupby(encodings):
                try:
                    out[group.index] = [
                        bytes(b).decode(encoding, errors) if b is not None else None
                        for b in group
                    ]
                except (LookupError, UnicodeError):
                    pass
            yield out

    return decode


def decode_body(body: Column, encoding: Column, other_charsets: bool = True) -> Column:
    """Decode ``body`` by the charset named in ``encoding``, dropping bad bytes.

    The charsets of nearly all western mail are decoded by built-in functions.
    ``other_charsets`` sends the remaining bodies, and only those, to Python;
    without it, or for an unknown name, the result is null.
    """
    name = F.lower(F.trim(encoding))
    latin = F.decode(body, "iso-8859-1")
    text = (
        F.when(name.isin("utf-8-sig"), F.regexp_replace(decode_utf8(body), "^\ufeff", ""))
        .when(name.isin(*_UTF8), decode_utf8(body))
        .when(name.isin(*_ASCII), F.regexp_replace(latin, "[^\\x00-\\x7f]+", ""))
        .when(name.isin(*_LATIN1), latin)
        .when(name.isin(*_CP1252), F.translate(latin, _CP1252_BYTES, _CP1252_CHARS))
        .when(name.isin(*_LATIN9), F.translate(latin, _LATIN9_BYTES, _LATIN9_CHARS))
    )
    if not other_charsets:
        return text
    builtin = name.isin(*_UTF8, *_ASCII, *_LATIN1, *_CP1252, *_LATIN9)
    return F.coalesce(text, _decode_other("ignore")(F.when(~builtin, body), name))


def loses_bytes(body: Column, encoding: Column, text: Column) -> Column:
    """Whether ``text``, decoded from ``body``, lacks bytes that the charset has no character for.

    Told by validity for UTF-8 and by length for the charsets of one byte a
    character; false for others.
    """
    name = F.lower(F.trim(encoding))
    single = name.isin(*_ASCII, *_LATIN1, *_LATIN9, *_CP1252) | name.rlike("^(iso-?8859-\\d+|windows-125\\d|cp125\\d)$")
    return (
        F.when(name.isin(*_UTF8), ~F.is_valid_utf8(body.cast("string")))
        .when(single, F.length(text) < F.octet_length(body))
        .otherwise(F.lit(False))
    )
