"""Tokens of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsieve.functions.rewrite import bind

#: ASCII punctuation and the usual typographic marks
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~„“”‚‘’«»…–—"


def chunks(text: Column) -> Column:
    """White-space separated pieces; an empty one stands at a blank end."""
    return F.split(text, F.lit(r"(?U)\s+"))


def _core(chunk: Column) -> Column:
    return F.btrim(chunk, F.lit(PUNCTUATION))


def _peel(chunk: Column) -> Column:
    """Marks in front, core and marks behind as separate tokens."""

    def split_at(core: Column) -> Column:
        begin = F.instr(chunk, core)
        marks_behind = F.substring(chunk, begin + F.length(core), F.length(chunk))
        return (
            F.when(core == chunk, F.array(chunk))
            .when(core == "", F.split(chunk, F.lit("")))
            .otherwise(F.concat(
                F.split(F.substring(chunk, F.lit(1), begin - 1), F.lit("")),
                F.array(core),
                F.split(marks_behind, F.lit("")),
            ))
        )

    return bind(_core(chunk), split_at)


def tokens(text: Column) -> Column:
    """Split on white space and peel punctuation off both ends of each chunk.

    Peeled marks are tokens of their own; marks inside a chunk stay, so that an
    address or URL is one token.
    """
    return F.filter(F.flatten(F.transform(chunks(text), _peel)), lambda t: t != "")


def words(text: Column) -> Column:
    """Tokens without punctuation marks."""
    return F.filter(F.transform(chunks(text), _core), lambda t: t != "")


def word_count(text: Column) -> Column:
    """Number of white-space separated words."""
    return F.size(F.filter(chunks(text), lambda w: w != ""))
