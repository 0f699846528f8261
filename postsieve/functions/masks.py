"""Masking of personal data by ordered regex rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.functions.rewrite import Step, java_pattern, rewrite
from postsieve.rules.mask_rules import FAILED_TEXT, MASK_SEQUENCE, WHITESPACE, MaskRule


def mask_step(rule: MaskRule) -> Step:
    """The rewriting step of one rule."""
    pattern = f"(?={rule.starts})(?:{rule.pattern})" if rule.starts else rule.pattern
    return Step(
        java_pattern(pattern, rule.dotall),
        rule.tag,
        needs=rule.needs,
        hint=java_pattern(rule.hint) if rule.hint else "",
        near_digits=java_pattern(rule.near_digits) if rule.near_digits else "",
    )


def mask_one(col: Column, rule: MaskRule) -> Column:
    """Replace every match of a single rule by its tag."""
    return rewrite(col, [mask_step(rule)])


def strip(col: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def finish(col: Column) -> Column:
    """Strip a masked text; a missing one becomes the failure text."""
    return F.coalesce(strip(col), F.lit(FAILED_TEXT))


def mask_text(col: Column, rules: Sequence[MaskRule] = MASK_SEQUENCE) -> Column:
    """All rules in order.

    The hints are tested on the unmasked text.  That is safe for
    ``MASK_SEQUENCE``: tags are set off by spaces and hold no seven-capital
    word, and masking only shortens runs, so a match after masking always
    leaves its hint in the original text.  Hints have no word borders, as
    masking makes new ones, and no character of a tag can be part of what they
    find.
    """
    return finish(rewrite(col, map(mask_step, rules)))


def with_masked_text(
    df: DataFrame, column: str, out: str | None = None,
    rules: Sequence[MaskRule] = MASK_SEQUENCE,
) -> DataFrame:
    """Mask one column of a table."""
    return df.withColumn(out or column, mask_text(F.col(column), rules))


def count_tag(col: Column, tag: str) -> Column:
    """Number of times a tag occurs in a text."""
    cut = F.length(F.replace(col, F.lit(tag), F.lit("")))
    return ((F.length(col) - cut) / len(tag)).cast("bigint")
