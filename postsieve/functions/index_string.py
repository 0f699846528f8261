"""Parsing of index strings: positional items, keyed items, confidences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.functions.rewrite import java_pattern
from postsieve.rules.index_rules import AUTOCLASS_KEY, KEYED_PATTERNS, POSITIONS
from postsieve.rules.phrase_rules import BYTE_ORDER_MARK

#: columns that keep inner quotes and lose only those at the ends
_END_QUOTES_ONLY = ("pagecount", "doccount")


def drop_byte_order_mark(col: Column) -> Column:
    """Remove every U+FEFF."""
    return F.replace(col, F.lit(BYTE_ORDER_MARK), F.lit(""))


def strip_quotes(col: Column) -> Column:
    """Remove double quotes at both ends."""
    return F.btrim(col, F.lit('"'))


def has_autoclass(col: Column) -> Column:
    """Whether the index string carries the automatic-class key."""
    return F.contains(col, F.lit(AUTOCLASS_KEY))


def index_items(col: Column) -> dict[str, Column]:
    """The text of every positional item; null beyond the end."""
    items = F.split(col, F.lit(","))
    out = {}
    for name, position in POSITIONS.items():
        item = F.get(items, F.lit(position))
        out[name] = (
            strip_quotes(item) if name in _END_QUOTES_ONLY
            else F.replace(item, F.lit('"'), F.lit(""))
        )
    return out


def to_whole_number(col: Column) -> Column:
    """Text to long by way of double, null where that fails."""
    return col.try_cast("double").try_cast("bigint")


def split_confidence(col: Column) -> Column:
    """The confidence list."""
    return F.split(col, F.lit("\\|"))


def count_doctypes(col: Column, mode: str = "items") -> Column:
    """Number of list items, or with ``mode="chars"`` the length of the text."""
    return F.length(col) if mode == "chars" else F.size(split_confidence(col))


def unpack_confidence(col: Column) -> Column:
    """``type;score;code|...`` as an array of (score, doc_type, code)."""

    def unpack(item: Column) -> Column:
        parts = F.split(item, F.lit(";"))
        return F.struct(
            F.get(parts, F.lit(1)).try_cast("double").alias("score"),
            F.get(parts, F.lit(0)).alias("doc_type"),
            F.get(parts, F.lit(2)).alias("code"),
        )

    return F.transform(split_confidence(col), unpack)


def parse_positions(
    df: DataFrame, column: str = "indexstring", strict: bool = True,
    nbr_doctypes: str = "items",
) -> DataFrame:
    """Add the positional columns to ``df``.

    The split array is computed once per row; ids are cast strictly, so a
    malformed one ends the job, or to null with ``strict=False``.  Page and
    document counts and the class flag become numbers, null where unparsable.
    """
    items = index_items(F.col(column))
    to_id = (lambda c: c.cast("bigint")) if strict else (lambda c: c.try_cast("bigint"))
    flag = items["autoclass"]
    columns = {
        **items,
        "batchid": to_id(items["batchid"]),
        "docid": to_id(items["docid"]),
        "pagecount": to_whole_number(items["pagecount"]),
        "doccount": to_whole_number(items["doccount"]),
        "autoclass": (flag.cast("double") if strict else flag.try_cast("double")) != 0,
        "confidence": split_confidence(items["confidence"]),
        "nbr_doctypes": count_doctypes(items["confidence"], nbr_doctypes),
    }
    return df.withColumns(columns)


def parse_keys(df: DataFrame, column: str = "indexstring") -> DataFrame:
    """Add the eight keyed columns and ``error``, true if one is missing or empty."""
    text = F.col(column)
    found = {
        name: F.nullif(F.regexp_extract(text, java_pattern(pattern), 1), F.lit(""))
        for name, pattern in KEYED_PATTERNS.items()
    }
    for name in ("batchid", "docid", "pagecount", "doccount"):
        found[name] = found[name].try_cast("bigint")
    df = df.withColumns(found)
    missing = [F.col(name).isNull() for name in KEYED_PATTERNS]
    error = missing[0]
    for flag in missing[1:]:
        error = error | flag
    return df.withColumn("error", error)


def fill_with_median(df: DataFrame, *columns: str, among: DataFrame | None = None) -> DataFrame:
    """Replace nulls by the truncated median of each column's other values.

    The medians are one scalar row, computed with a map-side partial count
    per distinct value, so no task sees all values of a long column.  They are
    taken over ``among``, or over ``df`` itself, which then runs twice.
    """
    medians = (df if among is None else among).agg(
        F.struct(*[F.median(c).try_cast("bigint").alias(c) for c in columns]).alias("m")
    ).scalar()
    return df.withColumns({
        c: F.coalesce(F.col(c), medians.getField(c)) for c in columns
    })
