"""Token lookups: blocklist, postcode and gazetteer masks, lexicon build.

A lookup of checked size goes out as one broadcast variable; the distinct
tokens of each Arrow batch are looked up in it, without any shuffle.  Of a
larger one only the part that the texts use goes out, if that is small: a join
of the distinct tokens finds it.  Beyond that the tokens are joined under
narrow row ids, and the hits go back to their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.rewrite import evaluated_once
from postsieve.functions.tokens import tokens, words
from postsieve.operators.lookup import MAX_BROADCAST_ROWS, collect_if_small, with_row_ids

# Tag and rank of each gazetteer, first match wins.
GAZETTEERS = {
    "postcode": ("<PLZ>", 1),
    "vin_short": ("<VIN>", 2),
    "vin_long": ("<VIN>", 3),
    "first_name": ("<VORNAME>", 4),
    "surname": ("<NACHNAME>", 5),
    "city": ("<STADT>", 6),
    "street": ("<STRASSE>", 7),
}

# Token lengths for which a gazetteer is asked, both inclusive.
TOKEN_LENGTHS = {"postcode": (0, 9), "vin_short": (0, 7), "vin_long": (8, 1 << 30)}

#: shortest name, city or street kept, in characters
MIN_NAME_LENGTH = 4


# --- lexicon build ----------------------------------------------------------

def _entries(df: DataFrame, column: str, named: bool, right_trim: bool) -> DataFrame:
    value = F.rtrim(F.col(column)) if right_trim else F.col(column)
    out = df.select(value.alias("token")).filter(F.col("token").isNotNull())
    if named:
        out = out.filter(F.length("token") >= MIN_NAME_LENGTH)
    return out.select(F.upper("token").alias("token"))


def build_lexicon(
    gazetteers: dict[str, DataFrame], stop_words: Sequence[DataFrame] = (),
    column: str = "token",
) -> DataFrame:
    """``lexicon(token, source, tag, priority, min_len, max_len)``.

    ``gazetteers`` maps the keys of ``GAZETTEERS`` to one-column tables.  The
    overlaps go in a fixed order: surnames lose the stop words; first names
    lose surnames, cities and stop words; cities lose surnames, the remaining
    first names and stop words; postcodes lose the remaining cities.  An
    overlap concerns one token only, so one aggregate by token settles all.
    """
    named = ("first_name", "surname", "city", "street")
    parts = [
        _entries(df, column, key in named, key == "city").withColumn("source", F.lit(key))
        for key, df in gazetteers.items()
    ] + [
        _entries(df, column, named=False, right_trim=False).withColumn("source", F.lit("stop"))
        for df in stop_words
    ]
    if not gazetteers:
        raise ValueError("no gazetteer given")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    sets = (*gazetteers, "stop")
    found = every.groupBy("token").agg(*[F.bool_or(F.col("source") == key).alias(key) for key in sets])
    kept = {key: F.col(key) for key in sets}

    def without(key: str, *others: str) -> None:
        if key in kept:
            for other in others:
                if other in kept:
                    kept[key] = kept[key] & ~kept[other]

    without("surname", "stop")
    without("first_name", "surname", "city", "stop")
    without("city", "surname", "first_name", "stop")
    without("postcode", "city")
    entries = []
    for key in gazetteers:
        tag, priority = GAZETTEERS[key]
        low, high = TOKEN_LENGTHS.get(key, (0, 1 << 30))
        entries.append(F.when(kept[key], F.struct(
            F.lit(key).alias("source"), F.lit(tag).alias("tag"), F.lit(priority).alias("priority"),
            F.lit(low).alias("min_len"), F.lit(high).alias("max_len"),
        )))
    return found.select("token", F.inline(F.array_compact(F.array(*entries))))


def lexicon_sizes(lexicon: DataFrame) -> DataFrame:
    """Number of entries per gazetteer."""
    return lexicon.groupBy("source").agg(F.count("*").alias("entries"))


# --- token tagging ----------------------------------------------------------

def _one_tag_per_token(lexicon: DataFrame) -> DataFrame:
    """Best tag of each token among the gazetteers that take its length."""
    length = F.length("token")
    return (
        lexicon.filter(length.between(F.col("min_len"), F.col("max_len")))
        .groupBy("token")
        .agg(F.min_by("tag", "priority").alias("tag"))
    )


def _ship(df: DataFrame, table: pa.Table) -> Broadcast:
    """Token to tag as one broadcast variable; a worker process unpacks it once."""
    tokens_, tags = (table.column(name).to_pylist() for name in ("token", "tag"))
    return df.sparkSession.sparkContext.broadcast(dict(zip(tokens_, tags, strict=True)))


def _tags(lists: pa.Array, known: dict[str, str]) -> pa.Array:
    """The tag of every token of the lists; each distinct token is looked up once."""
    coded = lists.flatten().dictionary_encode()
    tags = pa.array([known.get(token) for token in coded.dictionary.to_pylist()], pa.string())
    return tags.take(coded.indices)


def _found(lists: pa.Array, shipped: Broadcast) -> pa.Array:
    """The tag of every token of the lists, by a broadcast lookup."""
    return _tags(lists, shipped.value)


def _as_lists(lists: pa.Array, values: pa.Array) -> pa.Array:
    """One value for each element, in lists as long as the given ones."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0)
    offsets = pa.concat_arrays([
        pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())
    ])
    return pa.ListArray.from_arrays(offsets, values)


def _tag_batches(shipped: Broadcast):
    """Arrow function: each upper-cased token list to the list of its tags."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def tag(lists: pa.Array) -> pa.Array:
        return _as_lists(lists, _found(lists, shipped))

    return tag


@F.arrow_udf(T.ArrayType(T.StringType()))
def _tags_of_hits(lists: pa.Array, hits: pa.Array) -> pa.Array:
    """Each upper-cased token list to the list of its tags, by the joined tokens of its rows.

    A token has one tag in all rows, so the hits of a batch are one lookup.
    """
    tokens_, tags = (hits.flatten().field(name).to_pylist() for name in ("token", "tag"))
    return _as_lists(lists, _tags(lists, dict(zip(tokens_, tags, strict=True))))


#: narrow row id of rows that were written for a join, and their tokens
_ROW, _TOKENS = "__row", "__tokens"


def _small_part(
    df: DataFrame, token_list: Column, table: DataFrame, max_rows: int
) -> tuple[pa.Table | None, DataFrame]:
    """The lookup, or the part that the texts use, where that is small; and the rows with their tokens.

    Rows that are read more than once are written first, with tokens and row ids.
    """
    small = collect_if_small(table, max_rows)
    rows = df.withColumn(_TOKENS, token_list)
    if small is not None:
        return small, rows
    rows = with_row_ids(rows, _ROW)
    if max_rows <= 0:
        return None, rows
    used = rows.select(F.explode(F.transform(_TOKENS, F.upper)).alias("token")).distinct().join(table, "token")
    return collect_if_small(used, max_rows, max_bytes=None), rows


def _join_tags(token_list: Column, tag_list: Column) -> Column:
    merged = F.zip_with(token_list, tag_list, lambda token, tag: F.coalesce(tag, token))
    return F.array_join(merged, " ")


def tag_tokens(
    df: DataFrame, column: str, tag_table: DataFrame, key: str, out: str | None = None,
    punctuation: bool = True, max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Replace tokens found in ``tag_table(token, tag)`` by their tag.

    Tokens are joined by one space; ``punctuation=False`` drops marks; of
    several tags of a token the smallest counts.  If neither the table nor the
    part that the texts use has at most ``max_rows`` rows, it is joined, with
    the same result; ``key`` may be null or repeated.
    """
    out = out or column
    tag_table = tag_table.groupBy("token").agg(F.min("tag").alias("tag")).select("token", "tag")
    split = tokens if punctuation else words

    upper = F.transform(_TOKENS, F.upper)
    small, rows = _small_part(df, split(F.col(column)), tag_table, max_rows)
    if small is not None:
        tagged = rows.withColumn("__tags", _tag_batches(_ship(df, small))(upper))
    else:
        hits = (
            rows.select(_ROW, F.explode(F.array_distinct(upper)).alias("token"))
            .join(tag_table, "token")
            .groupBy(_ROW)
            .agg(F.collect_list(F.struct("token", "tag")).alias("__hits"))
        )
        tagged = rows.join(hits, _ROW, "left").withColumn("__tags", _tags_of_hits(upper, F.col("__hits")))
    masked = _join_tags(F.col(_TOKENS), F.col("__tags"))
    return tagged.withColumn(out, masked).drop(_TOKENS, "__tags", "__hits", _ROW)


def mask_postcodes(
    df: DataFrame, column: str, postcodes: DataFrame, key: str, out: str | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Tokens in ``postcodes(token)`` become ``<PLZ>``."""
    tag, _ = GAZETTEERS["postcode"]
    table = postcodes.select("token", F.lit(tag).alias("tag")).distinct()
    return tag_tokens(df, column, table, key, out, max_rows=max_rows)


def mask_gazetteers(
    df: DataFrame, column: str, lexicon: DataFrame, key: str, out: str | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Names, places, postcodes and vehicle ids become tags; marks vanish."""
    return tag_tokens(
        df, column, _one_tag_per_token(lexicon), key, out, punctuation=False,
        max_rows=max_rows,
    )


# --- blocklist --------------------------------------------------------------

def _any_batches(shipped: Broadcast):
    """Arrow function: whether a token list holds a listed token."""

    @F.arrow_udf(T.BooleanType())
    def any_listed(lists: pa.Array) -> pa.Array:
        rows = pc.list_parent_indices(lists)
        hit = np.zeros(len(lists), bool)
        hit[rows.filter(_found(lists, shipped).is_valid()).to_numpy()] = True
        return pa.array(hit)

    return any_listed


def flag_listed(
    df: DataFrame, column: str, blocklist: DataFrame, key: str, out: str = "blocked",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Whether any upper-cased word of ``column`` is in ``blocklist(token)``."""
    upper = F.transform(_TOKENS, F.upper)
    listed = blocklist.select("token", F.lit("listed").alias("tag"))
    small, rows = _small_part(df, words(F.col(column)), listed, max_rows)
    if small is not None:
        checked = _any_batches(_ship(df, small))(F.coalesce(upper, F.array().cast("array<string>")))
        return rows.withColumn(out, checked).drop(_ROW, _TOKENS)

    hits = (
        rows.select(_ROW, F.explode(F.array_distinct(upper)).alias("token"))
        .join(blocklist.select("token"), "token", "left_semi")
        .select(_ROW)
        .distinct()
        .withColumn(out, F.lit(True))
    )
    return rows.join(hits, _ROW, "left").withColumn(out, F.coalesce(out, F.lit(False))).drop(_ROW, _TOKENS)


def drop_listed(
    df: DataFrame, column: str, blocklist: DataFrame, key: str,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows without any listed token; a null text is kept.

    The check stays where it is called, behind the cheap filters before it.
    """
    flagged = flag_listed(df, column, blocklist, key, "__blocked", max_rows)
    flagged = flagged.withColumn("__blocked", evaluated_once(F.col("__blocked")))
    return flagged.filter(~F.col("__blocked")).drop("__blocked")
