"""Near-duplicates by SimHash, pairs found through pivot distance tables.

The distance of two fingerprints is at least the difference of their distances
to any reference.  Distances to a random reference lie close together, so
random references cannot deal fingerprints out to tasks.  References with a
single bit can: with more than ``max_bits`` bands of such references, two linked
fingerprints have equal coordinates in all but ``max_bits`` whole bands at least, so
the coordinates (bits) of every choice of that many bands name a cell; the more
fingerprints there are, the more bands.  In a cell a table of distances to
many random references discards pairs by their largest coordinate difference,
and only the survivors are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.llm import packs as pk
from postsieve.llm.base import as_bytes, releasing, staged
from postsieve.llm.components import components

#: contract of the near-duplicate stage: shingle length and largest distance
SHINGLE, MAX_BITS = 4, 4
#: reference fingerprints of the distance table
PIVOTS = 24
#: what dealing out one key costs, in comparisons; bands tried beyond the fewest
KEY_COST, MORE_BANDS = 500, 5
#: members of a cell that meet as one block; larger cells go block by block
CELL_ROWS = 2048
_SEED = 42


def simhash(content: bytes, shingle: int) -> int:
    """Fingerprint of UTF-8 text as unsigned integer; 0 without words."""
    import xxhash

    words = content.lower().split()  # ASCII letters and white space only, as these are bytes
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, _SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], _SEED)
                  for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1:].tolist(), strict=True)]
    values, counts = np.array(hashes, "<u8"), np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 15):
        bits = np.unpackbits(values[at:at + (1 << 15)].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as (signed) long; see :func:`simhash`."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        values = [simhash((t or "").encode("utf-8", "surrogatepass"), shingle) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64), dtype="int64")

    return run(text)


def hex_digits(value: Column) -> Column:
    """16 lowercase hex digits of a long."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def pivot_table(values: np.ndarray) -> np.ndarray:
    """Distances of fingerprints to the references, one row per reference."""
    references = np.random.default_rng(_SEED).integers(0, 1 << 64, PIVOTS, np.uint64)
    return np.bitwise_count(values[None, :] ^ references[:, None]).astype(np.int8)


def close_pairs(values: np.ndarray, side: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``max_bits``, of unequal sides where two sides meet.

    Fingerprints go by their first coordinate, so a row meets only the window
    of rows whose first coordinate is close enough.
    """
    two = len(side) and side.min() != side.max()
    table = pivot_table(values)
    order = np.argsort(table[0], kind="stable")
    values, side, table = values[order], side[order], table[:, order]
    reach = np.searchsorted(table[0], table[0] + max_bits, "right")
    left, right = [], []
    step = max(1, (1 << 21) // max(1, len(values)))
    for at in range(0, len(values), step):
        rows = slice(at, min(at + step, len(values)))
        width = slice(at, int(reach[rows.stop - 1]))
        near = np.ones((rows.stop - at, width.stop - at), bool)
        for coordinate in table:
            near &= np.abs(coordinate[rows, None] - coordinate[None, width]) <= max_bits
        i, j = np.nonzero(near)
        keep = (j > i) & (side[rows][i] != side[width][j]) if two else j > i
        i, j = i[keep] + at, j[keep] + at
        sure = np.bitwise_count(values[i] ^ values[j]) <= max_bits
        left.append(order[i[sure]])
        right.append(order[j[sure]])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def _spanning(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to each group's smallest member in place of all links."""
    rank = np.argsort(np.argsort(values, kind="stable"), kind="stable")
    label = rank.copy()
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        by_rank = np.empty_like(label)
        by_rank[rank] = label
        label = by_rank[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != rank)
    place = np.argsort(rank, kind="stable")
    return values[member], values[place[label[member]]]


def _link_cells(max_bits: int):
    keys = ["band", "cell", "a", "b"]

    def one(part: pd.DataFrame) -> pd.DataFrame:
        values = part["fp"].to_numpy(np.int64)
        left, right = close_pairs(values.view(np.uint64), part["part"].to_numpy(), max_bits)
        u, v = _spanning(values, left, right)
        return pd.DataFrame({"u": u, "v": v})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            turn = (rows[keys] != rows[keys].shift()).any(axis=1).to_numpy()
            starts = np.flatnonzero(turn)
            for start, stop in zip(starts[:-1], starts[1:], strict=True):
                yield one(rows.iloc[start:stop])
            held = rows.iloc[starts[-1]:] if len(starts) else None
        if held is not None and len(held):
            yield one(held)

    return releasing(run)


def key_bands(n: int, max_bits: int) -> int:
    """Bands that a fingerprint is cut into so that ``n`` of them are dealt out at the least cost.

    Two linked fingerprints agree in all but ``max_bits`` of the bands at least.
    More bands make keys of more bits, so cells stay small however many
    fingerprints there are, and more keys for each fingerprint.
    """
    def cost(bands: int) -> float:
        return comb(bands, max_bits) * (KEY_COST + n / 2 ** (64 * (bands - max_bits) / bands))

    return min(range(max_bits + 1, min(64, max_bits + MORE_BANDS) + 1), key=cost)


def fingerprint_links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) that connect all fingerprints within ``max_bits`` of each other.

    ``fingerprints`` has distinct, non-null values ``fp``.  Every two close ones
    end up connected; of a dense group only spanning links come out.  A cell
    with many members is dealt out as pairs of blocks.
    """
    bands = key_bands(fingerprints.count(), max_bits)
    edges = [round(64 * i / bands) for i in range(bands + 1)]
    cells = []
    for i, chosen in enumerate(combinations(range(bands), bands - max_bits)):
        mask = sum((1 << edges[j + 1]) - (1 << edges[j]) for j in chosen)
        mask -= (mask >> 63) << 64  # as a signed long
        cells.append(F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(mask)).alias("cell")))
    dealt = fingerprints.select("fp", F.inline(F.array(*cells)))
    full = dealt.groupBy("band", "cell").agg(F.count("*").alias("n")).filter("n > 1").withColumn(
        "blocks", F.ceil(F.col("n") / CELL_ROWS).cast("int"))
    part = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    meets = (
        dealt.join(full.select("band", "cell", "blocks"), ["band", "cell"]).withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("band", "cell", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "fp")
    )
    keys = ["band", "cell", "a", "b"]
    return meets.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_link_cells(max_bits), "u long, v long")


def fingerprint_groups(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp`` and ``root`` (smallest fingerprint reachable) of every distinct value."""
    linked = components(fingerprint_links(fingerprints, max_bits))
    return fingerprints.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """Fingerprint and group of every row: key, fp, root, component_id.

    ``component_id`` is the smallest key reachable through links; null where
    all keys of the group are null.  Null and empty texts have fingerprint 0
    and are linked like any other.  Equal fingerprints count once in the
    search; every row gets a result, repeated rows the same.  An empty table
    gives no rows; other columns are not read.
    """
    prints = staged(docs.select(F.col(key).alias("key"), fingerprint(F.col(text), shingle).alias("fp")), "prints")
    distinct = prints.groupBy("fp").agg(F.min("key").alias("first"))
    groups = staged(fingerprint_groups(distinct.select("fp"), max_bits), "groups")
    smallest = groups.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    named = groups.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select(F.col("key").alias(key), "fp", "root", "component_id")


_PLACES = "pack long, place int, fp long, digest binary"


def _fingerprinted(key: str, text: str, shingle: int):
    """Place, key, fingerprint and digest of every document of a pack."""
    import xxhash

    def run(pack: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        contents = [as_bytes(t) for t in table[text].to_pylist()]
        prints = np.array([simhash(c, shingle) for c in contents], np.uint64).view(np.int64)
        n = len(contents)
        yield pa.record_batch([
            pa.array(np.full(n, pack)), pa.array(np.arange(n, dtype=np.int32)), pa.array(prints),
            pa.array([xxhash.xxh3_128_digest(c) for c in contents], pa.binary()), table[key].combine_chunks()],
            names=["pack", "place", "fp", "digest", "key"])

    return run


def one_per_group(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """The documents of ``docs`` without near-duplicates, same columns.

    Of each group the row with the smallest key stays (a null key is the
    largest); of rows that repeat it, one, chosen by fingerprint and a digest
    of the text.  Texts stay in their packs: only places, keys and fingerprints
    go through the search.
    """
    packs = pk.packed(docs, text)
    kind = T.StructType.fromDDL(_PLACES).add("key", docs.schema[key].dataType)
    prints = staged(pk.mapped(packs, _fingerprinted(key, text, shingle), kind), "prints")
    groups = staged(fingerprint_groups(prints.select("fp").distinct(), max_bits), "groups")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "fp", "digest", "pack", "place")
    best = prints.join(groups, "fp").groupBy("root").agg(F.min(order).alias("best"))

    def take(_: int, table: pa.Table, kept: pa.Array) -> Iterator[pa.RecordBatch]:
        if len(kept):
            yield from table.take(pa.array(np.sort(kept.field("place").to_numpy()))).to_batches()

    return pk.joined(packs, best.select("best.pack", "best.place"), take, docs.schema)
