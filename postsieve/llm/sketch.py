"""Threshold-scaled sketches of documents.

A sketch keeps every shingle hash below a fixed fraction of the hash range,
and the smallest hash, so that no document with words has an empty one.  The
sketch of a union is the merge of the sketches; the share of the smaller
sketch found in the larger estimates containment, however unequal the two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.base import as_bytes

#: words of a shingle; one hash in ``SCALE`` stays; bits of a kept hash
SHINGLE, SCALE, BITS = 5, 2, 48
#: rows that share a sorted range, and the most ranges
RANGE_ROWS, MAX_RANGES = 256, 1024


def sketch(content: bytes, shingle: int = SHINGLE, scale: int = SCALE) -> np.ndarray:
    """Sorted hashes of a text's sketch; a text shorter than a shingle is one shingle."""
    import xxhash

    words = content.split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    width = min(shingle, len(words))
    rows = len(words) - width + 1
    mixed = np.full(rows, width, np.uint64)
    for j in range(width):
        mixed = (mixed ^ hashes[j:j + rows]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)
    return np.unique(np.append(mixed[mixed < np.uint64((1 << BITS) // scale)], mixed.min()))


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    union = np.union1d(a, b)
    kept = union < np.uint64((1 << BITS) // scale)
    kept[:1] = True
    return union[kept]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller sketch that the larger one has; two empty ones are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def written(hashes: np.ndarray) -> str:
    """A sketch as text: 12 hex digits for each hash, in order."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8:].tobytes().hex()


def read(text: str) -> np.ndarray:
    """A sketch back from its text."""
    raw = np.frombuffer(bytes.fromhex(text), np.uint8).reshape(-1, BITS // 8)
    return np.pad(raw, ((0, 0), (8 - BITS // 8, 0))).copy().view(">u8").ravel().astype(np.uint64)


def with_sketch(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the sketch of a text column; a column named ``out`` is replaced."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: written(sketch(as_bytes(t))), na_action=None)

    return docs.withColumn(out, run(F.col(text)))


def _ranges(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows dealt out to ranges of the key, with the first row of each range also in the range before.

    Adds __range, __tail (1: only the neighbour of the range's last row) and
    __mark.  The table of range starts has ``MAX_RANGES`` rows at most.
    """
    spark, n = docs.sparkSession, docs.count()
    count = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    shares = [i / count for i in range(1, count)]
    found = docs.agg(F.percentile_approx(key, shares, 20_000)).first()[0] if shares and n else None
    bounds = sorted(set(found or []))
    place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(key))) if bounds else F.lit(0)
    marked = docs.withColumn("__range", F.when(F.col(key).isNull(), 0).otherwise(place)).withColumn(
        "__mark", F.xxhash64(text))
    starts = marked.groupBy("__range").agg(F.min(F.struct(F.col(key).alias("k"), F.col("__mark").alias("m"))).alias("s"))
    known = sorted(starts.select("__range", "s.k", "s.m").collect())
    before = [(r[0], r[1], r[2], known[i - 1][0]) for i, r in enumerate(known)]
    kind = docs.schema[key].dataType.simpleString()
    table = spark.createDataFrame(before, f"__range int, __k {kind}, __m long, __before int")
    own = F.struct(F.col("__range").alias("__to"), F.lit(0).alias("__tail"))
    first = F.col(key).eqNullSafe(F.col("__k")) & (F.col("__mark") == F.col("__m"))
    copies = F.when(first, F.array(own, F.struct(F.col("__before").alias("__to"), F.lit(1).alias("__tail")))).otherwise(
        F.array(own))
    dealt = marked.join(F.broadcast(table), "__range")
    return dealt.select(key, text, "__mark", F.inline(copies)).withColumnRenamed("__to", "__range")


def with_neighbour(
    docs: DataFrame, fn: Callable[[], Callable[[object, str, object, str], dict]], schema: str,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``fn()(key, text, next text)`` for every row and the row after it, by key.

    Null keys come first, rows with equal keys go by a hash of their text, and
    after the last row comes the first.  No task sees more than the ranges
    dealt to it, as a sorted stream of which it holds two rows.
    """
    ordered = _ranges(docs, key, text).repartition("__range").sortWithinPartitions(
        "__range", "__tail", key, "__mark")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step, held, where, closed = fn(), None, None, True
        for batch in batches:
            out = []
            for place, tail, k, t in zip(batch["__range"], batch["__tail"], batch[key].astype(object), batch[text],
                                         strict=True):
                if place != where:
                    where, held, closed = place, None, False
                if closed:
                    continue  # repeats of the neighbour
                own = (None if pd.isna(k) else k, "" if t is None else t)
                if held is not None:
                    out.append(step(held[0], held[1], own[1]))
                held, closed = own, bool(tail)
            if out:
                yield pd.DataFrame(out)

    return ordered.mapInPandas(run, schema)


def edited_by_neighbour(
    docs: DataFrame, key: str = "doc_id", text: str = "text", scale: int = SCALE
) -> DataFrame:
    """Each document's sketch beside that of an edited copy and of the next document.

    The edit replaces the last quarter of the code points by as many from the
    start of the next document (all of it, if shorter).  A null text counts as
    empty; an empty text has an empty sketch, which is like another empty one
    only; repeated rows are rows of their own.  An empty table gives no rows.
    One hash in ``scale`` stays: the fewer shingles a text has, the further its
    likeness may be from that of all its hashes (see README for figures).
    """

    def start():
        kept: dict[str, np.ndarray] = {}

        def of(content: str) -> np.ndarray:
            if content not in kept:
                if len(kept) > 2:
                    kept.clear()
                kept[content] = sketch(content.encode("utf-8", "surrogatepass"), scale=scale)
            return kept[content]

        def one(k, content, following):
            tail = len(content) // 4
            edited = content[:len(content) - tail] + following[:tail]
            raw = edited.encode("utf-8", "surrogatepass")
            own, other, after = of(content), sketch(raw, scale=scale), of(following)
            return {key: k, "n_chars": len(content), "edited_sha256": hashlib.sha256(raw).hexdigest(),
                    "fingerprint": written(own), "edited_fingerprint": written(other),
                    "near_edited": containment(own, other), "near_next": containment(own, after)}

        return one

    kind = docs.schema[key].dataType.simpleString()
    schema = (f"{key} {kind}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    return with_neighbour(docs.select(key, text), start, schema, key, text)
