"""Importance resampling of documents towards the word statistics of a target.

Features (runs of words) fall into buckets by the CRC-32 of their bytes.  A
bucket's gain is the scaled logarithm of how much likelier the target makes it
than the corpus does; a document's weight is the sum of its features' gains.
Adding Gumbel noise from a hash of the key and taking the highest scores draws
documents without replacement, in proportion to exp(weight / 1000).

Checksums are taken for all distinct features of a slice together: features of
equal length form the rows of a two-dimensional byte array, all checksums
advance column by column, and the results scatter back to the features.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.llm.base import staged
from postsieve.operators.ordering import number_rows

#: text of a slice in bytes, and its features that are looked at together
SLICE_BYTES, SLICE_FEATURES = 4 << 20, 1 << 19
#: features up to this length share matrices; longer ones are rare and go one by one
MATRIX_BYTES = 64

#: A-Z to lower case; digits, letters and all bytes beyond ASCII stay; the rest is space
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def _byte_table() -> np.ndarray:
    """What each byte does to a CRC-32 (reflected polynomial EDB88320)."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, value >> 1 ^ np.uint32(0xEDB88320), value >> 1)
    return value


def checksums(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every feature, by one matrix for each length."""
    out = np.zeros(len(features), np.uint32)
    if not features:
        return out
    table = _byte_table()
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(sizes, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        width = int(sizes[places[0]])
        if width > MATRIX_BYTES:
            out[places] = [zlib.crc32(features[i]) for i in places.tolist()]
            continue
        rows = np.frombuffer(b"".join([features[i] for i in places.tolist()]), np.uint8).reshape(len(places), width)
        state = np.full(len(places), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(rows.T):
            state = table[(state ^ column) & 0xFF] ^ state >> 8
        out[places] = ~state
    return out


def _slices(texts: list[bytes | None], max_run: int) -> Iterator[tuple[list[bytes], list[int], list[int], list[int]]]:
    """Features in slices of bounded size: features, and per row touched its number, features and words."""
    features: list[bytes] = []
    rows: list[int] = []
    sizes: list[int] = []
    words: list[int] = []
    for row, text in enumerate(texts):
        data, at, tail = (text or b"").translate(_WORD_BYTES), 0, []
        while at < len(data):
            stop = at + SLICE_BYTES
            if stop < len(data):
                stop = data.find(b" ", stop)
                stop = len(data) if stop < 0 else stop
            found, at = data[at:stop].split(), stop
            before = len(features)
            features += found
            if max_run > 1:
                run = tail + found
                for end in range(len(tail), len(run)):
                    features += [b" ".join(run[start:end + 1]) for start in range(max(0, end - max_run + 1), end)]
                tail = run[len(run) - max_run + 1:] if len(run) >= max_run else run
            rows.append(row)
            sizes.append(len(features) - before)
            words.append(len(found))
            if len(features) >= SLICE_FEATURES:
                yield features, rows, sizes, words
                features, rows, sizes, words = [], [], [], []
    if rows:
        yield features, rows, sizes, words


def _bucketed(batch: pa.RecordBatch, column: int, max_run: int, buckets: int):
    """For each slice of a batch: rows touched, their features and words, the bucket of every feature."""
    texts = batch.column(column).cast(pa.large_binary()).to_pylist()
    for features, rows, sizes, words in _slices(texts, max_run):
        codes, distinct = pd.factorize(np.array(features, object)) if features else (np.zeros(0, np.int64), [])
        found = (checksums(list(distinct)) % np.uint32(buckets)).astype(np.int64)
        yield np.array(rows), np.array(sizes), np.array(words), found[codes] if features else np.zeros(0, np.int64)


def bucket_counts(texts: DataFrame, text: str = "text", max_run: int = 1, buckets: int = 10_000) -> DataFrame:
    """Features per bucket over all texts; each task sends at most ``buckets`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in _bucketed(batch, 0, max_run, buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    found = texts.select(F.col(text).cast("string")).mapInArrow(run, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """``floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))`` of every bucket.

    Two tables of at most ``buckets`` rows reach the driver.
    """
    counts = []
    for df in (corpus, target):
        values = np.zeros(buckets, np.int64)
        for row in df.collect():
            values[row["bucket"]] = row["n"]
        counts.append(values.tolist())
    all_s, all_t = (float(sum(values) + buckets) for values in counts)
    return np.array([
        math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in zip(*counts, strict=True)
    ], np.int64)


def _weigh(gain: np.ndarray, max_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, words, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for rows, sizes, found_words, found in _bucketed(batch, 1, max_run, len(gain)):
                np.add.at(features, rows, sizes)
                np.add.at(words, rows, found_words)
                upto = np.concatenate([[0], np.cumsum(gain[found])])
                ends = np.cumsum(sizes)
                np.add.at(weight, rows, upto[ends] - upto[ends - sizes])
            yield pa.record_batch(
                [batch.column(0), pa.array(features), pa.array(words), pa.array(weight)],
                names=["key", "n_features", "n_words", "weight"],
            )

    return run


def scored(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
    max_run: int = 1, buckets: int = 10_000, seed: int = 2024,
) -> DataFrame:
    """key, n_features, n_words, weight and score of every document.

    Counts cover all texts of ``docs`` and ``target``.  Null and empty texts
    have no features and weight 0.  The noise of a score comes from the SHA-256
    of ``seed:key`` (a null key counts as empty text), so reruns agree.
    """
    gain = gains(bucket_counts(docs, text, max_run, buckets), bucket_counts(target, text, max_run, buckets), buckets)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType),
                           *(T.StructField(name, T.LongType()) for name in ("n_features", "n_words", "weight"))])
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.mapInArrow(_weigh(gain, max_run), schema).withColumn("score", F.col("weight") + noise)


def resample(
    docs: DataFrame, target: DataFrame, share: float = 0.1, min_words: int = 20, key: str = "doc_id",
    text: str = "text", max_run: int = 1, buckets: int = 10_000, seed: int = 2024,
) -> DataFrame:
    """Every document's key, n_features, weight, score and rank; rank is null for those not drawn.

    Of the documents with at least ``min_words`` words, ``floor(share * N)``
    highest scores are drawn, ties to smaller keys (a null key is the largest),
    then to fewer features.  Rows that repeat a key count and are drawn on
    their own; equal rows take neighbouring ranks.  Other columns are not read; an empty table gives no
    rows, an empty target only flattens the gains.
    """
    rows = staged(scored(docs, target, key, text, max_run, buckets, seed), "scored")
    fit = F.col("n_words") >= min_words
    eligible = rows.filter(fit).count()
    # share is taken in millionths, so that 0.1 of 30 is 3
    drawn = eligible * round(share * 1_000_000) // 1_000_000
    ranked = number_rows(
        rows.withColumn("unfit", ~fit), F.asc("unfit"), F.desc("score"), F.asc_nulls_last("key"), F.asc("n_features"),
        out="place")
    rank = F.when(~F.col("unfit") & (F.col("place") < drawn), F.col("place").cast("long") + 1)
    return ranked.select(F.col("key").alias(key), "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, ranks: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key was drawn, same columns."""
    chosen = ranks.filter("rank is not null").select(F.col(key).alias("__drawn")).distinct()
    return docs.join(chosen, F.col(key).eqNullSafe(F.col("__drawn")), "left_semi")
