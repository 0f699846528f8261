"""Hard negatives by exact scores from Kronecker-packed products.

Components are shifted to be non-negative, and several candidates' components
share one wide integer, each in a field wide enough for a whole score.  One
product per anchor component then advances the scores of all candidates in the
integer; the fields of the sum are the scores, up to the shifts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.base import staged
from postsieve.llm.grid import LEAST, NO_ID, SCORE_ROWS, Best, Pack, blocks_of, chunks_of, known_ids, meet
from postsieve.llm.top_k import quantized

#: doubles hold integers of this many bits exactly, and multiply them by matrix
WIDE_BITS = 53
#: candidates in one wide integer where a score does not fit a double
LONG_FIELDS = 256


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of all anchors and rows; saturated at the range of a long.

    Fields are as wide as the largest score can be.  Integers of up to 53 bits
    are held in doubles, so that one matrix product multiplies them; where a
    score needs more, Python's integers take hundreds of fields each.
    """
    dim = rows.shape[1]
    a_low, c_low = int(anchors.min(initial=0)), int(rows.min(initial=0))
    a_top, c_top = int(anchors.max(initial=0)) - a_low, int(rows.max(initial=0)) - c_low
    width = max(1, (dim * a_top * c_top).bit_length())
    fields = WIDE_BITS // width
    if fields and dim * (a_top + abs(a_low)) * (c_top + abs(c_low)) < 1 << 60:
        a, c = anchors - a_low, rows - c_low
        each = -(-len(rows) // fields)
        padded = np.zeros((each * fields, dim), np.float64)
        padded[: len(rows)] = c
        wide = sum(padded[f * each:(f + 1) * each] * float(1 << f * width) for f in range(fields))
        total = (a.astype(np.float64) @ np.asarray(wide).T).astype(np.int64)
        score = np.concatenate([total >> f * width & (1 << width) - 1 for f in range(fields)], 1)[:, : len(rows)]
        return score + (c_low * a.sum(1) + dim * a_low * c_low)[:, None] + a_low * c.sum(1)[None, :]
    limit, out = np.iinfo(np.int64), np.zeros((len(anchors), len(rows)), np.int64)
    a = [[int(x) - a_low for x in row] for row in anchors.tolist()]
    mask = (1 << width) - 1
    for at in range(0, len(rows), LONG_FIELDS):
        c = [[int(x) - c_low for x in row] for row in rows[at:at + LONG_FIELDS].tolist()]
        wide = [sum(row[j] << f * width for f, row in enumerate(c)) for j in range(dim)]
        rest = [a_low * sum(row) + dim * a_low * c_low for row in c]
        for i, anchor in enumerate(a):
            total, shift = sum(x * w for x, w in zip(anchor, wide, strict=True)), c_low * sum(anchor)
            for f, more in enumerate(rest):
                out[i, at + f] = min(max((total >> f * width & mask) + shift + more, limit.min), limit.max)
    return out


class _Positives:
    """The best rows of an anchor's own label."""

    def __init__(self, block: Pack, k: int):
        self.block, self.best = block, Best(block.rows, k)

    def feed(self, pack: Pack) -> None:
        block = self.block
        for at in range(0, block.rows, SCORE_ROWS):
            part = slice(at, at + SCORE_ROWS)
            fits = block.labels[part, None] == pack.labels[None, :]
            own = np.flatnonzero(block.chunks[part] == pack.number)
            fits[own, block.places[part][own]] = False
            if fits.any():
                self.best.offer(at + np.arange(len(fits)), packed_scores(block.vectors[part], pack.vectors), fits, pack)

    def finish(self) -> pd.DataFrame:
        which, score, ids, chunk, place = self.best.rows
        return pd.DataFrame({"block": self.block.number, "anchor": which, "score": score,
                             "id": known_ids(ids), "chunk": chunk, "place": place})


class _Negatives:
    """The best rows of other labels in the score range of each anchor and positive."""

    def __init__(self, block: Pack, positives: bytes, slots: int, k: int, low: int, high: int):
        self.block, self.slots = block, slots
        self.best = Best(block.rows * slots, k)
        at, score, ids = np.frombuffer(positives, np.int64).reshape(3, -1)
        self.ids, self.positive = (np.zeros(block.rows * slots, np.int64) for _ in range(2))
        self.ids[at], self.positive[at] = ids, score
        # ranges in whole scores, by integers of any size; an empty range where there is no positive
        self.least = np.full(block.rows * slots, np.iinfo(np.int64).max)
        self.most = np.full(block.rows * slots, LEAST)
        self.least[at] = [-(-low * s // 100) for s in score.tolist()]
        self.most[at] = [high * s // 100 for s in score.tolist()]

    def feed(self, pack: Pack) -> None:
        block, slots = self.block, self.slots
        for at in range(0, block.rows, SCORE_ROWS):
            part = slice(at, at + SCORE_ROWS)
            other = block.labels[part, None] != pack.labels[None, :]
            score = packed_scores(block.vectors[part], pack.vectors)
            for slot in range(slots):
                lists = (at + np.arange(len(score))) * slots + slot
                fits = other & (score >= self.least[lists, None]) & (score <= self.most[lists, None])
                self.best.offer(lists, score, fits, pack)

    def finish(self) -> pd.DataFrame:
        which, score, ids, chunk, place = self.best.rows
        return pd.DataFrame({
            "block": self.block.number, "list": which, "anchor_id": self.block.ids[which // self.slots],
            "positive_id": known_ids(self.ids[which]), "negative_id": known_ids(ids),
            "positive_score": self.positive[which], "negative_score": score, "chunk": chunk, "place": place,
        })


def hard_negatives(
    vectors: DataFrame, divisor: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """For each anchor and each of its best positives the best rows of other labels in a score range.

    Anchors are the rows whose key is divisible by ``divisor``.  Components
    become ``floor(scale * x)``; a score is the integer inner product with the
    anchor.  Positives are the ``positives`` best other rows of the anchor's
    label; negatives the ``negatives`` best rows of another label whose score
    is ``low`` to ``high`` hundredths of the positive's.  High scores come
    first, ties by smaller keys (null last), then by place.  Rows with a null
    label, a null vector or a null or non-finite component take no part; only
    vectors of equal length are compared.  Rows that repeat a key are rows of
    their own; those of one anchor key each give rows.  A null key is no
    anchor.  An empty table gives no rows; other columns are not read.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        quantized(F.col(vector), scale).alias("vector"),
    ).filter("vector is not null and label is not null")
    chunks = chunks_of(rows)
    blocks = blocks_of(chunks, divisor)
    found = meet(blocks, chunks, lambda block, _: _Positives(block, positives),
                 "block long, anchor long, score long, id long, chunk long, place long")
    order = (F.desc("score"), F.asc_nulls_last("id"), "chunk", "place")
    slot = F.row_number().over(Window.partitionBy("block", "anchor").orderBy(*order)) - 1
    best = found.withColumn("slot", slot).filter(F.col("slot") < positives)

    def as_bytes(part: pd.DataFrame) -> pd.DataFrame:
        values = np.stack([part["anchor"] * positives + part["slot"], part["score"],
                           part["id"].astype("Int64").fillna(NO_ID)]).astype(np.int64)
        return pd.DataFrame({"number": [part["block"].iloc[0]], "positives": [values.tobytes()]})

    # at most BLOCK_ROWS anchors with a few positives each
    known = best.groupBy("block").applyInPandas(as_bytes, "number long, positives binary")
    ready = staged(blocks.join(known, "number"), "anchor-blocks")
    lists = meet(
        ready, chunks, lambda block, own: _Negatives(block, own, positives, negatives, low, high),
        "block long, list long, anchor_id long, positive_id long, negative_id long, positive_score long,"
        " negative_score long, chunk long, place long", extra="positives",
    )
    rank = F.row_number().over(Window.partitionBy("block", "list").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id"), "chunk", "place"))
    return lists.withColumn("rank", rank).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
