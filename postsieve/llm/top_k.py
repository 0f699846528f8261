"""Exact top-k inner products by block-at-a-time pruning.

Vectors are packed, in the order of their ids, into chunks of consecutive
blocks.  A block keeps the largest and smallest value of each component, so
``sum(max(q * largest, q * smallest))`` bounds every score in it.  For each
query the blocks of a chunk are scored in the order of their bounds, through
the block's own matrix, until the bound falls below the query's k-th score.  A
task takes many chunks one after another, so the k-th score of the earlier ones
prunes the later ones, whole where no block's bound reaches it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.grid import Best, Pack, blocks_of, chunks_of, known_ids, meet

#: rows of a block
BLOCK_ROWS = 1024


def quantized(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, null for a vector that takes no part."""
    usable = vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))
        & ~F.isnan(x.cast("double"))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; saturated where they leave the range of a long."""
    most = max(1, a.shape[1]) * float(np.abs(a.astype(float)).max(initial=0)) * float(
        np.abs(b.astype(float)).max(initial=0))
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    limit = np.iinfo(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, limit.min, limit.max).astype(np.int64)


class Search:
    """The ``k`` best rows for each query of a block, over the chunks fed so far."""

    def __init__(self, block: Pack, k: int):
        self.block, self.best = block, Best(block.rows, k)
        self.queries = block.vectors.astype(float)
        self.up, self.down = np.maximum(self.queries, 0), np.minimum(self.queries, 0)
        #: block scorings done, and those without any pruning
        self.scored = self.possible = 0

    def feed(self, pack: Pack) -> None:
        starts = np.arange(0, pack.rows, BLOCK_ROWS)
        rows = pack.vectors.astype(float)
        high, low = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)
        most = max(1, rows.shape[1]) * np.abs(self.queries).max(initial=0) * np.abs(rows).max(initial=0)
        bounds = self.up @ high.T + self.down @ low.T
        bounds += np.abs(bounds) * 1e-9 + 0.5  # above every rounding error
        order = np.argsort(-bounds, axis=1, kind="stable")
        own = np.where(self.block.chunks == pack.number, self.block.places, -1)
        active = np.arange(self.block.rows)
        self.possible += len(active) * len(starts)
        for turn in range(len(starts)):
            block = order[active, turn]
            open_ = bounds[active, block] >= self.best.floor[active]
            active, block = active[open_], block[open_]
            if not len(active):
                break
            for b in np.unique(block):
                mine = active[block == b]
                self.scored += len(mine)
                start, stop = starts[b], min(starts[b] + BLOCK_ROWS, pack.rows)
                if most < 2**53:
                    score = (self.queries[mine] @ rows[start:stop].T).astype(np.int64)
                else:
                    score = _products(self.block.vectors[mine], pack.vectors[start:stop])
                self.best.offer(mine, score, np.arange(start, stop) != own[mine, None], pack, start)

    def finish(self) -> pd.DataFrame:
        which, score, ids, chunk, place = self.best.rows
        return pd.DataFrame({
            "block": self.block.number, "query": which, "query_id": self.block.ids[which], "vec_id": known_ids(ids),
            "chunk": chunk, "place": place, "score": score,
        })


def top_k(
    vectors: DataFrame, k: int, divisor: int, scale: int = 64, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` highest integer inner products of every query row.

    Queries are the rows whose id is divisible by ``divisor``; candidates are
    all rows but the query's own.  Components become ``floor(scale * x)``.
    Vectors that are null or hold null or non-finite components take no part.
    Only vectors of equal length are compared.  A null id is no query; as a
    candidate it loses every tie.  Rows that repeat an id are rows of their
    own, each a query and a candidate.  A query with fewer candidates gets all
    of them; an empty table gives no rows.  Products saturate at the range of a
    long.  Other columns are not read.
    """
    ints = vectors.select(
        F.col(key).cast("long").alias("id"), F.lit(None).cast("long").alias("label"),
        quantized(F.col(vector), scale).alias("vector"),
    ).filter("vector is not null")
    chunks = chunks_of(ints.repartitionByRange("id").sortWithinPartitions("id"))
    # the stated queries, in packed blocks, against all packed blocks
    found = meet(
        blocks_of(chunks, divisor), chunks, lambda block, _: Search(block, k),
        "block long, query long, query_id long, vec_id long, chunk long, place long, score long")
    best = Window.partitionBy("block", "query").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "chunk", "place"
    )
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
