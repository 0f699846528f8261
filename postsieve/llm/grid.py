"""A stated set of query vectors against all vectors, in packed blocks.

All rows go into chunks of a few thousand; the query rows, taken out of the
chunks, into blocks.  A task takes one query block and a stripe of chunks, one
chunk at a time, and keeps only the best rows of each query.  So what a task
holds is bounded, and what leaves it is one short list per query and stripe.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.base import staged

#: rows of a chunk, queries of a block, queries that are scored at once
CHUNK_ROWS, BLOCK_ROWS, SCORE_ROWS = 4096, 4096, 256
#: tasks for each core of the session, where there are chunks enough
TASKS_PER_CORE = 4
#: most partitions of the meeting; more pairs of block and stripe share them
MOST_PARTITIONS = 50_000
#: stands for a null id inside a task; sorts last
NO_ID = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min

_PACK = "number long, dim int, rows int, ids binary, labels binary, chunks binary, places binary, kind string, vectors binary"
_NAMES = [c.split()[0] for c in _PACK.split(", ")]
_ARROW = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}[c.split()[1]]
          for c in _PACK.split(", ")]


def _packed(number: int, ids: np.ndarray, labels: np.ndarray, chunks: np.ndarray, places: np.ndarray,
            vectors: np.ndarray) -> list:
    kind = next(k for k in ("int8", "int16", "int32", "int64")
                if not vectors.size or (np.iinfo(k).min <= vectors.min() and vectors.max() <= np.iinfo(k).max))
    whole = [np.ascontiguousarray(v, np.int64).tobytes() for v in (ids, labels, chunks, places)]
    return [number, vectors.shape[1], len(ids), *whole, kind, vectors.astype(kind).tobytes()]


def pack_of(number: int, ids: np.ndarray, vectors: np.ndarray) -> Pack:
    """A chunk of these rows."""
    zeros = np.zeros(len(ids), np.int64)
    row = _packed(number, ids, zeros, zeros + number, np.arange(len(ids)), vectors)
    return Pack(SimpleNamespace(**dict(zip(_NAMES, row, strict=True))))


class Pack:
    """The rows of one chunk or block."""

    def __init__(self, row):
        self.number, self.rows = row.number, row.rows
        self.ids, self.labels, self.chunks, self.places = (
            np.frombuffer(getattr(row, name), np.int64) for name in ("ids", "labels", "chunks", "places"))
        self.vectors = np.frombuffer(row.vectors, row.kind).reshape(row.rows, row.dim).astype(np.int64)


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and vectors of the rows of each vector length."""
    sizes = pc.list_value_length(batch.column("vector"))
    for dim in pc.unique(sizes).to_pylist():
        part = batch.filter(pc.equal(sizes, dim))
        values = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dim)
        ids, labels = (pc.fill_null(part.column(c), NO_ID).to_numpy(zero_copy_only=False) for c in ("id", "label"))
        yield ids, labels, values


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    held: dict[int, list] = {}

    def flush(dim: int) -> pa.RecordBatch:
        nonlocal number
        ids, labels, values = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
        number += 1
        row = _packed(number, ids, labels, np.full(len(ids), number), np.arange(len(ids)), values)
        return pa.record_batch([pa.array([v], t) for v, t in zip(row, _ARROW, strict=True)], names=_NAMES)

    for batch in batches:
        for ids, labels, values in _matrices(batch):
            for at in range(0, len(ids), CHUNK_ROWS):
                rows = slice(at, at + CHUNK_ROWS)
                mine = held.setdefault(values.shape[1], [])
                mine.append((ids[rows], labels[rows], values[rows]))
                if sum(len(m[0]) for m in mine) >= CHUNK_ROWS:
                    yield flush(values.shape[1])
    for dim in list(held):
        yield flush(dim)


def chunks_of(rows: DataFrame) -> DataFrame:
    """Rows (id long, label long, vector array<long>) as written chunks; no shuffle."""
    return staged(rows.select("id", "label", "vector").mapInArrow(_chunked, _PACK), "vector-chunks")


def blocks_of(chunks: DataFrame, divisor: int) -> DataFrame:
    """The rows whose id is divisible by ``divisor`` as written query blocks."""

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                pack = Pack(row)
                at = np.flatnonzero((pack.ids % divisor == 0) & (pack.ids != NO_ID))
                if len(at):
                    yield pd.DataFrame([_packed(pack.number, pack.ids[at], pack.labels[at], pack.chunks[at],
                                                pack.places[at], pack.vectors[at])], columns=_NAMES)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, list[Pack]] = {}

        def flush(dim: int) -> pd.DataFrame:
            nonlocal number
            number += 1
            part = held.pop(dim)
            whole = [np.concatenate([getattr(p, name) for p in part])
                     for name in ("ids", "labels", "chunks", "places", "vectors")]
            return pd.DataFrame([_packed(number, *whole)], columns=_NAMES)

        for batch in batches:
            for row in batch.itertuples():
                if row.dim in held and sum(p.rows for p in held[row.dim]) + row.rows > BLOCK_ROWS:
                    yield flush(row.dim)
                held.setdefault(row.dim, []).append(Pack(row))
        for dim in list(held):
            yield flush(dim)

    taken = staged(chunks.mapInPandas(take, _PACK), "queries")
    n = taken.agg(F.sum("rows")).first()[0] or 0
    return staged(taken.repartition(max(1, -(-n // BLOCK_ROWS))).mapInPandas(merge, _PACK), "query-blocks")


def meet(blocks: DataFrame, chunks: DataFrame, make: Callable, schema: str, extra: str | None = None) -> DataFrame:
    """``make(block, extra)`` is fed every chunk of equal vector length; its results as rows.

    The object takes chunks by ``feed(pack)`` and gives a pandas frame by
    ``finish()``.  ``extra`` names a binary column of ``blocks`` for it.
    """
    spark = blocks.sparkSession
    n_blocks, n_chunks = blocks.count(), max(1, chunks.count())
    cores = spark.sparkContext.defaultParallelism
    stripes = min(n_chunks, -(-TASKS_PER_CORE * cores // max(1, n_blocks)))
    more = F.col(extra) if extra else F.lit(None).cast("binary")
    first = blocks.select(*_NAMES, more.alias("extra")).withColumns({"block": F.col("number"), "is_chunk": F.lit(False)})
    first = first.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    # one narrow row for each block of queries
    names = F.broadcast(blocks.select("dim", F.col("number").alias("block")))
    then = chunks.join(names, "dim").withColumns({
        "stripe": F.pmod(F.xxhash64("number"), F.lit(stripes)).cast("int"),
        "extra": F.lit(None).cast("binary"), "is_chunk": F.lit(True)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for batch in batches:
            for row in batch.itertuples():
                if row.is_chunk:
                    state.feed(Pack(row))
                else:
                    if state is not None:
                        yield state.finish()
                    state = make(Pack(row), row.extra)
        if state is not None:
            yield state.finish()

    order = ["block", "stripe", "is_chunk"]
    both = first.unionByName(then).repartition(max(1, min(MOST_PARTITIONS, n_blocks * stripes)), "block", "stripe")
    return both.sortWithinPartitions(*order, "number").mapInPandas(run, schema)


class Best:
    """The ``k`` best rows of each of many lists: high scores, small ids, early rows."""

    def __init__(self, lists: int, k: int):
        self.k, self.floor, self.size = k, np.full(lists, LEAST), np.zeros(lists, np.int64)
        # score, id, chunk, place; a list has its first ``size`` entries
        self.table = np.zeros((4, lists, k), np.int64)

    @property
    def rows(self) -> tuple[np.ndarray, ...]:
        """List, score, id, chunk and place of every entry, list by list, best first."""
        used = np.arange(self.k) < self.size[:, None]
        return (np.nonzero(used)[0], *(column[used] for column in self.table))

    def offer(self, lists: np.ndarray, score: np.ndarray, fits: np.ndarray, pack: Pack, start: int = 0) -> None:
        """Scores of one list per row, for the pack's rows from ``start`` on, where they fit."""
        fits = fits & (score >= self.floor[lists][:, None])
        some = fits.any(1)
        if not some.any():
            return
        lists, score, fits = lists[some], score[some], fits[some]
        if score.shape[1] > self.k:
            kept = np.where(fits, score, LEAST)
            fits &= score >= np.partition(kept, score.shape[1] - self.k, axis=1)[:, [score.shape[1] - self.k]]
        i, j = np.nonzero(fits)
        # only the lists that get something are sorted again
        used = np.arange(self.k) < self.size[lists][:, None]
        held = np.nonzero(used)[0]
        new = (score[i, j], pack.ids[start + j], np.full(len(j), pack.number), start + j)
        which = np.concatenate([held, i])
        points, ids, chunk, place = (
            np.concatenate([column[lists][used], more]) for column, more in zip(self.table, new, strict=True))
        order = np.lexsort((place, chunk, ids, ~points, which))
        which = which[order]
        nth = np.arange(len(which)) - np.searchsorted(which, which)
        order, which, nth = order[nth < self.k], which[nth < self.k], nth[nth < self.k]
        for column, values in zip(self.table, (points, ids, chunk, place), strict=True):
            column[lists[which], nth] = values[order]
        self.size[lists] = np.bincount(which, minlength=len(lists))
        full = lists[self.size[lists] == self.k]
        self.floor[full] = self.table[0, full, self.k - 1]


def known_ids(ids: np.ndarray) -> pd.Series:
    """Ids with nulls again."""
    return pd.Series(pd.array(ids, "Int64")).mask(pd.Series(ids == NO_ID))
