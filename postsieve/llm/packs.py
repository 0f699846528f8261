"""Documents in packs: rows that each hold about a megabyte of whole documents.

Operators that look at every position of every text read packs.  A pack is one
compressed Arrow batch with all columns of its documents, so few large rows
cross a shuffle in place of many wide ones.  The table is written once; pack
numbers and positions inside a pack stay valid for every later step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.base import releasing, staged

#: bytes of text in a pack; a longer document is a pack of its own
PACK_BYTES = 1 << 20
_SCHEMA = "pack long, data binary"
_OUT = pa.schema([("pack", pa.int64()), ("data", pa.binary())])


def _sizes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The pack table of ``docs``; a map over the scan, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            whole = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(whole)
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=_OUT)

        for batch in batches:
            sizes = _sizes(batch[text]) if len(batch) else []
            start = 0
            for row, n in enumerate(sizes):
                if size and size + n > PACK_BYTES:
                    if row > start:
                        held.append(batch.slice(start, row - start))
                    yield flush()
                    held, size, start = [], 0, row
                size += int(n) + 1
            if len(batch) > start:
                held.append(batch.slice(start))
        if held:
            yield flush()

    return staged(docs.mapInArrow(releasing(run), _SCHEMA), "packs")


def unpacked(data: bytes) -> pa.Table:
    """The documents of one pack."""
    with pa.ipc.open_stream(data) as stream:
        return stream.read_all().combine_chunks()


def contents(table: pa.Table, text: str) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and where each begins (one entry more than rows)."""
    column = pc.fill_null(table[text], "").cast(pa.large_binary())
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[places[0]:places[-1]], places - places[0]


def first_copies(raw: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each row the first row of the pack with the same text."""
    whole, seen = raw.tobytes(), {}
    return np.array([seen.setdefault(whole[a:b], i) for i, (a, b) in enumerate(zip(places[:-1], places[1:], strict=True))],
                    np.int64)


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, in three passes."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    fill = np.iinfo(values.dtype).max if pick is np.minimum else 0
    square = np.concatenate([values, np.full(-len(values) % width, fill, values.dtype)]).reshape(-1, width)
    ahead = pick.accumulate(square, axis=1).ravel()
    behind = pick.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:n], ahead[width - 1:width - 1 + n])


def winnowed(hashes: np.ndarray, width: int, inside: np.ndarray) -> np.ndarray:
    """Places whose hash is the least of some ``width`` neighbours that start where ``inside``.

    Depends on the content of those neighbours alone: equal stretches choose
    equal places.  Ties are all chosen.
    """
    least = sliding(hashes, width, np.minimum)
    if not len(least):
        return np.zeros(0, np.int64)
    least = np.where(inside[:len(least)], least, 0)
    edge = np.zeros(width - 1, hashes.dtype)
    return np.flatnonzero((sliding(np.concatenate([edge, least, edge]), width, np.maximum) == hashes) & (hashes > 0))


def joined(packs: DataFrame, notes: DataFrame, fn: Callable, schema) -> DataFrame:
    """``fn(pack number, documents, notes)`` for every pack, where ``notes`` has pack and any columns.

    ``notes`` of a pack arrive as one Arrow struct array (empty if there are
    none); they are about places inside the pack, so their number is bounded
    by its size.  ``fn`` yields record batches.
    """
    columns = [c for c in notes.columns if c != "pack"]
    listed = notes.groupBy("pack").agg(F.collect_list(F.struct(*columns)).alias("notes"))
    both = packs.join(listed, "pack", "left").select("pack", "data", "notes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                found = batch["notes"].slice(i, 1).flatten()
                yield from fn(batch["pack"][i].as_py(), unpacked(batch["data"][i].as_py()), found)

    return both.mapInArrow(releasing(run), schema)


def mapped(packs: DataFrame, fn: Callable, schema) -> DataFrame:
    """``fn(pack number, documents)`` for every pack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                yield from fn(batch["pack"][i].as_py(), unpacked(batch["data"][i].as_py()))

    return packs.mapInArrow(releasing(run), schema)


def grouped(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[tuple[pa.Table, bool]]:
    """Sorted batches cut at changes of ``key`` into tables of whole groups, about ``rows`` rows each.

    A group above ``rows`` rows comes in pieces, flagged, as it streams past: no
    more than ``rows`` rows and one batch are held, however large a group is.
    """
    held: list[pa.RecordBatch] = []
    size, hot = 0, None

    def cut(final: bool) -> Iterator[tuple[pa.Table, bool]]:
        nonlocal held, size, hot
        whole = pa.Table.from_batches(held).combine_chunks()
        values = whole[key].to_numpy()
        starts = np.flatnonzero(values[1:] != values[:-1]) + 1
        begin = 0
        if hot is not None and values[0] == hot:
            begin = int(starts[0]) if len(starts) else len(whole)
            yield whole.slice(0, begin), True
        if begin < len(whole):
            hot = None
        last = len(whole) if final else max(begin, int(starts[-1]) if len(starts) else 0)
        if last > begin:
            yield whole.slice(begin, last - begin), False
        rest = whole.slice(last)
        if len(rest) >= rows:
            hot = values[-1]
            yield rest, True
            rest = rest.slice(len(rest))
        held = [b for b in rest.combine_chunks().to_batches() if len(b)]
        size = len(rest)

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += len(batch)
        if size >= rows:
            yield from cut(False)
    if held:
        yield from cut(True)


def spans(windows: DataFrame, length: int) -> DataFrame:
    """Notes from windows (pack, place, offset): windows of one place all cover it, so they make one range."""
    return windows.groupBy("pack", "place").agg(F.min("offset").alias("least"), F.max("offset").alias("most")).select(
        "pack", (F.col("place") - F.col("most")).cast("int").alias("place"),
        (F.col("place") - F.col("least") + length).cast("int").alias("last"))


def merged(starts: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Mask of the places in any of the half-open ranges."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, stops, -1)
    return np.cumsum(change[:-1]) > 0
