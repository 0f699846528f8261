"""Substring de-duplication by seed and extend.

Seeds are winnowed runs of ``SEED`` words: every window of the threshold length
contains one, and equal windows contain equal ones.  Documents meet on equal
seeds.  Where the words around a seed are the same as well, as far as a window
can reach, the later occurrence is settled at once.  One occurrence of each
different surrounding goes on to the extension: outwards both ways, word by
word, the earliest occurrence with the same words on either side is found for
each place of the seed in a window.  Overlapping matches add up to maximal
repeats.  A seed with more different surroundings than one task extends sends
its windows out one by one, and the earliest of each is an aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm import packs as pk

#: words of a repeat; words of a seed
LENGTH, SEED = 20, 10
#: rows of seeds that a task extends at once, whole groups
EXTEND_ROWS = 50_000
_ODD = np.uint64(0x9E3779B97F4A7C15)

_FOUND = pa.schema([("hash", pa.int64()), ("around", pa.int64()), ("null_doc", pa.bool_()), ("doc", pa.int64()),
                    ("mark", pa.int64()), ("at", pa.int32()), ("pack", pa.int64()), ("place", pa.int32())])
_ORDER = ["null_doc", "doc", "mark", "at"]


def _spark(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


class _Words:
    """Words of a pack's distinct texts, their hashes, and where each text begins."""

    def __init__(self, table: pa.Table, key: str, text: str):
        import xxhash

        raw, places = pk.contents(table, text)
        self.first = pk.first_copies(raw, places)
        whole = raw.tobytes()
        self.words: list[list[bytes]] = []
        for i, f in enumerate(self.first):
            self.words.append(whole[places[i]:places[i + 1]].split() if f == i else self.words[f])
        own = self.first == np.arange(len(self.first))
        sizes = np.array([len(w) if o else 0 for w, o in zip(self.words, own, strict=True)], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        flat = [w for words, o in zip(self.words, own, strict=True) if o for w in words]
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
        self.marks = np.array([xxhash.xxh64_intdigest(whole[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)],
                              np.uint64).view(np.int64)
        keys = table[key].combine_chunks()
        self.null = pc.is_null(keys).to_numpy(zero_copy_only=False)
        self.keys = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        # a text's place in the order is that of its smallest key
        self.lead = np.arange(len(self.first))
        for i, f in enumerate(self.first):
            if (not self.null[i], self.keys[i]) < (not self.null[self.lead[f]], self.keys[self.lead[f]]):
                self.lead[f] = i
        self.doc = np.repeat(np.arange(len(sizes)), sizes)

    def seeds(self) -> np.ndarray:
        """Places of the winnowed seeds among all words of the pack."""
        n = len(self.hashes)
        mixed = np.zeros(max(0, n - SEED + 1), np.uint64)
        for j in range(SEED):
            mixed = (mixed ^ self.hashes[j:j + len(mixed)]) * _ODD
            mixed ^= mixed >> np.uint64(29)
        if not len(mixed):
            return np.zeros(0, np.int64)
        ends = self.starts[self.doc + 1]
        here = np.arange(len(mixed))
        mixed[here + SEED > ends[:len(mixed)]] = np.iinfo(np.uint64).max
        found = pk.winnowed(mixed, LENGTH - SEED + 1, here + LENGTH <= ends[:len(mixed)])
        self.mixed = mixed
        return found

    def around(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the words before and after seeds, nearest first, and how many there are."""
        reach = LENGTH - SEED
        left = np.minimum(places - self.starts[self.doc[places]], reach)
        right = np.minimum(self.starts[self.doc[places] + 1] - places - SEED, reach)
        steps = np.arange(reach)
        before = self.hashes[np.maximum(places[:, None] - 1 - steps, 0)]
        after = self.hashes[np.minimum(places[:, None] + SEED + steps, max(0, len(self.hashes) - 1))]
        before[steps >= left[:, None]] = 0
        after[steps >= right[:, None]] = 0
        return before, after, left, right


def _fold(words: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Running hash over columns: column ``i`` covers the first ``i`` words."""
    out = np.empty((len(words), words.shape[1] + 1), np.uint64)
    out[:, 0] = start
    for i in range(words.shape[1]):
        mixed = (out[:, i] ^ words[:, i]) * _ODD
        out[:, i + 1] = mixed ^ (mixed >> np.uint64(31))
    return out


def _find(key: str, text: str):
    def run(pack: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        words = _Words(table, key, text)
        at = words.seeds()
        before, after, left, right = words.around(at)
        around = _fold(after, _fold(before, left.astype(np.uint64) << np.uint64(8) | right.astype(np.uint64))[:, -1])[:, -1]
        doc = words.doc[at]
        lead = words.lead[doc]
        yield pa.RecordBatch.from_arrays([
            pa.array(words.mixed[at].view(np.int64) if len(at) else np.zeros(0, np.int64)), pa.array(around.view(np.int64)),
            pa.array(~words.null[lead]), pa.array(words.keys[lead]), pa.array(words.marks[doc]),
            pa.array((at - words.starts[doc]).astype(np.int32)), pa.array(np.full(len(at), pack)),
            pa.array(at.astype(np.int32)),
        ], schema=_FOUND)

    return run


_NOTES = pa.schema([("pack", pa.int64()), ("place", pa.int32()), ("last", pa.int32())])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Notes (pack, place, last) about seeds sorted by hash, surroundings and order.

    ``last`` -1: every window around the seed occurs earlier; -2: the first of
    its surroundings, to be extended.  Seeds of one surroundings only that
    come first are not noted.  Needs one row of memory from batch to batch.
    """
    kept = None  # the last group's first row, while it has no second surroundings
    end = None  # hash, surroundings and order of the last row
    for batch in batches:
        if not len(batch):
            continue
        column = {n: batch[n].to_numpy(zero_copy_only=False) for n in batch.schema.names}
        hashes, around = column["hash"], column["around"]
        order = np.stack([column[n].astype(np.int64) for n in _ORDER])
        new_hash, new_around, same = (np.ones(len(batch), bool) for _ in range(3))
        new_hash[1:] = hashes[1:] != hashes[:-1]
        new_around[1:] = new_hash[1:] | (around[1:] != around[:-1])
        same[1:] = ~new_around[1:] & (order[:, 1:] == order[:, :-1]).all(0)
        same[0] = False
        if end is not None and end[0] == hashes[0]:
            new_hash[0] = False
            new_around[0] = end[1] != around[0]
            same[0] = not new_around[0] and end[2] == tuple(order[:, 0])
        # rows that repeat the first row of their surroundings are that same document again
        run = np.maximum.accumulate(np.where(~same, np.arange(len(batch)), -1))
        lead = np.where(run >= 0, new_around[np.maximum(run, 0)], end is not None and end[3])
        first = lead.astype(bool)
        # groups with a second surroundings
        group = np.cumsum(new_hash)
        several = np.bincount(group, new_around & ~new_hash, minlength=group[-1] + 1) > 0
        open_ = kept is not None and group[0] == 0
        out = [(column["pack"][~first], column["place"][~first], np.full((~first).sum(), -1))]
        extend = first & several[group]
        if group[0] == 0 and kept is None and end is not None:
            extend |= first & (group == 0)  # the group had its second surroundings before
        out.append((column["pack"][extend], column["place"][extend], np.full(extend.sum(), -2)))
        if open_ and several[0]:
            out.append(tuple(kept[0].T) + (np.full(len(kept[0]), -2),))
        # what stays open
        last = group == group[-1]
        if several[group[-1]] or (group[-1] == 0 and kept is None and end is not None):
            kept = None
        else:
            rows = np.stack([column["pack"][last & first], column["place"][last & first]], 1)
            kept = (np.concatenate([kept[0], rows]) if open_ and group[-1] == 0 else rows,)
        end = (hashes[-1], around[-1], tuple(order[:, -1]), bool(first[-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([o[i] for o in out]).astype(t)) for i, t in enumerate((np.int64, np.int32, np.int32))],
            schema=_NOTES)


_SEEDS = pa.schema([*[f for f in _FOUND if f.name != "around"], ("left", pa.int32()), ("right", pa.int32()),
                    ("words", pa.binary())])


def _send(key: str, text: str):
    def run(pack: int, table: pa.Table, notes: pa.Array) -> Iterator[pa.RecordBatch]:
        places = notes.field("place").to_numpy(zero_copy_only=False)
        at = np.sort(places[notes.field("last").to_numpy(zero_copy_only=False) == -2]).astype(np.int64)
        if not len(at):
            return
        words = _Words(table, key, text)
        words.seeds()
        before, after, left, right = words.around(at)
        doc = words.doc[at]
        lead = words.lead[doc]
        both = np.ascontiguousarray(np.concatenate([before, after], 1))
        yield pa.RecordBatch.from_arrays([
            pa.array(words.mixed[at].view(np.int64)), pa.array(~words.null[lead]), pa.array(words.keys[lead]),
            pa.array(words.marks[doc]), pa.array((at - words.starts[doc]).astype(np.int32)),
            pa.array(np.full(len(at), pack)), pa.array(at.astype(np.int32)), pa.array(left.astype(np.int32)),
            pa.array(right.astype(np.int32)), pa.array([r.tobytes() for r in both], pa.binary()),
        ], schema=_SEEDS)

    return run


#: what ``last`` says about a seed of a group too large to be extended at once
_HOT = -3
_RANGES = pa.schema([*_NOTES, *[f for f in _SEEDS if f.name not in ("pack", "place")]])
_WINDOWS = pa.schema([*[f for f in _FOUND if f.name != "around"], ("offset", pa.int32()), ("window", pa.int64())])


def _around(table: pa.Table | pa.RecordBatch) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Columns of seeds, and running hashes of the words before and after them."""
    reach = LENGTH - SEED
    column = {n: table[n].to_numpy(zero_copy_only=False) for n in table.schema.names if n != "words"}
    words = np.frombuffer(b"".join(table["words"].to_pylist()), np.uint64).reshape(len(table), 2 * reach)
    before = _fold(words[:, :reach], column["hash"].astype(np.int64).view(np.uint64))
    return column, before, _fold(words[:, reach:], np.zeros(len(table), np.uint64))


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges (pack, place, last) of words that windows around the seeds repeat from earlier on.

    The rows of a group too large to be extended at once pass through.
    """
    reach = LENGTH - SEED
    for table, hot in pk.grouped(batches, "hash", EXTEND_ROWS):
        if hot:
            last = pa.array(np.full(len(table), _HOT, np.int32))
            yield from table.append_column("last", last).select(_RANGES.names).combine_chunks().to_batches()
            continue
        column, before, after = _around(table)
        order = np.lexsort([column[n] for n in reversed(_ORDER)])
        rank = np.stack([column[n].astype(np.int64) for n in _ORDER])
        out = []
        for o in range(reach + 1):
            rows = order[(column["left"][order] >= o) & (column["right"][order] >= reach - o)]
            window = (before[rows, o] ^ (after[rows, reach - o] * np.uint64(0xBF58476D1CE4E5B9))) * _ODD
            _, first, back = np.unique(window, return_index=True, return_inverse=True)
            late = rows[(rank[:, rows] != rank[:, rows[first[back]]]).any(0)]
            out.append((column["pack"][late], column["place"][late] - o, column["place"][late] - o + LENGTH))
        found = [np.concatenate([x[i] for x in out]).astype(t) for i, t in enumerate((np.int64, np.int32, np.int32))]
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, found), *[pa.nulls(len(found[0]), f.type) for f in list(_RANGES)[3:]]], schema=_RANGES)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window over a seed, with a hash of its words."""
    reach = LENGTH - SEED
    for batch in batches:
        if not len(batch):
            continue
        column, before, after = _around(batch)
        for o in range(reach + 1):
            rows = np.flatnonzero((column["left"] >= o) & (column["right"] >= reach - o))
            window = (before[rows, o] ^ (after[rows, reach - o] * np.uint64(0xBF58476D1CE4E5B9))) * _ODD
            columns = [pa.array(column[f.name][rows].astype(f.type.to_pandas_dtype())) for f in list(_WINDOWS)[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.full(len(rows), o, np.int32)), pa.array(window.view(np.int64))], schema=_WINDOWS)


def repeated_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pack table of ``docs`` and notes on which of its words repeat earlier ones.

    ``key`` must be an integer column.
    """
    packs = pk.packed(docs, text)
    found = pk.mapped(packs, _find(key, text), _spark(_FOUND))
    by_seed = found.repartition("hash").sortWithinPartitions("hash", "around", *_ORDER)
    notes = pk.staged(by_seed.mapInArrow(_settle, _spark(_NOTES)), "settled")
    seeds = pk.joined(packs, notes.filter("last = -2"), _send(key, text), _spark(_SEEDS))
    ranges = pk.staged(seeds.repartition("hash").sortWithinPartitions("hash").mapInArrow(_extend, _spark(_RANGES)), "ranges")
    windows = ranges.filter(f"last = {_HOT}").mapInArrow(_windows, _spark(_WINDOWS))
    same, order = ["hash", "offset", "window"], F.struct(*_ORDER)
    firsts = windows.groupBy(*same).agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    late = windows.join(firsts, same).filter(order != F.col("first"))
    known = notes.filter("last = -1").unionByName(ranges.filter(f"last <> {_HOT}").select("pack", "place", "last"))
    return packs, known.unionByName(pk.spans(late, LENGTH))


def _masks(table: pa.Table, notes: pa.Array, key: str, text: str) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words of every row of a pack and which of them to remove."""
    words = _Words(table, key, text)
    place = notes.field("place").to_numpy(zero_copy_only=False).astype(np.int64)
    last = notes.field("last").to_numpy(zero_copy_only=False).astype(np.int64)
    settled, reach = last == -1, LENGTH - SEED
    start, stop = place.copy(), last.copy()
    doc = words.doc[place[settled]]
    start[settled] = np.maximum(place[settled] - reach, words.starts[doc])
    stop[settled] = np.minimum(place[settled] + LENGTH, words.starts[doc + 1])
    mask = pk.merged(start, stop, len(words.hashes))
    for i, first in enumerate(words.first):
        n, lead = len(words.words[i]), words.lead[first]
        if (words.null[i], words.keys[i]) == (words.null[lead], words.keys[lead]):
            yield words.words[i], mask[words.starts[first]:words.starts[first + 1]]
        else:  # a later document with the whole text of an earlier one
            yield words.words[i], np.full(n, n >= LENGTH)


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the words of repeats, same columns; kept words are joined by one space.

    A word goes if a window of ``LENGTH`` words over it also starts earlier: in
    a document with a smaller key, or earlier in its own.  Null keys come
    first; different texts with one key go by a hash; rows that repeat key and
    text are one document and get one result.  Null and short texts have no
    windows; a text that loses nothing is not touched.  An empty table gives no
    rows.
    """
    packs, notes = repeated_words(docs, key, text)

    def run(_: int, table: pa.Table, found: pa.Array) -> Iterator[pa.RecordBatch]:
        old = table[text].to_pylist()
        new = [t if not gone.any() else b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode("utf-8", "replace")
               for t, (words, gone) in zip(old, _masks(table, found, key, text), strict=True)]
        place = table.schema.get_field_index(text)
        yield from table.set_column(place, table.schema.field(place), pa.array(new, table.schema.field(place).type)).to_batches()

    return pk.joined(packs, notes, run, docs.schema)


_DIGEST = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words, removed words and a checksum of the kept ones for every row; see :func:`deduplicated`."""
    packs, notes = repeated_words(docs.select(F.col(key).cast("long").alias(key), text), key, text)

    def run(_: int, table: pa.Table, found: pa.Array) -> Iterator[pa.RecordBatch]:
        rows = [(len(words), int(gone.sum()), hashlib.sha256(
            b" ".join(w for w, g in zip(words, gone, strict=True) if not g)).hexdigest())
            for words, gone in _masks(table, found, key, text)]
        yield pa.RecordBatch.from_arrays(
            [table[key].combine_chunks(), *[pa.array([r[i] for r in rows], f.type) for i, f in enumerate(list(_DIGEST)[1:])]],
            schema=_DIGEST)

    return pk.joined(packs, notes, run, _spark(_DIGEST)).withColumnRenamed("key", key)
