"""Suffix-array de-duplication with hash-compared suffix sort.

A window of ``LENGTH`` bytes (or as many as given) is repeated if a neighbour in the suffix array
shares that many bytes.  Sorting every suffix of a corpus is not needed for
that: each window contains an anchor, a winnowed run of ``ANCHOR`` bytes that
depends on the window's content alone, so equal windows meet at equal anchors.
Suffixes are sorted from the ends of anchors on, and prefixes, backwards, from
their beginnings.

The sort is a mergesort.  Two suffixes are compared through their longest
common extension, found by binary search over prefix polynomial hashes, so a
comparison takes a logarithmic number of steps; the last word and the byte
that differs are read from the texts.  Every repeat that comes out of the sort
is verified byte by byte.  Anchors that share all their surroundings are
settled before the sort, by two 64-bit hashes: that of the anchor and that of
the surroundings.

An anchor with more different surroundings than one task sorts is not sorted:
its windows go out one by one, with 128 bits of a hash of their bytes as key,
and are counted where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm import packs as pk
from postsieve.llm.base import releasing
from postsieve.llm.substring import _spark

#: bytes of a repeat and of an anchor, unless others are given
LENGTH, ANCHOR = 400, 256
#: anchors that a task sorts at once, whole groups
SORT_ROWS = 20_000
#: odd, so its powers can be undone modulo 2^64
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass(frozen=True)
class Run:
    """What counts as a repeat: its bytes, those of its anchor, and how far a window reaches beyond one."""

    length: int = LENGTH
    anchor: int = ANCHOR

    @property
    def reach(self) -> int:
        return self.length - self.anchor


_FOUND = pa.schema([("hash", pa.int64()), ("around", pa.int64()), ("pack", pa.int64()), ("place", pa.int32())])
_NOTES = pa.schema([("pack", pa.int64()), ("place", pa.int32()), ("last", pa.int32())])
_SENT = pa.schema([("hash", pa.int64()), ("check", pa.int64()), ("pack", pa.int64()), ("place", pa.int32()),
                   ("wanted", pa.bool_()), ("left", pa.binary()), ("right", pa.binary())])
#: what ``last`` says about an anchor: all its windows repeat; to be sorted; both
_DONE, _SORT, _BOTH = -1, -2, -3
#: what ``last`` says about an anchor of a group too large to be sorted
_HOT = -4
_SORTED = pa.schema([*_NOTES, *[f for f in _SENT if f.name not in ("pack", "place")]])
_WINDOWS = pa.schema([("key", pa.binary()), ("pack", pa.int64()), ("place", pa.int32()), ("offset", pa.int32()),
                      ("wanted", pa.bool_())])


class _Bytes:
    """The bytes of a pack's distinct texts and the anchors in them."""

    def __init__(self, table: pa.Table, text: str, run: Run):
        raw, places = pk.contents(table, text)
        self.run = run
        self.first = pk.first_copies(raw, places)
        self.copies = np.bincount(self.first, minlength=len(self.first))
        self.raw, self.places = raw, places
        self.whole = raw.tobytes()

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the text at every place; copies of a text count as empty."""
        sizes = np.diff(self.places)
        begin, end = np.repeat(self.places[:-1], sizes), np.repeat(self.places[1:], sizes)
        again = np.repeat(self.first != np.arange(len(self.first)), sizes)
        end[again] = begin[again]
        return begin, end

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the anchors, and begin and end of their texts."""
        n, length, anchor = len(self.raw), self.run.length, self.run.anchor
        if n < length:
            return (np.zeros(0, np.int64),) * 3
        begin, end = self.ends()
        power = np.cumprod(np.full(n, _BASE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.raw + np.uint64(1)) * power)])
        mixed = (sums[anchor:] - sums[:-anchor]) * np.cumprod(np.full(n - anchor + 1, _UNDO))
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        here = np.arange(len(mixed))
        mixed[here + anchor > end[:len(mixed)]] = np.iinfo(np.uint64).max
        found = pk.winnowed(mixed, self.run.reach + 1, here + length <= end[:len(mixed)])
        return found, begin[found], end[found]

    def around(self, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far windows reach on either side of anchors."""
        return np.maximum(at - self.run.reach, begin), np.minimum(at + self.run.length, end)


def _find(text: str, span: Run):
    import xxhash

    def run(pack: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = _Bytes(table, text, span)
        at, begin, end = texts.anchors()
        low, high = texts.around(at, begin, end)
        whole, digest = texts.whole, xxhash.xxh3_64_intdigest
        hashes = [digest(whole[a:a + span.anchor]) for a in at.tolist()]
        around = [digest(whole[a:b], p - a) for p, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(np.array(around, np.uint64).view(np.int64)),
            pa.array(np.full(len(at), pack)), pa.array(at.astype(np.int32))], schema=_FOUND)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Notes about anchors sorted by hash and surroundings.

    Anchors that share all their surroundings are done.  Where a group has
    several surroundings, one anchor of each goes on to be sorted.  Two anchors
    are held from batch to batch: the last one, whose equals may follow, and
    the first of a group that has had one surroundings only.
    """
    names = ("hash", "around", "pack", "place")
    held, came_before, kinds_before, waiting = None, False, 0, None
    for batch in _ended(batches):
        rows = [batch[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in names] if batch is not None else [
            np.zeros(0, np.int64)] * 4
        if held is not None:
            rows = [np.concatenate([[h], r]) for h, r in zip(held, rows, strict=True)]
        hashes, around, pack, place = rows
        n = len(hashes)
        if not n:
            continue
        same_hash, came = np.zeros(n, bool), np.zeros(n, bool)
        same_hash[1:] = hashes[1:] == hashes[:-1]
        came[1:] = same_hash[1:] & (around[1:] == around[:-1])
        follows = np.append(came[1:], False)
        group = np.cumsum(~same_hash) - 1
        kinds = np.bincount(group, ~came)
        if held is not None:
            kinds[0] += kinds_before - 1
            came[0] = came_before
        many, sort = came | follows, ~came & (kinds[group] > 1)
        out = np.flatnonzero((sort | many)[:n if batch is None else n - 1])
        last = np.where(sort, np.where(many, _BOTH, _SORT), _DONE)[out]
        pack_out, place_out = pack[out], place[out]
        if waiting is not None and (kinds[0] > 1 or group[-1]):
            if kinds[0] > 1:
                pack_out, place_out = np.append(pack_out, waiting[0]), np.append(place_out, waiting[1])
                last = np.append(last, _BOTH)
            waiting = None
        yield pa.RecordBatch.from_arrays([
            pa.array(pack_out), pa.array(place_out.astype(np.int32)), pa.array(last.astype(np.int32))], schema=_NOTES)
        begin = int(np.searchsorted(group, group[-1]))
        if kinds[-1] == 1 and waiting is None and begin < n - 1 and not came[begin]:
            waiting = pack[begin], place[begin]
        held, came_before, kinds_before = [r[-1] for r in rows], bool(came[-1]), kinds[-1]


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches that have rows, and a last ``None``."""
    yield from (b for b in batches if len(b))
    yield None


def _send(text: str, span: Run):
    import xxhash

    def run(pack: int, table: pa.Table, notes: pa.Array) -> Iterator[pa.RecordBatch]:
        last = notes.field("last").to_numpy(zero_copy_only=False)
        places = notes.field("place").to_numpy(zero_copy_only=False)
        chosen = last != _DONE
        if not chosen.any():
            return
        at, wanted = places[chosen].astype(np.int64), last[chosen] == _SORT
        texts = _Bytes(table, text, span)
        begin, end = texts.ends()
        low, high = texts.around(at, begin[at], end[at])
        whole, anchor = texts.whole, span.anchor
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array([xxhash.xxh3_64_intdigest(whole[a:a + anchor]) for a in at.tolist()], np.uint64).view(np.int64)),
            pa.array(np.array([xxhash.xxh64_intdigest(whole[a:a + anchor]) for a in at.tolist()], np.uint64).view(np.int64)),
            pa.array(np.full(len(at), pack)), pa.array(at.astype(np.int32)), pa.array(wanted),
            pa.array([whole[a:b] for a, b in zip(low.tolist(), at.tolist(), strict=True)], pa.binary()),
            pa.array([whole[a + anchor:b] for a, b in zip(at.tolist(), high.tolist(), strict=True)], pa.binary()),
        ], schema=_SENT)

    return run


class Suffixes:
    """Strings of at most ``reach`` bytes in groups, compared by hashed extensions."""

    def __init__(self, strings: list[bytes], group: np.ndarray, reach: int = LENGTH - ANCHOR):
        n, words = len(strings), -(-reach // 8)
        self.group, self.size = group, np.fromiter(map(len, strings), np.int64, n)
        self.bytes = np.frombuffer(b"".join(s.ljust(words * 8, b"\0") for s in strings), np.uint8).reshape(n, words * 8)
        self.words = self.bytes.view("<u8")
        self.prefix = np.zeros((n, words + 1), np.uint64)  # polynomial hash of the first words
        for i in range(words):
            self.prefix[:, i + 1] = (self.prefix[:, i] + self.words[:, i] + np.uint64(1)) * _BASE

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of the strings ``a`` and ``b``."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.words.shape[1])
        while (low < high).any():
            half = (low + high + 1) // 2
            equal = self.prefix[a, half] == self.prefix[b, half]
            low, high = np.where(equal, half, low), np.where(equal, high, half - 1)
        word = np.minimum(low, self.words.shape[1] - 1)
        apart = self.words[a, word] ^ self.words[b, word]
        equal = np.bitwise_count((apart & (~apart + np.uint64(1))) - np.uint64(1)) // 8
        found = np.where(low < self.words.shape[1], 8 * low + np.where(apart == 0, 8, equal), 8 * low)
        return np.minimum(found, np.minimum(self.size[a], self.size[b]))

    def below(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether ``a`` sorts before ``b``: group, then first byte that differs, then length."""
        at = self.common(a, b)
        most = self.bytes.shape[1] - 1
        left = np.where(at < self.size[a], self.bytes[a, np.minimum(at, most)].astype(np.int64), -1)
        right = np.where(at < self.size[b], self.bytes[b, np.minimum(at, most)].astype(np.int64), -1)
        same = self.group[a] == self.group[b]
        return np.where(same, left < right, self.group[a] < self.group[b])

    def order(self) -> np.ndarray:
        """Mergesort: all runs of one width are merged at once, places found by binary search."""
        n = len(self.size)
        order, width = np.arange(n), 1
        while width < n:
            spot = np.arange(n)
            start = spot // (2 * width) * (2 * width)
            middle = np.minimum(start + width, n)
            stop = np.minimum(start + 2 * width, n)
            left = spot < middle
            other = np.where(left, middle, start)  # the run to search
            low, high = other.copy(), np.where(left, stop, middle)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                half = (low[open_] + high[open_]) // 2
                mine, theirs = order[open_], order[half]
                # elements of the left run come before equal ones of the right
                up = np.where(left[open_], self.below(theirs, mine), ~self.below(mine, theirs))
                low[open_[up]] = half[up] + 1
                high[open_[~up]] = half[~up]
            own = np.where(left, spot - start, spot - middle)
            merged = np.empty(n, np.int64)
            merged[start + own + (low - other)] = order
            order, width = merged, 2 * width
        return order


def repeats(
    left: list[bytes], right: list[bytes], group: np.ndarray, wanted: np.ndarray, reach: int = LENGTH - ANCHOR
) -> tuple[np.ndarray, ...]:
    """Rows and how far before and after their anchor a repeat reaches ``reach`` bytes beyond it, both sides together.

    ``left`` holds the bytes before each anchor, ``right`` those after it.
    Works up the intervals of the suffix array: at common length ``r`` rows
    form runs; in each run that grew, the neighbour by sorted prefixes shares
    the most bytes to the left.
    """
    after, before = Suffixes(right, group, reach), Suffixes([s[::-1] for s in left], group, reach)
    array, rank = after.order(), np.empty(len(group), np.int64)
    rank[before.order()] = np.arange(len(group))
    shared = np.full(len(group), -1)
    if len(group) > 1:
        shared[1:] = np.where(group[array[1:]] == group[array[:-1]], after.common(array[1:], array[:-1]), -1)
    rows, low, high = [], [], []
    for r in np.unique(shared[shared >= 0])[::-1]:
        run = np.cumsum(shared < r)
        grew = np.zeros(run[-1] + 1, bool)
        grew[run[shared == r]] = True
        inside = np.flatnonzero(grew[run])
        by_left = inside[np.lexsort((rank[array[inside]], run[inside]))]
        members, of = array[by_left], run[by_left]
        near = of[1:] == of[:-1]
        a, b = members[1:][near], members[:-1][near]
        both = before.common(a, b)
        enough = both + r >= reach
        a, b, both = a[enough], b[enough], both[enough]
        # verification: the hashes said so, the bytes have to
        sure = _equal(before.bytes, a, b, both) & _equal(after.bytes, a, b, np.full(len(a), r))
        for rows_now in (a[sure], b[sure]):
            keep = wanted[rows_now]
            rows.append(rows_now[keep])
            low.append(both[sure][keep])
            high.append(np.full(keep.sum(), r))
    empty = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or empty) for x in (rows, low, high))


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    return ((data[a] == data[b]) | (np.arange(data.shape[1]) >= size[:, None])).all(1)


def _sort(span: Run):
    """Ranges of repeats in groups of equal anchors; the rows of a group too large to be sorted pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, hot in pk.grouped(batches, "hash", SORT_ROWS):
            if hot:
                last = pa.array(np.full(len(table), _HOT, np.int32))
                yield from table.append_column("last", last).select(_SORTED.names).combine_chunks().to_batches()
                continue
            hashes, check = table["hash"].to_numpy(), table["check"].to_numpy()
            _, group = np.unique(np.stack([hashes, check], 1), axis=0, return_inverse=True)
            rows, low, high = repeats(table["left"].to_pylist(), table["right"].to_pylist(), group.ravel(),
                                      table["wanted"].to_numpy(zero_copy_only=False), span.reach)
            place = table["place"].to_numpy().astype(np.int64)[rows]
            yield pa.RecordBatch.from_arrays([
                pa.array(table["pack"].to_numpy()[rows]), pa.array((place - low).astype(np.int32)),
                pa.array((place + span.anchor + high).astype(np.int32)),
                *[pa.nulls(len(rows), f.type) for f in list(_SORTED)[3:]]], schema=_SORTED)

    return releasing(run)


def _windows(reach: int):
    """Every window over an anchor, keyed by 128 bits of a hash of its bytes."""
    import xxhash

    digest = xxhash.xxh3_128_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 500):
                batch, keys, row, offset = whole.slice(start, 500), [], [], []
                columns = [batch[n].to_pylist() for n in ("hash", "check", "left", "right")]
                for i, (a, b, left, right) in enumerate(zip(*columns, strict=True)):
                    anchor = np.array([a, b]).tobytes()
                    for o in range(max(0, reach - len(right)), min(reach, len(left)) + 1):
                        keys.append(digest(anchor + o.to_bytes(4, "little") + left[len(left) - o:] + right[:reach - o]))
                        row.append(i)
                        offset.append(o)
                at = np.array(row, np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.binary()), pa.array(batch["pack"].to_numpy()[at]), pa.array(batch["place"].to_numpy()[at]),
                    pa.array(np.array(offset, np.int32)), pa.array(batch["wanted"].to_numpy(zero_copy_only=False)[at].astype(bool)),
                ], schema=_WINDOWS)

    return releasing(run)


def repeated_bytes(docs: DataFrame, text: str = "text", span: Run = Run()) -> tuple[DataFrame, DataFrame]:
    """Pack table of ``docs`` and notes on which of its bytes are in repeats."""
    packs = pk.packed(docs, text)
    found = pk.mapped(packs, _find(text, span), _spark(_FOUND))
    by_anchor = found.repartition("hash").sortWithinPartitions("hash", "around")
    notes = pk.staged(by_anchor.mapInArrow(releasing(_settle), _spark(_NOTES)), "settled")
    sent = pk.joined(packs, notes.filter(f"last <> {_DONE}"), _send(text, span), _spark(_SENT))
    ranges = pk.staged(
        sent.repartition("hash").sortWithinPartitions("hash").mapInArrow(_sort(span), _spark(_SORTED)), "ranges")
    windows = ranges.filter(f"last = {_HOT}").mapInArrow(_windows(span.reach), _spark(_WINDOWS))
    again = windows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    hot = pk.spans(windows.filter("wanted").join(again, "key"), span.length)
    known = notes.filter(f"last <> {_SORT}").withColumn("last", F.lit(_DONE))
    return packs, known.unionByName(ranges.filter(f"last <> {_HOT}").select("pack", "place", "last")).unionByName(hot)


def _masks(table: pa.Table, notes: pa.Array, text: str, span: Run) -> Iterator[tuple[bytes, np.ndarray]]:
    """Bytes of every row of a pack and which of them to remove."""
    texts = _Bytes(table, text, span)
    begin, end = texts.ends()
    start = notes.field("place").to_numpy(zero_copy_only=False).astype(np.int64)
    stop = notes.field("last").to_numpy(zero_copy_only=False).astype(np.int64)
    done = stop == _DONE
    at = start[done]
    start, stop = start.copy(), stop.copy()
    start[done], stop[done] = texts.around(at, begin[at], end[at])
    mask = pk.merged(start, stop, len(texts.raw))
    for i, first in enumerate(texts.first):
        a, b = texts.places[first], texts.places[first + 1]
        gone = mask[a:b] if texts.copies[first] == 1 else np.full(b - a, b - a >= span.length)
        yield texts.whole[a:b], gone


def _kept(content: bytes, gone: np.ndarray) -> bytes:
    return np.frombuffer(content, np.uint8)[~gone].tobytes() if gone.any() else content


def deduplicated(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` without the bytes of repeats, same columns.

    A byte goes if a run of ``length`` bytes over it starts anywhere else too,
    in another document or the same one; all occurrences go.  ``anchor`` bytes
    of a run, fewer than ``length``, are what equal runs meet by.  Matches never
    cross documents.  A repeat may begin or end inside a character: what is
    left of one becomes U+FFFD.  Null stays null, texts below the threshold
    stay as they are, rows that repeat a text lose it whole if it is long
    enough.  An empty table gives no rows.
    """
    span = Run(length, anchor)
    packs, notes = repeated_bytes(docs, text, span)

    def run(_: int, table: pa.Table, found: pa.Array) -> Iterator[pa.RecordBatch]:
        new = [old if not gone.any() else _kept(content, gone).decode("utf-8", "replace")
               for old, (content, gone) in zip(table[text].to_pylist(), _masks(table, found, text, span), strict=True)]
        place = table.schema.get_field_index(text)
        yield from table.set_column(place, table.schema.field(place), pa.array(new, table.schema.field(place).type)).to_batches()

    return pk.joined(packs, notes, run, docs.schema)


_DIGEST = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes, removed bytes and runs, and a checksum of the rest of every row; see :func:`deduplicated`."""
    span = Run()
    packs, notes = repeated_bytes(docs.select(F.col(key).cast("long").alias(key), text), text, span)

    def run(_: int, table: pa.Table, found: pa.Array) -> Iterator[pa.RecordBatch]:
        rows = []
        for content, gone in _masks(table, found, text, span):
            runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            rows.append((len(content), int(gone.sum()), runs, hashlib.sha256(_kept(content, gone)).hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [table[key].combine_chunks(), *[pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_DIGEST)]],
            schema=pa.schema([pa.field("key", pa.int64()), *_DIGEST]))

    schema = "`key` long, " + _spark(_DIGEST)
    return pk.joined(packs, notes, run, schema).withColumnRenamed("key", key)
