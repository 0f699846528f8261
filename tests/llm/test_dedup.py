"""Near-duplicates, repeated words and repeated bytes against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from postsieve.llm import simhash, substring, suffix
from tests.llm.conftest import make_rows

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def test_fingerprints_and_groups(docs, empty):
    def slow(text):
        words = WORDS.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        if not words:
            return 0
        parts = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = [(r[0], slow(r[1])) for r in make_rows()]
    values = sorted({f for _, f in rows})
    root = {f: f for f in values}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    smallest = {}
    for key, f in rows:
        if key is not None:
            smallest[find(f)] = min(smallest.get(find(f), key), key)
    expected = Counter((key, f"{f:016x}", smallest.get(find(f))) for key, f in rows)
    found = simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits(simhash.F.col("fp")).alias("f"), "component_id")
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert simhash.near_duplicates(empty).count() == 0

    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    rows_kept = kept.collect()
    groups = {find(f) for _, f in rows}
    assert len(rows_kept) == len(groups) == len({find(slow(r["text"])) for r in rows_kept})
    for r in rows_kept:
        assert r["doc_id"] == smallest.get(find(slow(r["text"])))
    assert simhash.one_per_group(empty).count() == 0


def test_close_pairs_in_dense_cells():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 1 << 63, 40, np.uint64)[:, None] ^ (
        np.uint64(1) << rng.integers(0, 64, (40, 30), np.uint64)))
    for side in (np.zeros(len(values), int), (np.arange(len(values)) % 2)):
        left, right = simhash.close_pairs(values, side, 4)
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
        near &= np.triu(np.ones_like(near), 1).astype(bool)
        if side.any():
            near &= side[:, None] != side[None, :]
        assert {tuple(sorted(p)) for p in zip(left, right, strict=True)} == {tuple(p) for p in np.argwhere(near)}
        links = simhash._spanning(values.view(np.int64), left, right)
        assert len(links[0]) <= len(values)


def test_keys_grow_with_the_corpus(spark, monkeypatch):
    """Links are the same for every number of bands; the pairs of random fingerprints stay few as rows double."""
    assert [simhash.key_bands(n, 4) for n in (1, 10**5, 10**7, 5 * 10**10)] == [5, 5, 6, 7]
    pairs = [n * n / 2 ** (64 * (b - 4) / b) for n in (10**6, 10**8, 10**10) for b in [simhash.key_bands(n, 4)]]
    assert pairs[1] / pairs[0] < 1000 and pairs[2] / pairs[1] < 1000  # 10,000 with keys of one length
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 63, 300, np.uint64)
    for _ in range(2):  # chains of flipped bits, 1 to 5 of them
        flips = [np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, k, False).astype(np.uint64)) for k in rng.integers(1, 6, 300)]
        values = np.concatenate([values, values[:300] ^ np.array(flips, np.uint64)])
    values = np.unique(values)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    label = np.arange(len(values))
    while True:
        low = np.where(near, label[None, :], len(values)).min(1)
        if (low == label).all():
            break
        label = low
    expected = {int(v): int(np.sort(values[label == label[i]].view(np.int64))[0]) for i, v in enumerate(values.view(np.int64))}
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    for bands in (5, 6, 8):
        monkeypatch.setattr(simhash, "key_bands", lambda n, bits, bands=bands: bands)
        assert {r["fp"]: r["root"] for r in simhash.fingerprint_groups(df).collect()} == expected


def brute_words(rows):
    order, first = [], {}
    for key, text, *_ in rows:
        raw = (text or "").encode()
        order.append(((key is not None, key or 0, xxhash.xxh64_intdigest(raw) - (1 << 64) * (
            xxhash.xxh64_intdigest(raw) >> 63)), raw.split()))
    for at, words in order:
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            first[window] = min(first.get(window, (at, i)), (at, i))
    out = []
    for at, words in order:
        gone = set()
        for i in range(len(words) - 19):
            if first[tuple(words[i:i + 20])] != (at, i):
                gone.update(range(i, i + 20))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_words(docs, empty):
    expected = Counter((r[0], *x) for r, x in zip(make_rows(), brute_words(make_rows()), strict=True))
    assert Counter(tuple(r) for r in substring.digests(docs).collect()) == expected
    assert substring.digests(empty).count() == 0
    kept = substring.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(len((r["text"] or "").encode().split()) for r in kept.collect()) == sorted(n - g for _, n, g, _ in expected.elements())
    assert substring.deduplicated(empty).count() == 0


def brute_bytes(rows, length=400):
    raws = [(r[1] or "").encode() for r in rows]
    seen = Counter(raw[i:i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_bytes(docs, empty):
    rows = make_rows()
    expected = Counter((r[0], *x) for r, x in zip(rows, brute_bytes(rows), strict=True))
    assert Counter(tuple(r) for r in suffix.digests(docs).collect()) == expected
    assert suffix.digests(empty).count() == 0
    kept = suffix.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    untouched = Counter(r[1] for r, x in zip(rows, brute_bytes(rows), strict=True) if not x[1])
    assert not untouched - Counter(r["text"] for r in kept.collect())
    assert suffix.deduplicated(empty).count() == 0


def test_repeats_of_other_lengths(docs):
    rows = make_rows()
    for length, anchor in ((200, 112), (30, 5)):
        found = brute_bytes(rows, length)
        kept = suffix.deduplicated(docs, length=length, anchor=anchor).collect()
        sizes = Counter((r["doc_id"], len((r["text"] or "").encode("utf-8", "replace"))) for r in kept if (r["text"] or "").isascii())
        expected = Counter((r[0], n - gone) for r, (n, gone, _, _) in zip(rows, found, strict=True) if (r[1] or "").isascii())
        assert not expected - sizes and sum(expected.values()) > 5


def test_suffix_sort_is_lexicographic():
    rng = np.random.default_rng(2)
    strings = [bytes(rng.integers(97, 99, rng.integers(0, suffix.Run().reach + 1)).astype(np.uint8)) for _ in range(300)]
    strings += strings[:40] + [b"", b"\0", b"\0\0", b"a" * suffix.Run().reach]
    group = rng.integers(0, 5, len(strings))
    tree = suffix.Suffixes(strings, group)
    assert [(group[i], strings[i]) for i in tree.order()] == sorted(zip(group, strings, strict=True))
    a, b = rng.integers(0, len(strings), (2, 500))
    common = [next((i for i, (x, y) in enumerate(zip(strings[p], strings[q], strict=False)) if x != y),
                   min(len(strings[p]), len(strings[q]))) for p, q in zip(a, b, strict=True)]
    assert tree.common(a, b).tolist() == common


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_notes_do_not_depend_on_batches(size):
    """Groups may break off anywhere between two batches."""
    rng = np.random.default_rng(size)
    n = 400
    hashes, around = np.sort(rng.integers(0, 60, n)), rng.integers(0, 3, n)
    order = np.lexsort((around, hashes))
    hashes, around = hashes[order], around[order]
    place = np.arange(n)
    table = pa.table({"hash": pa.array(hashes), "around": pa.array(around), "pack": pa.array(place),
                      "place": pa.array(place.astype(np.int32))})
    got = defaultdict(set)
    for batch in suffix._settle(iter(table.to_batches(max_chunksize=size))):
        for row in batch.to_pylist():
            got[row["place"]].add(row["last"])
    both = Counter(zip(hashes, around, strict=True))
    kinds = Counter(h for h, _ in both)
    for h, a in both:
        rows = [i for i in range(n) if hashes[i] == h and around[i] == a]
        marks = set().union(*(got[i] for i in rows))
        many = len(rows) > 1
        assert all(got[i] & {suffix._DONE, suffix._BOTH} for i in rows) == many
        assert bool(marks & {suffix._SORT, suffix._BOTH}) == (kinds[h] > 1)
        assert sum(bool(got[i] & {suffix._SORT, suffix._BOTH}) for i in rows) <= 1

    null, doc, at = np.ones(n, bool), rng.integers(0, 4, n), rng.integers(0, 3, n).astype(np.int32)
    order = np.lexsort((at, doc, around, hashes))
    doc, at = doc[order], at[order]
    seeds = pa.table({**{c: table[c] for c in ("hash", "around", "pack", "place")}, "null_doc": pa.array(null),
                      "doc": pa.array(doc), "mark": pa.array(np.zeros(n, np.int64)), "at": pa.array(at)})
    got.clear()
    for batch in substring._settle(iter(seeds.to_batches(max_chunksize=size))):
        for row in batch.to_pylist():
            got[row["place"]].add(row["last"])
    least = {}
    for i in range(n):
        k = (hashes[i], around[i])
        least[k] = min(least.get(k, (doc[i], at[i])), (doc[i], at[i]))
    for i in range(n):
        first = (doc[i], at[i]) == least[hashes[i], around[i]]
        assert (-1 in got[i]) == (not first)
        assert (-2 in got[i]) == (first and kinds[hashes[i]] > 1)


@pytest.mark.parametrize("batch", [1, 7, 100])
def test_large_groups_are_not_held(batch):
    """A group above the bound comes in flagged pieces; all rows come once, in order."""
    from postsieve.llm import packs

    sizes = [3, 500, 1, 1, 60, 40, 300, 2, 5, 51]
    values = np.repeat(np.arange(len(sizes)), sizes)
    table = pa.table({"hash": values, "row": np.arange(len(values))})
    seen, flags = [], defaultdict(set)
    for piece, hot in packs.grouped(iter(table.to_batches(max_chunksize=batch)), "hash", 50):
        assert 0 < len(piece) <= 50 + batch
        seen += piece["row"].to_pylist()
        for h in set(piece["hash"].to_pylist()):
            flags[h].add(hot)
    assert seen == list(range(len(values)))
    assert all(len(f) == 1 for f in flags.values()) and flags[1] == {True} and flags[0] == {False}


def test_hot_passages(spark, monkeypatch):
    """A passage in very many different surroundings is spread out by window, with the same result."""
    import random

    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(1, 8))) for _ in range(300)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    notice, long_notice, phrase = text(52)[:300], text(100)[:470], text(14)
    ends = [text(12) for _ in range(3)]
    rows = []
    for i in range(60):
        middle = (notice, long_notice, phrase)[i % 3]
        rows.append((i - 5, f"{text(rnd.randint(0, 70))} {rnd.choice(ends)} {middle} {rnd.choice(ends)} {text(rnd.randint(0, 70))}".strip()))
    rows += rows[:4] + [(None, rows[7][1]), (99, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for module, bound in ((substring, "EXTEND_ROWS"), (suffix, "SORT_ROWS")):
        monkeypatch.setattr(module, bound, 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got_words = Counter(tuple(r) for r in substring.digests(df).collect())
        got_bytes = Counter(tuple(r) for r in suffix.digests(df).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got_words == Counter((r[0], *x) for r, x in zip(rows, brute_words(rows), strict=True))
    assert got_bytes == Counter((r[0], *x) for r, x in zip(rows, brute_bytes(rows), strict=True))
