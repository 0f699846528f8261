"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postsieve.llm import resampling
from postsieve.llm.resampling import checksums, drawn_documents, resample
from tests.llm.conftest import make_rows

TARGET = ["ab cd ab", None, "", "Ab-cd 12 é漢 é漢 x", "ab " * 300]


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def features(text, max_run):
    found = words(text)
    return [" ".join(found[i:i + n]) for n in range(1, max_run + 1) for i in range(len(found) - n + 1)]


def expected_rows(rows, target, max_run, buckets, min_words, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, features(text, max_run)))
    for text in target:
        t.update(map(bucket, features(text, max_run)))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for key, text in rows:
        found = features(text, max_run)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([key, len(found), weight, score, None, len(words(text)) >= min_words])
    fit = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(fit[: percent * len(fit) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("max_run, buckets, min_words, percent", [(1, 10_000, 20, 10), (3, 97, 1, 50), (2, 1, 0, 100)])
def test_resample(spark, docs, monkeypatch, max_run, buckets, min_words, percent):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    expected = expected_rows([(r[0], r[1]) for r in make_rows()], TARGET, max_run, buckets, min_words, percent)
    for size in (1 << 20, 11) if max_run == 3 else (1 << 20,):
        monkeypatch.setattr(resampling, "SLICE_BYTES", size)
        monkeypatch.setattr(resampling, "SLICE_FEATURES", size)
        got = resample(docs, target, percent / 100, min_words, max_run=max_run, buckets=buckets)
        assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert any(r[4] for r in expected)


def test_empty_tables(spark, docs, empty):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert resample(empty, target).count() == 0
    assert resample(docs, target.limit(0)).count() == len(make_rows())
    ranks = resample(docs, target, 0.5, 1)
    drawn = drawn_documents(docs, ranks)
    assert drawn.columns == docs.columns and drawn.count() >= ranks.filter("rank is not null").count() > 0
    assert resample(docs.withColumn("text", F.lit(None).cast("string")), target, 0.5, 1).filter("rank > 0").count() == 0


def test_checksums():
    rows = [b"", b"a", b"ab", b"ba", bytes(range(256)), b"x" * 64, b"x" * 65, "漢字".encode(), b"\xff" * 1000]
    assert checksums(rows).tolist() == [zlib.crc32(r) for r in rows]
    assert checksums([]).tolist() == []
