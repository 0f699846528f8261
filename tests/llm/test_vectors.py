"""Hard negatives and near-duplicate vectors against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsieve.llm import cells, negatives
from postsieve.llm.cells import near_vectors, one_per_cell_group
from postsieve.llm.negatives import hard_negatives, packed_scores

SCHEMA = "vec_id long, embedding array<float>, label int"


def ints(vector, scale):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * x) for x in vector]


def odd_rows(rnd, dim):
    """Nulls, repeats, ties, other lengths, values beyond any range."""
    one = [rnd.gauss(0, 0.3) for _ in range(dim)]
    return [
        (300, one, 1), (300, one, 1), (300, [-x for x in one], 2), (None, one, 1), (None, one, 2), (301, one, 2),
        (302, one, 2), (400, None, 1), (500, [None, *one[1:]], 1), (600, [math.nan, *one[1:]], 1),
        (700, [math.inf, *one[1:]], 1), (800, one, None), (900, [0.0] * dim, 3), (901, [0.0] * dim, 3),
        (1000, one[:3], 1), (1001, one[:3], 1), (1002, one[:3], 2), (1100, [], 1), (1101, [], 2),
        (-100, [x * 1.1 for x in one], 2), (-7, [x * 0.9 for x in one], 3),
    ]


def as_floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("low, high, dim", [(-150, 150, 64), (0, 1, 3), (5, 9, 7), (-1, 0, 1), (-(2**40), 2**40, 5),
                                            (2**60, 2**60 + 3, 2), (-(2**31), 2**31, 900), (-7, 7, 0)])
def test_packed_scores(low, high, dim):
    rng = np.random.default_rng(1)
    a, c = (rng.integers(low, high, (n, dim), endpoint=True) for n in (3, 601))
    limit = np.iinfo(np.int64)
    exact = np.clip(a.astype(object) @ c.astype(object).T, limit.min, limit.max).astype(np.int64) if dim else np.zeros((3, 601))
    assert (packed_scores(a, c) == exact).all()


def test_hard_negatives(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(6)], rnd.randrange(3)) for i in range(0, 280)]
    rows = as_floats(rows + odd_rows(rnd, 6))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit("x"), "rank": F.lit(1), "block": F.lit(2)})
    got = sorted(map(tuple, hard_negatives(df.repartition(5), divisor=20, positives=3, negatives=4).collect()), key=repr)
    usable = [(i, ints(v, 256), label) for i, v, label in rows]
    usable = [(n, *r) for n, r in enumerate(usable) if r[1] is not None and r[2] is not None]
    last = lambda i: (i is None, i or 0)
    expected = []
    for n, i, v, label in usable:
        if i is None or i % 20:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), last(j), m, j, other == label)
                  for m, j, w, other in usable if m != n and len(w) == len(v)]
        scored.sort(key=lambda r: r[:3])
        for p in [s for s in scored if s[4]][:3]:
            fits = [s for s in scored if not s[4] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:4]
            expected += [(i, p[3], k + 1, s[3], -p[0], -s[0]) for k, s in enumerate(fits)]
    assert got == sorted(expected, key=repr) and len(got) > 50
    assert hard_negatives(df.limit(0)).count() == 0
    assert hard_negatives(df.filter("vec_id % 20 <> 0"), divisor=20).count() == 0


def test_hard_negatives_over_many_chunks(spark, monkeypatch):
    from postsieve.llm import grid

    rnd = random.Random(4)
    rows = as_floats([(i, [rnd.gauss(0, 0.2) for _ in range(5)], i % 4) for i in range(500)])
    df = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(map(tuple, hard_negatives(df, divisor=10).collect()))
    for name, value in (("CHUNK_ROWS", 17), ("BLOCK_ROWS", 9), ("SCORE_ROWS", 4), ("TASKS_PER_CORE", 1)):
        monkeypatch.setattr(grid, name, value)
    monkeypatch.setattr(negatives, "SCORE_ROWS", 4)
    assert sorted(map(tuple, hard_negatives(df.repartition(7), divisor=10).collect())) == whole


def brute_groups(rows, least):
    vectors = [None if v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v) else np.array(v)
               for _, v, _ in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and vectors[i] is not None and vectors[j] is not None
               and len(vectors[i]) == len(vectors[j])
               and vectors[i] @ vectors[j] / np.linalg.norm(vectors[i]) / np.linalg.norm(vectors[j]) >= least] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[i][0], len(linked[i]), component, rows[i][0] == component))
    return out


def grouped_rows(rnd, dim, n=400):
    rows = [(i, [rnd.gauss(0, 1) for _ in range(dim)], 0) for i in range(n)]
    for i in range(n, n + n // 2):  # copies at all distances around the limit
        near, width = rnd.choice(rows)[1], rnd.choice([0, 0.05, 0.2, 0.4, 0.48, 0.55])
        rows.append((i, [x + width * rnd.gauss(0, 1) for x in near], 0))
    dense = [rnd.gauss(0, 1) for _ in range(dim)]
    rows += [(5000 + i, [x + 0.06 * rnd.gauss(0, 1) for x in dense], 0) for i in range(n // 2)]
    rows += [(6000 + i, [x + 0.45 * rnd.gauss(0, 1) for x in dense], 0) for i in range(n // 4)]
    rows += [(7000 + i, rows[7][1], 0) for i in range(30)]
    return as_floats(rows + odd_rows(rnd, dim))


def test_near_vectors(spark, monkeypatch):
    """With cells, splits and blocks of all kinds on a few hundred rows."""
    rnd = random.Random(6)
    rows = grouped_rows(rnd, 24)
    for name, value in (("CELL_ROWS", 40), ("SPLIT_ROWS", 30), ("MOST_CELLS", 8), ("ASSIGN_ROWS", 50),
                        ("BLOCK_BYTES", 1), ("PRODUCTS", 3000)):
        monkeypatch.setattr(cells, name, value)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"cell": F.lit("x"), "kept": F.lit(1), "h": F.lit(2)})
    got = sorted(map(tuple, near_vectors(df.repartition(3), 0.9, reach=1.0).collect()), key=repr)
    expected = sorted(brute_groups(rows, 0.9), key=repr)
    assert got == expected and sum(n for _, n, _, _ in got) > 20_000
    assert near_vectors(df.limit(0)).count() == 0
    kept = one_per_cell_group(df)
    assert kept.columns == df.columns


def test_recall_of_the_default_reach(spark, monkeypatch):
    """Pairs right at the limit and all others, over many cells."""
    rnd = np.random.default_rng(8)
    base = rnd.normal(size=(1500, 64))
    near = base + 0.06 * np.linalg.norm(base, axis=1, keepdims=True) * rnd.normal(size=base.shape)  # cosines about 0.9
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(np.concatenate([base, near]))]
    monkeypatch.setattr(cells, "CELL_ROWS", 60)
    expected = {r[0]: r[1] for r in brute_groups_fast(rows, 0.9)}
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] <= expected[i] for i in got)
    assert sum(got.values()) >= 0.99 * sum(expected.values()) > 500


def brute_groups_fast(rows, least):
    x = np.array([v for _, v, _ in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = (x @ x.T >= least).sum(1) - 1
    return [(r[0], int(k)) for r, k in zip(rows, n, strict=True)]
