"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Equal vectors count as one.  Each vector is a member of the cell of its nearest
centre and visits the cells whose border is near: of two vectors with cosine
``least`` one at most is further than ``sin(acos(least) / 2)`` from the plane
between their cells, so visits within that distance would find every pair, and
a share of it (``reach``) finds nearly all, as differences point anywhere.
Cells with too many rows are split again by centres of their own.

Within a cell the members closer to the centre than half the angle of ``least``
(its core) are all linked to each other, without any product: a large group of
near copies costs one pass.  The other rows are compared with each other, and
with those parts of the core that the angles leave open, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.base import staged
from postsieve.llm.components import components

#: members aimed at in a cell, and members outside the core above which it is split again
CELL_ROWS, SPLIT_ROWS = 1024, 32_768
#: most cells one split makes, and rows of the sample for each: the bounds of a fit
MOST_CELLS, SAMPLE_ROWS = 4096, 16
#: splits of a cell, one below the other; larger cells then go as pairs of blocks
LEVELS = 4
#: rows assigned by one call, bytes of vectors in a block, products held at once
ASSIGN_ROWS, BLOCK_BYTES, PRODUCTS = 16_384, 16 << 20, 1 << 21
#: angles and cosines this close to a limit are decided by the product
SURE = 1e-9
#: share of the margin that would find every pair
REACH = 0.4

_ROW = ("cell long, class long, copies long, vec binary, member boolean, home long, target long, visits binary,"
        " near double")
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def units(vectors: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors as rows; very large and very small ones without overflow."""
    rows = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def fit_centres(rows: np.ndarray, k: int, least: float, rounds: int = 8) -> np.ndarray:
    """Centres of at most ``k`` spherical clusters of unit vectors.

    Seeds are drawn far from each other, so that a dense group gets few;
    centres that end up closer than ``least`` become one.
    """
    rng = np.random.default_rng(7)
    chosen, far = [int(rng.integers(len(rows)))], np.full(len(rows), np.inf)
    while len(chosen) < min(k, len(rows)):
        far = np.minimum(far, np.maximum(1 - rows @ rows[chosen[-1]], 0))
        total = far.sum()
        if total <= 1e-9:
            break
        chosen.append(int(np.searchsorted(np.cumsum(far), rng.random() * total).clip(0, len(rows) - 1)))
    centres = rows[chosen].copy()
    for _ in range(rounds):
        label = np.concatenate([(rows[at:at + 2048] @ centres.T).argmax(1) for at in range(0, len(rows), 2048)])
        order = np.argsort(label, kind="stable")
        used, starts = np.unique(label[order], return_index=True)
        sums = np.add.reduceat(rows[order], starts)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres[used] = np.where(size > 1e-9, sums / np.maximum(size, 1e-300), centres[used])
    kept: list[int] = []
    for i in range(len(centres)):
        if not kept or (centres[kept] @ centres[i]).max() < least:
            kept.append(i)
    return centres[kept]


def _child(cell: int, places: np.ndarray) -> np.ndarray:
    """Ids of the cells below a cell."""
    x = np.uint64(cell & (1 << 64) - 1) * np.uint64(0x9E3779B97F4A7C15) + (places + 1).astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return (x ^ x >> np.uint64(31)).view(np.int64)


def _assigned(part: pd.DataFrame, centres: np.ndarray, kind: str, margin: float) -> Iterator[pd.DataFrame]:
    """Rows of one cell as members and visitors of the cells below it."""
    cell = int(part["cell"].iloc[0])
    names = _child(cell, np.arange(len(centres)))
    between = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 1e-12))
    step = max(64, PRODUCTS // len(centres))
    for at in range(0, len(part), step):
        rows = part.iloc[at:at + step].reset_index(drop=True)
        near = units(rows["vec"].tolist(), kind) @ centres.T
        home = near.argmax(1)
        member = rows["member"].to_numpy(bool)
        gap = near[np.arange(len(rows)), home][:, None] - near
        # a visitor meets members only, which do not come to meet it: twice the margin
        i, j = np.nonzero(gap <= between[home] * np.where(member, margin, 2 * margin)[:, None])
        own = j == home[i]
        visited = np.split(names[j[~own]], np.cumsum(np.bincount(i[~own], minlength=len(rows)))[:-1])
        visits = np.array([a + b.tobytes() for a, b in zip(rows["visits"], visited, strict=True)], object)
        inside = member[i]
        out = rows.iloc[i].reset_index(drop=True)
        out["cell"], out["near"] = names[j], near[i, j]
        out["home"] = np.where(inside, names[home[i]], out["home"])
        out["target"] = np.where(inside, names[j], out["target"])
        out["member"] = inside & own
        out["visits"] = np.where(out["member"], visits[i], b"")
        yield out[_NAMES]


def _split(rows: DataFrame, sizes: DataFrame, kind: str, least: float, margin: float) -> DataFrame:
    """The rows of the cells in ``sizes`` in cells of their own."""
    sizes = sizes.withColumns({
        "k": F.least(F.lit(MOST_CELLS), F.ceil(F.col("members") / CELL_ROWS)).cast("int"),
        "parts": F.ceil(F.col("rows") / ASSIGN_ROWS).cast("int")}).select("cell", "members", "k", "parts")
    draw = F.pmod(F.xxhash64("class", F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    # SAMPLE_ROWS * MOST_CELLS rows of a cell at most, on average
    sample = rows.filter("member").join(sizes, "cell").filter(
        draw <= F.greatest(F.col("k") * SAMPLE_ROWS, F.lit(64)) / F.col("members")).select("cell", "k", "parts", "class", "vec")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("class")
        centres = fit_centres(units(part["vec"].tolist(), kind), int(part["k"].iloc[0]), least)
        return pd.DataFrame({"cell": part["cell"].iloc[:1], "parts": part["parts"].iloc[:1], "centres": [centres.tobytes()]})

    fitted = sample.groupBy("cell").applyInPandas(fit, "cell long, parts int, centres binary")
    fitted = staged(fitted, "centres")

    def assign(part: pd.DataFrame, fit: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return part[_NAMES]
        dim = len(part["vec"].iloc[0]) // np.dtype(kind).itemsize
        centres = np.frombuffer(fit["centres"].iloc[0], np.float64).reshape(-1, dim)
        return pd.concat(_assigned(part, centres, kind, margin), ignore_index=True)

    dealt = rows.join(fitted.select("cell", "parts"), "cell").withColumn(
        "part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")).select(*_NAMES, "part")
    copies = fitted.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("cell", "part", "centres")
    return dealt.groupBy("cell", "part").cogroup(copies.groupBy("cell", "part")).applyInPandas(assign, _ROW)


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels of rows after linking rows i and j."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        low = np.minimum(a, b)
        label = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label = label[label]


def _links(kind: str, least: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        a, b = int(part["a"].iloc[0]), int(part["b"].iloc[0])
        # members first: visitors of one cell are not compared with each other
        part = part.iloc[np.argsort(~part["member"].to_numpy(bool), kind="stable")].reset_index(drop=True)
        block, member = part["block"].to_numpy(), part["member"].to_numpy(bool)
        vectors, copies = units(part["vec"].tolist(), kind), part["copies"].to_numpy(np.int64)
        home, target = part["home"].to_numpy(np.int64), part["target"].to_numpy(np.int64)
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        visits = [np.frombuffer(v, np.int64) for v in part["visits"]]
        owner = np.repeat(np.arange(len(part)), [len(v) for v in visits])
        spread = np.int64(0x2545F4914F6CDD1D)
        visited = np.unique(np.concatenate([*visits, np.zeros(0, np.int64)]) ^ owner * spread)
        links, label = np.zeros(len(part), np.int64), np.arange(len(part))
        step = max(1, PRODUCTS // max(1, len(right)))
        for at in range(0, len(left), step):
            rows = left[at:at + step]
            i, j = np.nonzero(vectors[rows] @ vectors[right].T >= least)
            i, j = rows[i], right[j]
            keep = (member[i] | member[j]) & ((j > i) if a == b else True)
            i, j = i[keep], j[keep]
            # a visitor and a member that meet in the visitor's home too count in the smaller cell
            v, m = np.where(member[i], j, i), np.where(member[i], i, j)
            twice = ~member[v] & (home[v] < target[v])
            twice[twice] = np.isin(home[v[twice]] ^ m[twice] * spread, visited)
            i, j = i[~twice], j[~twice]
            if len(i):
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                label = _merge(label, i, j)
        names = part["class"].to_numpy(np.int64)
        counted, linked = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(part)))
        return pd.DataFrame({
            "class": np.concatenate([names[counted], names[linked]]),
            "n": np.concatenate([links[counted], np.zeros(len(linked), np.int64)]),
            "other": pd.array([None] * len(counted) + names[label[linked]].tolist(), "Int64"),
        })

    return run


def _compared(cells: DataFrame, dim: int, kind: str, least: float) -> DataFrame:
    """(class, n, other): links counted, and links that connect all that are linked."""
    half, whole = np.arccos(least) / 2, np.arccos(least)
    block_rows = max(256, BLOCK_BYTES // (8 * max(1, dim)))
    core = F.col("member") & (F.col("near") >= F.lit(float(np.cos(half)) + SURE))
    cells = cells.withColumn("core", core)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("near"))))
    size = cells.groupBy("cell").agg(
        F.count_if("core").alias("n_core"), F.count_if(~F.col("core")).alias("n_open"),
        F.max(F.when(F.col("core"), angle)).alias("radius"), F.min(F.when(F.col("core"), F.col("class"))).alias("least"),
        F.sum(F.when(F.col("core"), F.col("copies"))).alias("weight"),
    ).withColumns({
        "open_blocks": F.ceil(F.col("n_open") / block_rows).cast("int"),
        "core_blocks": F.ceil(F.col("n_core") / block_rows).cast("int")})
    size = staged(size, "cell-sizes")
    known = cells.join(size, "cell")
    number = F.pmod(F.xxhash64("class"), F.when(F.col("core"), F.col("core_blocks")).otherwise(F.col("open_blocks")))
    known = known.withColumn("block", F.when(F.col("core"), -1 - number).otherwise(number).cast("int"))
    columns = ["cell", "a", "b", "block", "class", "copies", "vec", "member", "home", "target", "visits"]
    open_rows = known.filter(~F.col("core")).withColumn(
        "reaches", (F.col("n_core") > 0) & (angle - F.col("radius") <= F.lit(float(whole) + SURE)))
    both = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("open_blocks") - 1))).withColumns(
        {"a": F.least("block", "other"), "b": F.greatest("block", "other")})
    mixed = open_rows.filter("reaches").withColumns(
        {"a": F.col("block"), "b": F.explode(F.sequence(F.lit(-1), -F.greatest("core_blocks", F.lit(1)), F.lit(-1)))})
    # core rows go where an open row may reach them
    wanted = mixed.select("cell", "a").distinct()
    cores = known.filter("core").join(wanted, "cell").withColumn("b", F.col("block"))
    dealt = both.select(*columns).unionByName(mixed.select(*columns)).unionByName(cores.select(*columns))
    found = staged(dealt.groupBy("cell", "a", "b").applyInPandas(_links(kind, least), "class long, n long, other long"), "links")
    inside = known.filter("core").select(
        "class", (F.col("weight") - F.col("copies")).alias("n"), F.col("least").alias("other"))
    return found.unionByName(inside)


def near_vectors(
    vectors: DataFrame, least: float = 0.9, reach: float = REACH, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Every row's key, n_links, component_id and kept.

    Two rows are linked where the cosine of their vectors, in double precision,
    is at least ``least`` and their cells bring them together; see the module
    for ``reach`` (1 finds every pair).  ``n_links`` counts the other rows
    linked, copies included; ``component_id`` is the smallest key that links
    lead to, the row's own included (null only where all keys are null);
    ``kept`` marks the rows that have it.  Vectors that are null, empty or
    zero, or hold a null or non-finite component, link with nothing.  Only
    vectors of equal length are compared.  Rows that repeat a key are rows of
    their own.  An empty table gives no rows; other columns are not read.
    """
    kind = "f4" if "float" in vectors.schema[vector].dataType.simpleString() else "f8"
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    usable = F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))) & ~F.isnan(x.cast("double"))
    ) & F.exists("v", lambda x: x != 0)
    named = rows.withColumns({"h": F.when(usable, F.xxhash64("v")), "g": F.when(usable, F.xxhash64(F.lit("more"), "v"))})
    # equal vectors, by 128 bits of hash, as one
    classes = staged(
        named.filter("h is not null").groupBy("h", "g")
        .agg(F.any_value("v").alias("v"), F.min("id").alias("first"), F.count("*").alias("copies"))
        .withColumns({"class": F.monotonically_increasing_id(), "dim": F.size("v")}), "classes")
    start = (F.col("class"), F.col("copies"), F.col("dim").cast("long").alias("cell"), F.col("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lists = batch.num_rows, batch.column("v")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind).tobytes()
            places = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            size = np.dtype(kind).itemsize
            vec = [flat[a * size:b * size] for a, b in zip(places[:-1], places[1:], strict=True)]
            cell = batch.column("cell")
            yield pa.record_batch(
                [cell, batch.column("class"), batch.column("copies"), pa.array(vec, pa.binary()),
                 pa.array([True] * n), cell, cell, pa.array([b""] * n, pa.binary()), pa.array([-1.0] * n)], names=_NAMES)

    now = staged(classes.select(*start).mapInArrow(pack, _ROW), "cells")
    margin, done = reach * float(np.sin(np.arccos(least) / 2)), None
    core = F.col("member") & (F.col("near") >= F.lit(float(np.cos(np.arccos(least) / 2)) + SURE))
    for level in range(LEVELS):
        sizes = now.groupBy("cell").agg(
            F.count("*").alias("rows"), F.count_if("member").alias("members"),
            F.count_if(F.col("member") & ~core).alias("open"))
        large = staged(sizes.filter(F.col("open") > (SPLIT_ROWS if level else 0)), "large-cells")
        if large.isEmpty():
            break
        rest = now.join(large.select("cell"), "cell", "left_anti").select(*_NAMES)
        done = rest if done is None else done.unionByName(rest)
        now = staged(_split(now.join(large.select("cell"), "cell", "left_semi"), large, kind, least, margin), "cells")
    cells = now if done is None else done.unionByName(now)
    dim = classes.agg(F.max("dim")).first()[0] or 1
    found = staged(_compared(cells, dim, kind, least), "found")
    counts = found.select("class", "n").unionByName(classes.select("class", (F.col("copies") - 1).alias("n")))
    counts = counts.groupBy("class").agg(F.sum("n").alias("n_links"))
    linked = components(found.filter("other is not null").select(F.col("class").alias("u"), F.col("other").alias("v")))
    rooted = classes.select("h", "g", "class", "first").join(counts, "class").join(
        linked, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    result = rooted.join(smallest, "root").select("h", "g", "n_links", "component_id")
    alone = F.col("h").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return named.select("id", "h", "g").join(result, ["h", "g"], "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def one_per_cell_group(vectors: DataFrame, least: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The rows of ``vectors`` whose key represents its group, same columns."""
    kept = near_vectors(vectors, least, key=key, vector=vector).filter("kept").select(F.col(key).alias("__kept")).distinct()
    return vectors.join(kept, F.col(key).eqNullSafe(F.col("__kept")), "left_semi")
