"""Mixing sources to target weights by Sainte-Laguë apportionment of token blocks.

The words of each source, documents in seeded order, form one line that is cut
into blocks of at most ``BLOCK`` words, equal to one word within a source.  The
block is that small at every size of the corpus, so a source of a few words has
blocks of its own size and reaches its target as a large one does.  Blocks are
awarded to sources by the highest quotients ``target / (2k + 1)``; the order of
the awards gives every output shard an integer quota for each source.  Seats
follow from the quotient of the last award in closed form, whatever their
number.  Within a source a seeded permutation picks the blocks; after the last
block it starts again with the first.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.llm import packs as pk
from postsieve.llm.base import staged, word_count
from postsieve.operators.ordering import number_rows

#: words of a block at most
BLOCK = 16
#: rows of a source that one task lays out
BUCKET_ROWS = 4096
#: primes to choose a source's stride from: multiples of one that does not divide a number of blocks permute them
STRIDES, LARGEST_STRIDE = 24, (1 << 31) - 1
#: blocks of a source up to which products of two of them fit a long; the primes for more
MANY_BLOCKS, FEW_STRIDES = 3_000_000_000, (1_000_003, 999_983)
#: quotients about the last of a shard that are ranked one by one
RANKED = 1024
#: quotients tried for each shard in one pass over the sources
TRIED = 7


@dataclass(frozen=True)
class Mix:
    """One row per source, blocks per shard and source, and the words of a block at most.

    ``sources``: source, source_no, source_size, rows, target, blocks, seats,
    buckets, shift, stride, and how many blocks are longer than short by a word.  ``quotas``: shard, source_no, blocks.
    """

    sources: DataFrame
    quotas: DataFrame
    block: int
    passes: int


def source_targets(
    records: DataFrame, weights: tuple[float, ...], share: float, passes: int
) -> tuple[DataFrame, int]:
    """Size, weight and target of every source, and the size of all.

    ``records`` has source and size.  Sources go by code point, null last, and
    take the weights in turn.  Targets add up to ``share`` of all sizes; none
    is above ``passes`` times its source: the excess is shared anew by weight
    until none is.  One small aggregate for each round.
    """
    sizes = records.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    numbered = staged(
        number_rows(sizes, F.asc_nulls_last("source"), out="source_no")
        .withColumn("source_no", F.col("source_no").cast("long"))
        .withColumn("weight", F.element_at(turn, (F.col("source_no") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * passes),
        "sources",
    )
    total = numbered.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget, rate, closed = share * total, 0.0, -1
    while budget:
        above = F.col("weight") * rate > F.col("cap")
        got = numbered.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        if got[0] == closed or not got[2]:
            break
        closed, rate = (got[0] if rate else -1), (budget - got[1]) / got[2]
    targets = numbered.withColumn(
        "target", F.least(F.col("cap").cast("double"), F.col("weight") * rate)
    )
    return targets, total


def _won(quotient: Column) -> Column:
    """How many quotients of a source are at least ``quotient``; exact in doubles."""
    near = F.floor(F.least(F.col("target") / (2 * quotient) + 0.5, F.col("most") + F.lit(1.0)))
    won = (
        F.when(F.col("target") / (2 * near + 1) >= quotient, near + 1)
        .when((near > 0) & (F.col("target") / (2 * near - 1) < quotient), near - 1).otherwise(near)
    )
    return F.least(F.col("most"), won).cast("long")


def _between(low: float, high: float, n: int) -> list[float]:
    """Up to ``n`` doubles inside the range, evenly spread over its representable values."""
    a, b = (int(np.float64(x).view(np.int64)) for x in (low, high))
    places = {a + (b - a) * i // (n + 1) for i in range(1, n + 1)} - {a, b}
    return [float(np.int64(x).view(np.float64)) for x in sorted(places)]


def _brackets(targets: DataFrame, ranks: list[int], counts: dict[float, int]) -> dict[int, tuple[float, float]]:
    """For each rank two quotients: fewer than ``rank`` reach the high one, so many at least the low one.

    ``counts`` has the number of quotients that reach some, and is added to.
    Every pass is one small aggregate.  A range is closed when few quotients
    are left in it, or only equal ones.
    """
    while True:
        known = sorted(counts)
        tried: set[float] = set()
        found = {}
        for rank in ranks:
            high = bisect_left(known, True, key=lambda q: counts[q] < rank)
            found[rank] = known[high - 1], known[high]
            if counts[known[high - 1]] - counts[known[high]] > RANKED:
                tried.update(_between(*found[rank], TRIED))
        if not tried:
            return found
        each = targets.select("target", "most", F.explode(F.array(*map(F.lit, sorted(tried)))).alias("quotient"))
        for row in each.groupBy("quotient").agg(F.sum(_won(F.col("quotient"))).alias("n")).collect():
            counts[row["quotient"]] = row["n"]


def awards(targets: DataFrame, seats: int, n_shards: int) -> DataFrame:
    """Blocks of each shard and source: the ``seats`` highest quotients, in order.

    ``targets`` has source_no, target and blocks (of its own line); a source
    gets at most ``most`` blocks.  Ties go to the first source.  What a source
    has won up to the end of a shard is counted from the last quotient there;
    only the quotients next to that one are ranked.
    """
    open_ = targets.filter((F.col("target") > 0) & (F.col("most") > 0)).select("source_no", "target", "most")
    known = open_.agg(F.max("target"), F.min(F.col("target") / (2 * F.col("most") - 1)), F.sum("most")).first()
    seats = min(seats, known[2] or 0)
    if not seats:
        return targets.select(F.lit(0).alias("shard"), "source_no", F.lit(0).cast("long").alias("blocks")).limit(0)
    ranks = [-(-(shard + 1) * seats // n_shards) for shard in range(n_shards)]
    counts = {known[1]: known[2], 2 * known[0]: 0}
    brackets = _brackets(open_, ranks, counts)
    ends, ranked = [], 0
    for shard, rank in enumerate(ranks):
        low, high = brackets[rank]
        ends.append(F.struct(F.lit(shard).alias("shard"), F.lit(low).alias("low"), F.lit(high).alias("high"),
                             F.lit(ranked).cast("long").alias("ranked"),
                             F.lit(rank - counts[high]).cast("long").alias("open")))
        ranked += counts[low] - counts[high]
    each = open_.select("source_no", "target", "most", F.inline(F.array(*ends))).withColumn("sure", _won(F.col("high")))
    near = each.withColumn("most", _won(F.col("low"))).filter("most > sure").select(
        "shard", "source_no", "target", "ranked", "open",
        F.explode(F.sequence(F.col("sure"), F.col("most") - 1)).alias("k"),
    ).withColumn("quotient", F.col("target") / (2 * F.col("k") + 1))
    last = number_rows(near, F.asc("shard"), F.desc("quotient"), F.asc("source_no"), out="rank").filter(
        F.col("rank") - F.col("ranked") < F.col("open"))
    more = last.groupBy("shard", "source_no").agg(F.count("*").alias("more"))
    won = each.join(more, ["shard", "source_no"], "left").select(
        "shard", "source_no", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("won"))
    before = F.lag("won", 1, 0).over(Window.partitionBy("source_no").orderBy("shard"))
    return won.select("shard", "source_no", (F.col("won") - before).alias("blocks")).filter("blocks > 0")


@cache
def _primes(n: int, below: int) -> list[int]:
    """The ``n`` largest primes up to ``below``."""
    sieve = np.ones(int(below**0.5) + 2, bool)
    sieve[:2] = False
    for i in range(2, int(len(sieve) ** 0.5) + 1):
        if sieve[i]:
            sieve[i * i::i] = False
    divisors, found = np.flatnonzero(sieve), []
    while len(found) < n:
        if (below % divisors[divisors < below]).all():
            found.append(below)
        below -= 1
    return found


def _stride(line: Column, source_no: Column, seed: int) -> Column:
    """Step of a source's permutation of ``line`` blocks, drawn by the seed.

    Of the primes that do not divide the number of blocks, one whose remainder
    is a fifth to four fifths of it: neighbouring blocks then come far apart in
    the permutation, so that no run of neighbours is taken or left together.
    """
    primes = F.filter(F.array(*[F.lit(p).cast("long") for p in _primes(STRIDES, LARGEST_STRIDE)]), lambda p: line % p != 0)
    ranked = F.transform(primes, lambda p: F.struct(
        (~(p % line / line).between(0.2, 0.8)).alias("near"), F.xxhash64(F.lit(seed), source_no, p).alias("drawn"),
        (p % line).alias("step")))
    few = F.when(line % FEW_STRIDES[0] != 0, FEW_STRIDES[0]).otherwise(FEW_STRIDES[1]).cast("long")
    return F.when(line > MANY_BLOCKS, few).otherwise(F.coalesce(F.array_min(ranked)["step"], few % line))


def plan_mix(
    records: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, passes: int = 2,
    n_shards: int = 64, seed: int = 0,
) -> Mix:
    """Targets, quotas and blocks for records with source and size.

    A target counts in blocks of its own source, so that blocks of different
    length weigh what they hold.
    """
    targets, _ = source_targets(records, weights, share, passes)
    blocks = F.ceil(F.col("source_size") / BLOCK).cast("long")
    lined = targets.withColumn("line", blocks).withColumn("most", F.col("line") * passes)
    wanted = lined.filter("line > 0").select(
        "source_no", (F.col("target") * F.col("line") / F.col("source_size")).alias("target"), "most")
    seats = round(wanted.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0])
    quotas = staged(awards(wanted, seats, n_shards), "quotas")
    seated = quotas.groupBy("source_no").agg(F.sum("blocks").alias("seats"))
    line = F.greatest(F.col("line"), F.lit(1))
    stride = _stride(line, F.col("source_no"), seed)
    sources = lined.join(seated, "source_no", "left").select(
        "source", "source_no", "source_size", "rows", "target", F.col("line").alias("blocks"),
        F.coalesce("seats", F.lit(0)).cast("long").alias("seats"),
        F.ceil(F.col("rows") / BUCKET_ROWS).cast("long").alias("buckets"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("source_no")), line).alias("shift"),
        stride.cast("long").alias("stride"),
        F.floor(F.col("source_size") / line).alias("short"), F.pmod("source_size", line).alias("longer"),
    )
    return Mix(staged(sources, "mix"), quotas, BLOCK, passes)


def _times(block_no: Column) -> Column:
    """How often the mix takes a block: its place in the permutation, once more per pass."""
    blocks = F.greatest(F.col("__m.blocks"), F.lit(1))
    place = F.pmod(block_no * F.col("__m.stride") + F.col("__m.shift"), blocks)
    return F.greatest(F.lit(0), F.ceil((F.col("__m.seats") - place) / blocks)).cast("long")


def _first_word(block_no: Column) -> Column:
    """Where a block begins: the first ``longer`` blocks of a source have a word more than ``short``."""
    return block_no * F.col("__m.short") + F.least(block_no, F.col("__m.longer"))


def _block_of(word: Column) -> Column:
    """The block that a word of a source is in."""
    short = F.greatest(F.col("__m.short"), F.lit(1))
    long_ones = F.col("__m.longer") * (F.col("__m.short") + 1)
    return F.when(word < long_ones, F.floor(word / (short + 1))).otherwise(
        F.col("__m.longer") + F.floor((word - long_ones) / short))


def lay_out(records: DataFrame, mix: Mix, key: str, seed: int = 0) -> DataFrame:
    """``records`` (key, source, size, anything else) with their place and what is taken.

    Adds ``__m`` (the source's row of the plan), ``__start`` (words before the
    record on its source's line) and ``taken``.  A source with many rows is
    laid out in buckets by a hash, so no task gets a whole hot source.
    """
    mark = F.xxhash64(F.lit(seed), F.col(key), F.col("size"))
    plan = mix.sources.select(F.col("source").alias("__source"), F.struct(
        "source_no", "source_size", "target", "blocks", "seats", "buckets", "shift", "stride", "short", "longer",
    ).alias("__m"))
    known = records.join(plan, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    dealt = (
        known.withColumn("__no", F.col("__m.source_no")).withColumn("__mark", mark)
        .withColumn("__bucket", F.pmod("__mark", F.greatest(F.col("__m.buckets"), F.lit(1))))
    )
    filled = records.join(plan, F.col("source").eqNullSafe(F.col("__source"))).groupBy(
        F.col("__m.source_no").alias("__no"),
        F.pmod(mark, F.greatest(F.col("__m.buckets"), F.lit(1))).alias("__bucket"),
    ).agg(F.sum("size").alias("__words"))
    before = Window.partitionBy("__no").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = filled.select("__no", "__bucket", F.coalesce(F.sum("__words").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__no", "__bucket").orderBy("__mark", key, "size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("__within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["__no", "__bucket"])
        .withColumn("__start", F.col("__offset") + F.col("__within"))
    )
    start, stop = F.col("__start"), F.col("__start") + F.col("size")
    taken = F.aggregate(
        F.sequence(_block_of(start), _block_of(stop - 1)), F.lit(0).cast("long"),
        lambda acc, j: acc + _times(j) * (F.least(stop, _first_word(j + 1)) - F.greatest(start, _first_word(j))),
    )
    return placed.withColumn("taken", F.when(F.col("size") > 0, taken).otherwise(F.lit(0)).cast("long")).drop(
        "__no", "__mark", "__bucket", "__offset", "__within")


def mix_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, **plan
) -> tuple[DataFrame, Mix]:
    """Words the mix takes of every document, and its plan.

    Returns key, size, source, source_size, target, taken.  A null text has
    size 0; a null source is a source of its own, the last; repeated rows are
    rows of their own.  The result depends on keys and sizes only, so reruns
    agree.  An empty table, or one without words, gives targets and taken of
    0.  Other columns are not read.
    """
    records = staged(
        docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")),
        "words",
    )
    mix = plan_mix(records, seed=seed, **plan)
    out = lay_out(records, mix, "key", seed).select(
        F.col("key").alias(key), "size", "source", F.col("__m.source_size").alias("source_size"),
        F.col("__m.target").alias("target"), "taken",
    )
    return out, mix


#: columns of the plan that cutting a document needs
_PLAN = ("blocks", "seats", "shift", "stride", "short", "longer")


def _copies(words, content: str, first: int, n: int, plan: tuple, passes: int) -> list[str]:
    """What the mix takes of one document: its text once for every pass that takes any of its blocks."""
    blocks, seats, shift, stride, short, longer = plan
    turned = longer * (short + 1)

    def block_of(word):
        return word // (short + 1) if word < turned else longer + (word - turned) // short

    def first_word(j):
        return j * short + min(j, longer)

    copies, held = [], None
    numbers = range(block_of(first), block_of(first + n - 1) + 1) if n else range(0)
    for turn in range(passes):
        chosen = [j for j in numbers if (j * stride + shift) % blocks + turn * blocks < seats]
        if len(chosen) == len(numbers):
            copies += [content] * bool(chosen)
        elif chosen:
            if held is None:
                raw = content.encode("utf-8", "surrogatepass")
                held = [m.span() for m in words.finditer(raw)]
            pieces, last = [], None
            for j in chosen:
                a, b = max(first_word(j) - first, 0), min(first_word(j + 1) - first, n)
                if last == j - 1:
                    pieces[-1][1] = b
                else:
                    pieces.append([a, b])
                last = j
            copies.append(b" ".join(raw[held[a][0]:held[b - 1][1]] for a, b in pieces).decode("utf-8", "surrogatepass"))
    return copies


#: rows of a result batch
_BATCH_ROWS = 256


def mixed_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, **plan
) -> DataFrame:
    """The mix itself: the documents of ``docs``, as often and as far as their blocks are taken.

    Same columns as ``docs``.  A document whose blocks are all taken twice
    comes twice; of one whose blocks are taken in part, only their words
    remain.  Documents without words have no blocks and do not come.  Texts
    stay in their packs, where they are cut; only places, keys, sources and
    sizes are laid out.
    """
    columns = docs.columns
    sized = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)],
                        word_count(F.col(f"`{text}`")).alias("size"))
    place = {c: f"c{i}" for i, c in enumerate(columns)}
    packs = pk.packed(sized, place[text])
    kinds = T.StructType.fromDDL("pack long, place int, size long").add("key", docs.schema[key].dataType).add(
        "source", docs.schema[source].dataType)

    def measure(pack: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        n = len(table)
        yield pa.record_batch(
            [pa.array(np.full(n, pack)), pa.array(np.arange(n, dtype=np.int32)),
             *[table[c].combine_chunks() for c in ("size", place[key], place[source])]],
            names=["pack", "place", "size", "key", "source"])

    records = staged(pk.mapped(packs, measure, kinds), "records")
    mix = plan_mix(records.select("source", "size"), seed=seed, **plan)
    laid = lay_out(records, mix, "key", seed).filter("taken > 0")
    notes = laid.select("pack", "place", F.col("__start").alias("first"), "size", *[f"__m.{c}" for c in _PLAN])
    passes = mix.passes

    def cut(_: int, table: pa.Table, found: pa.Array) -> Iterator[pa.RecordBatch]:
        import re

        words = re.compile(rb"[^\x20\x09-\x0D]+")
        at = table.schema.get_field_index(place[text])
        wanted = sorted(zip(*[found.field(c).to_pylist() for c in ("place", "first", "size", *_PLAN)], strict=True))
        for start in range(0, len(wanted), _BATCH_ROWS):
            rows, texts = [], []
            for row, first, n, *rest in wanted[start:start + _BATCH_ROWS]:
                copies = _copies(words, table[place[text]][row].as_py(), first, n, tuple(rest), passes)
                rows += [row] * len(copies)
                texts += copies
            part = table.take(pa.array(rows, pa.int64()))
            part = part.set_column(at, table.schema.field(at), pa.array(texts, table.schema.field(at).type))
            yield from part.drop_columns(["size"]).rename_columns(columns).to_batches()

    return pk.joined(packs, notes, cut, docs.schema)
