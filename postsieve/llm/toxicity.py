"""Toxicity by compression distance.

One zstandard dictionary is trained on windows of ordinary text, another on
the windows of toxic text that set it apart.  A window (a word, or a piece of a
very long one) is compressed with both; where the toxic dictionary saves more
than a calibrated share of the length, the window counts as toxic.  A logistic
curve over a document's windows, fitted on documents that trained no
dictionary, gives the score.

A compressed word is a few bytes long, too coarse to compare.  So each byte is
first replaced by ``WIDTH`` fixed pseudo-random bytes: a match in a dictionary
stays a match, while what is not matched costs several times as much, and the
length comes close to a count of dictionary phrases.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.base import as_bytes, release_memory

#: bounds of the labelled sample: documents of each label, bytes of one of them
MAX_TOXIC, MAX_ORDINARY, MAX_BYTES = 1200, 2400, 32_768
#: bytes of the dictionaries, compression level, bytes for a byte, bytes of a window
ORDINARY_BYTES, TOXIC_BYTES, LEVEL, WIDTH, WINDOW = 112_640, 16_384, 17, 3, 64
#: windows of the ordinary sample that its dictionary is trained on, evenly spread
TRAIN_WINDOWS = 250_000
#: byte run by which toxic windows are told apart; documents it is found in; log odds it needs
RUN, MIN_DOCS, MIN_ODDS = 5, 3, 3.0
#: a document is toxic from this score on
CUT = 0.7
#: bytes of memory for the windows a task keeps before it starts over (with what an entry of
#: a dictionary takes), and bytes of text it scores at once
KEPT_BYTES, SLICE_BYTES = 64 << 20, 2 << 20
ENTRY_BYTES = 150
#: bytes by which the pieces of a very long word overlap
OVERLAP = 8


def windows(content: bytes) -> list[bytes]:
    """Lower-cased words between spaces, long ones in pieces; all of the text."""
    words = content.lower().split()
    if max(map(len, words), default=0) <= WINDOW:
        return [b" " + word + b" " for word in words]
    out = []
    for word in words:
        if len(word) <= WINDOW:
            out.append(b" " + word + b" ")
        else:
            out += [b" " + word[i:i + WINDOW] + b" " for i in range(0, max(1, len(word) - OVERLAP), WINDOW - OVERLAP)]
    return out


def _runs(content: bytes) -> set[bytes]:
    return {w[i:i + RUN] for w in set(windows(content)) for i in range(max(1, len(w) - RUN + 1))}


@dataclass
class Scorer:
    """Both dictionaries, the window threshold and the curve."""

    ordinary: bytes
    toxic: bytes
    threshold: float = 0.25
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    base: float = 0.0
    kept: dict[bytes, float] = field(default_factory=dict)
    kept_bytes: int = 0
    tools: tuple = ()

    def __getstate__(self):
        return {**self.__dict__, "kept": {}, "kept_bytes": 0, "tools": ()}

    def saved(self, distinct: list[bytes]) -> np.ndarray:
        """Share of each window's length that the toxic dictionary saves; each new one is compressed once."""
        if not self.tools:
            self.tools = (_code(), _compressor(self.ordinary).compress, _compressor(self.toxic).compress)
        code, plain, toxic = self.tools
        kept, join, wider = self.kept, b"".join, code.__getitem__
        new = [window for window in distinct if window not in kept]
        for window in new:
            wide = join(map(wider, window))
            length = len(plain(wide))
            kept[window] = (length - len(toxic(wide))) / length
        out = np.fromiter(map(kept.__getitem__, distinct), float, len(distinct))
        self.kept_bytes += sum(map(len, new)) + ENTRY_BYTES * len(new)
        if self.kept_bytes > KEPT_BYTES:
            self.kept, self.kept_bytes = {}, 0
        return out

    def shares(self, contents: list[bytes]) -> list[np.ndarray]:
        """The shares of every window of each text; equal windows are looked up once."""
        each = [windows(content) for content in contents]
        every = [window for found in each for window in found]
        if not every:
            return [np.zeros(0) for _ in each]
        codes, distinct = pd.factorize(np.array(every, object))
        values = self.saved(list(distinct))[codes]
        return np.split(values, np.cumsum([len(found) for found in each])[:-1])

    @staticmethod
    def features(shares: np.ndarray, threshold: float) -> tuple[float, ...]:
        """Largest share, mean of the three largest, number and part over the threshold."""
        if not len(shares):
            return 0.0, 0.0, 0.0, 0.0
        over = int((shares >= threshold).sum())
        most = np.maximum(np.sort(shares)[-3:], 0.0)
        return float(most[-1]), float(most.sum() / 3), math.log1p(over), math.sqrt(over / len(shares))

    def scores(self, contents: list[bytes]) -> list[float]:
        """The score of each text, 0 to 1."""
        if not self.toxic:
            return [self.base] * len(contents)
        out = []
        for shares in self.shares(contents):
            found = self.features(shares, self.threshold)
            out.append(1 / (1 + math.exp(-max(-500, min(500, self.base + sum(
                w * f for w, f in zip(self.weights, found, strict=True)))))))
        return out


def _parameters(size: int):
    import zstandard

    return zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=WINDOW, dict_size=size, write_content_size=False, write_checksum=False,
        write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)


def _compressor(dictionary: bytes):
    import zstandard

    parameters = _parameters(len(dictionary))
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=parameters)


def _code() -> list[bytes]:
    """The fixed bytes that stand for each byte."""
    return [bytes(row) for row in np.random.default_rng(7).integers(0, 256, (256, WIDTH), np.uint8)]


def _widened(samples) -> list[bytes]:
    code = _code()
    return [b"".join(map(code.__getitem__, s)) for s in samples]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train on."""
    import zstandard

    wide = _widened(samples)
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, wide)) // 4)), wide).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(wide))[-size:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights, base and loss of a slightly damped logistic fit by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w, damp = np.zeros(a.shape[1]), np.diag([0.02] * x.shape[1] + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + damp, a.T @ (y - p) - damp @ w)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    p = np.clip(1 / (1 + np.exp(-np.clip(a @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return w, float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum() + 0.01 * (w[:-1] ** 2).sum())


def fit(rows: list[tuple[bytes, int]]) -> Scorer:
    """A scorer from labelled texts; every third one calibrates, the others train.

    Without texts of both labels the score is the share of toxic ones, for
    every text.
    """
    train = [r for i, r in enumerate(rows) if i % 3 != 2]
    rest = [r for i, r in enumerate(rows) if i % 3 == 2] or train
    toxic, ordinary = [t for t, x in train if x], [t for t, x in train if not x]
    share = sum(x for _, x in rows) / len(rows) if rows else 0.0
    runs: Counter = Counter()
    for text in toxic:
        runs.update(_runs(text))
    runs = Counter({r: n for r, n in runs.items() if n >= min(MIN_DOCS, len(toxic))})
    usual: Counter = Counter()
    for text in ordinary:
        usual.update(r for r in _runs(text) if r in runs)
    apart = {
        r for r, n in runs.items()
        if math.log((n + 0.5) / (len(toxic) + 1)) - math.log((usual[r] + 0.5) / (len(ordinary) + 1)) > MIN_ODDS
    }
    telling = [w for t in toxic for w in windows(t) if any(w[i:i + RUN] in apart for i in range(max(1, len(w) - RUN + 1)))]
    plain = [w for t in ordinary for w in windows(t)]
    if not telling or not plain or not any(x for _, x in rest) or all(x for _, x in rest):
        return Scorer(b"", b"", base=share)
    scorer = Scorer(_dictionary(plain[:: max(1, len(plain) // TRAIN_WINDOWS)], ORDINARY_BYTES),
                    _dictionary(telling, TOXIC_BYTES))
    shares, labels = scorer.shares([t for t, _ in rest]), np.array([x for _, x in rest], float)
    best = None
    for threshold in np.arange(0.15, 0.45, 0.01):
        x = np.array([Scorer.features(s, threshold) for s in shares])
        w, loss = _logistic(x, labels)
        if best is None or loss < best[0]:
            best = (loss, threshold, w)
    scorer.threshold, scorer.weights, scorer.base = float(best[1]), tuple(map(float, best[2][:-1])), float(best[2][-1])
    return scorer


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> list[tuple[bytes, int]]:
    """Texts and labels to learn from, in the order of a hash of their key.

    Bounded by ``MAX_TOXIC`` and ``MAX_ORDINARY`` documents of at most
    ``MAX_BYTES`` bytes.  A document with several labels is toxic if one says
    so; of rows that repeat a key one counts; null labels and null texts do not.
    """
    usable = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    said = usable.groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("x"))
    narrow = docs.filter(F.octet_length(text) <= MAX_BYTES).select(F.col(key).alias("k")).distinct().join(said, "k")
    mark = F.xxhash64("k")
    chosen = narrow.filter("x = 1").orderBy(mark, "k").limit(MAX_TOXIC).unionByName(
        narrow.filter("x = 0").orderBy(mark, "k").limit(MAX_ORDINARY))
    # two labels' bounds: a few thousand keys
    texts = docs.filter(F.octet_length(text) <= MAX_BYTES).select(F.col(key).alias("k"), F.col(text).alias("t")).join(
        F.broadcast(chosen), "k")
    # one text for each of those keys, however often it repeats
    found = texts.groupBy("k", "x").agg(F.min(F.struct(F.xxhash64("k", "t").alias("m"), "t")).alias("s")).select(
        "k", "x", "s.m", "s.t").collect()
    found.sort(key=lambda r: (r["m"], r["k"]))
    return [(as_bytes(row["t"]), row["x"]) for row in found]


def scores(docs: DataFrame, scorer: Scorer, text: str = "text") -> Column:
    """The score of every whole text, 0 to 1; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        try:
            for texts in batches:
                out, held, size = [], [], 0
                for content in map(as_bytes, texts):
                    held.append(content)
                    size += len(content)
                    if size >= SLICE_BYTES:
                        out += known.scores(held)
                        held, size = [], 0
                yield pd.Series(out + known.scores(held), dtype="float64")
        finally:
            known.kept, known.kept_bytes = {}, 0
            release_memory()

    return run(F.col(text))


def with_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """Key, text, held_out, score and predicted of every row of ``docs``.

    Labels are learned from a bounded sample of the rows not held out; only the
    text enters a score, so equal texts have equal scores.  Empty and null
    texts have the score of a text without toxic windows.  Without labels of
    both kinds every score is the share of toxic labels.  An empty table gives
    no rows; columns of these names are replaced, all others kept.
    """
    scorer = fit(labelled_sample(docs, labels, key, text, label))
    return (
        docs.withColumn("held_out", held_out(F.col(key))).withColumn("score", scores(docs, scorer, text))
        .withColumn("predicted", (F.col("score") >= CUT).cast("int"))
    )


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` below the cut, same columns."""
    scorer = fit(labelled_sample(docs, labels, key, text))
    score = scores(docs, scorer, text)
    return docs.withColumn("__score", score).filter(F.col("__score") < CUT).drop("__score")
