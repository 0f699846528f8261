"""BPE encoding and decoding by a tokenization automaton.

The automaton starts as the one that reads any bytes.  Each merge ``u v -> w``,
in order, adds one gadget: the arc ``w`` beside every path ``u v``, a state for
``w`` that copies the state after ``v``, and the end of the arc ``v`` in the
state after ``u``.  What remains accepts, for every string, exactly its
encoding.  States and arcs are kept as what the gadget changed (a copy's origin
and the time of each change), so the table is linear in the number of merges;
arcs looked up once are kept in full.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.llm.base import releasing

#: split of a text into words before the merges (fixed value of byte-level BPE)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: letters and white space of texts for which a pattern of plain ranges splits alike
_LETTERS, _SPACE = "A-Za-zÀ-ÖØ-öø-ɏ", "\\t\\n\\r "
_PLAIN = rf"[{_SPACE}!-~À-ÖØ-öø-ɏ]*"
_PLAIN_PATTERN = rf" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^{_SPACE}0-9{_LETTERS}]+|\s+(?!\S)|\s+"
#: bytes of memory for the words a worker keeps before it starts over (with what an entry of a
#: dictionary takes), and pairs of tokens
KEPT_BYTES, ENTRY_BYTES, MAX_PAIRS = 48 << 20, 200, 200_000
_SHIFT = 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Automaton:
    """States and arcs; a state is named by the token read last, an arc by its token."""

    labels: list[bytes]
    arcs: dict[bytes, int]
    born: list[int]
    left: list[int]
    right: list[int]
    ended: dict[int, int]
    special: dict[str, int]
    longest: int
    seen: dict[int, bool] = field(default_factory=dict)
    words: dict[str, bytes] = field(default_factory=dict)
    kept: int = 0

    def open(self, state: int, arc: int, limit: int = 1 << 60) -> bool:
        """Whether ``arc`` leaves ``state`` when the merges below ``limit`` are in."""
        born, ended = self.born, self.ended
        while True:
            end = ended.get(state << _SHIFT | arc)
            if end is not None and end < limit:
                return False
            if born[state] < 0 and born[arc] < 0:
                return True
            if born[state] > born[arc]:  # the state is a later copy
                limit, state = born[state], self.right[state]
            else:  # the arc came later, beside the path that begins with its left part
                limit, arc = born[arc] + 1, self.left[arc]

    def step(self, state: int, arc: int) -> bool:
        """:meth:`open` by table."""
        place = state << _SHIFT | arc
        known = self.seen.get(place)
        if known is None:
            if len(self.seen) >= MAX_PAIRS:
                self.seen.clear()
            known = self.seen[place] = self.open(state, arc)
        return known

    def read(self, word: bytes) -> list[int]:
        """Tokens of one word: the only path through the automaton that spells it."""
        whole = self.arcs.get(word)
        if whole is not None:
            return [whole]
        arcs, step, longest = self.arcs, self.step, self.longest
        size, at = len(word), 0
        out: list[int] = []
        sizes: list[int] = []
        dead: set[int] = set()  # places from which no path leads to the end
        reach = min(size, longest)
        while at < size:
            while reach:
                arc = arcs.get(word[at:at + reach])
                if arc is not None and at + reach not in dead and (not out or step(out[-1], arc)):
                    break
                reach -= 1
            if reach:
                out.append(arc)
                sizes.append(reach)
                at += reach
                reach = min(size - at, longest)
            else:
                # only one path leads to any place, so this one is of no use again
                dead.add(at)
                reach = sizes.pop()
                at -= reach
                out.pop()
                reach -= 1
        return out


def compiled(path: str) -> Automaton:
    """The automaton of a byte-level BPE file of the `tokenizers` library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"]
    if split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or spec["normalizer"]:
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    for token in spec["added_tokens"]:
        if token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError(f"added token {token['content']!r} strips or needs word ends")
    letters = byte_letters()
    ids = model["vocab"]
    size = 1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])])
    labels, born = [b""] * size, [-1] * size
    left, right = [-1] * size, [-1] * size
    for token, i in ids.items():
        labels[i] = bytes(letters[c] for c in token)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for content, i in special.items():
        labels[i] = content.encode()
    machine = Automaton(labels, {labels[i]: i for i in ids.values() if len(labels[i]) == 1},
                        born, left, right, {}, special, 1)
    for time, merge in enumerate(model["merges"]):
        u, v = merge if isinstance(merge, list) else merge.split(" ")
        first, second, whole = ids[u], ids[v], ids[u + v]
        if labels[whole] in machine.arcs:
            raise ValueError(f"two merges make {u + v!r}")
        readable = labels[first] in machine.arcs and labels[second] in machine.arcs
        if readable and machine.open(first, second, time):
            born[whole], left[whole], right[whole] = time, first, second
            machine.ended[first << _SHIFT | second] = time
            machine.arcs[labels[whole]] = whole
            machine.longest = max(machine.longest, len(labels[whole]))
    return machine


class Bpe:
    """Column functions for one tokenizer file.

    The driver compiles the file; tasks get the tables as a broadcast whose
    size depends on the vocabulary alone.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._shared = spark.sparkContext.broadcast(compiled(path))

    def encode(self, text: Column) -> Column:
        """Token ids as little-endian 32-bit integers; null and empty texts have none.

        Strings of added tokens inside a text become those tokens.
        """
        shared = self._shared

        @F.pandas_udf("binary")
        def run(texts: pd.Series) -> pd.Series:
            return texts.map(_encoder(shared.value), na_action=None)

        return run(text)

    def decode(self, ids: Column) -> Column:
        """The text whose arcs the ids name; bytes that are no UTF-8 become U+FFFD."""
        shared = self._shared

        @F.pandas_udf("string")
        def run(encoded: pd.Series) -> pd.Series:
            return encoded.map(_decoder(shared.value), na_action=None)

        return run(ids)


def _encoder(machine: Automaton):
    """Function from text to the bytes of its ids."""
    import re

    import regex

    split = regex.compile(PATTERN).findall
    is_plain, split_plain = re.compile(_PLAIN).fullmatch, re.compile(_PLAIN_PATTERN).findall
    stops = machine.special and regex.compile(
        "|".join(map(regex.escape, sorted(machine.special, key=len, reverse=True))))
    words = machine.words

    def plain(part: str) -> bytes:
        found = (split_plain if is_plain(part) else split)(part)
        if machine.kept > KEPT_BYTES:
            words.clear()
            machine.kept = 0
        for word in set(found).difference(words):
            ids = words[word] = np.array(machine.read(word.encode("utf-8", "surrogatepass")), "<u4").tobytes()
            machine.kept += 2 * len(word) + len(ids) + ENTRY_BYTES
        return b"".join(map(words.__getitem__, found))

    def one(content) -> bytes:
        if not content:
            return b""
        out, at = [], 0
        for hit in stops.finditer(content) if stops else ():
            out += [plain(content[at:hit.start()]), np.uint32(machine.special[hit[0]]).tobytes()]
            at = hit.end()
        return b"".join([*out, plain(content[at:])])

    return one


def _decoder(machine: Automaton):
    """Function from the bytes of ids to the text of their arc labels."""
    label = machine.labels.__getitem__
    return lambda ids: b"".join(map(label, np.frombuffer(ids or b"", "<u4").tolist())).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of a text column; a column named ``out`` is replaced.

    A row without text gets no ids, an empty table stays empty, every row is
    encoded for itself and whole.
    """
    return docs.withColumn(out, Bpe(docs.sparkSession, path).encode(F.col(text)))


#: rows whose ids and texts a task holds at a time
SLICE_ROWS = 256


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, the text that the ids decode to.

    Each text is encoded once; columns of these names are replaced.  Batches
    are worked off in slices, so a task holds the ids of a few rows only.
    """
    shared = Bpe(docs.sparkSession, path)._shared
    rest = [c for c in docs.columns if c not in ("ids", "decoded")]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.StringType())])

    place = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decode = _encoder(shared.value), _decoder(shared.value)
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                ids = [encode(t.as_py()) for t in part.column(place)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.binary()), pa.array(map(decode, ids), pa.string())],
                    names=[*rest, "ids", "decoded"])

    return docs.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(releasing(run), schema)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number and checksum of the ids, and checksum of what they decode to."""
    coded = round_trip(docs.select(key, text), path, text)
    return coded.select(
        key, F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
