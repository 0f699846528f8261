"""Chat formatting by a finite-state machine over roles and a declarative template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What marks a turn, what may follow what, and which roles carry loss.

    A formatted turn is ``opening + role + between + text + closing``.
    ``codes`` replace control strings inside roles and texts by a backslash and
    one letter, so that no marker can occur there; a backslash is doubled.
    """

    opening: str = "### "
    between: str = ": "
    closing: str = "</turn>\n"
    codes: dict[str, str] = field(default_factory=lambda: {"###": "h", "</turn>": "t"})
    role_codes: dict[str, str] = field(default_factory=lambda: {":": "c"})
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state (the role before; empty at the start) -> roles that may come
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)

    def escaped(self, text: Column, role: bool = False) -> Column:
        """Reversible form of a text without control strings; null becomes empty."""
        out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
        for control, code in {**self.codes, **(self.role_codes if role else {})}.items():
            out = F.replace(out, F.lit(control), F.lit("\\" + code))
        return out

    def plain(self, text: str) -> str:
        """Undo :meth:`escaped`."""
        back = {code: control for control, code in {**self.codes, **self.role_codes}.items()}
        return re.sub(r"\\(.)", lambda m: back.get(m[1], m[1]), text, flags=re.S)

    def turns(self, formatted: str) -> list[tuple[str, str]]:
        """Roles and texts read back from a formatted conversation."""
        pattern = re.compile(
            re.escape(self.opening) + "(.*?)" + re.escape(self.between) + "(.*?)" + re.escape(self.closing), re.S
        )
        out, at = [], 0
        while at < len(formatted):
            found = pattern.match(formatted, at)
            if not found:
                raise ValueError(f"no turn at {at}")
            out.append((self.plain(found[1]), self.plain(found[2])))
            at = found.end()
        return out


def segments(conversations: DataFrame, template: Template) -> DataFrame:
    """Text segments of every turn, with loss flag, place and the machine's verdict.

    Columns: conv_id, turn_no (from 0), part (0 head, 1 text, 2 tail), segment,
    loss, start (code points before it), allowed (the move from the role before
    is one of the template's), role.  Rows of a conversation go by turn, nulls
    first, ties by role and text; null roles and texts count as empty; rows
    with a null conversation form one conversation.  Turns out of order are
    formatted all the same and flagged.  Windows, no collected groups: a
    conversation of any length passes as a sorted stream.
    """
    turns = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = conversations.select("conv_id", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    move = F.lit(False)
    for state, roles in template.moves.items():
        move = move | ((F.col("__before") == state) & F.col("role").isin(*roles))
    numbered = (
        rows.withColumn("turn_no", (F.row_number().over(turns) - 1).cast("long"))
        .withColumn("__before", F.coalesce(F.lag("role").over(turns), F.lit("")))
        .withColumn("allowed", move)
        .withColumn("__head", F.concat(F.lit(template.opening), template.escaped(F.col("role"), role=True),
                                       F.lit(template.between)))
        .withColumn("__body", template.escaped(F.col("text")))
        .withColumn("__size", F.length("__head") + F.length("__body") + F.lit(len(template.closing)))
        .withColumn("__from", F.coalesce(
            F.sum("__size").over(turns.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    )
    head, body = F.length("__head"), F.length("__body")
    parts = F.array(
        F.struct(F.lit(0).alias("part"), F.col("__head").alias("segment"), F.lit(False).alias("loss"),
                 F.col("__from").alias("start")),
        F.struct(F.lit(1).alias("part"), F.col("__body").alias("segment"),
                 F.col("role").isin(*template.loss_roles).alias("loss"), (F.col("__from") + head).alias("start")),
        F.struct(F.lit(2).alias("part"), F.lit(template.closing).alias("segment"), F.lit(False).alias("loss"),
                 (F.col("__from") + head + body).alias("start")),
    )
    return numbered.select("conv_id", "turn_no", "role", "allowed", F.inline(parts))


def assembled(parts: DataFrame, template: Template) -> DataFrame:
    """One row per conversation: formatted text, loss spans, verdict.

    For conversations that fit into one value; longer ones stay :func:`segments`.
    ``loss_spans`` are half-open ranges of code points, in order.  ``valid``:
    every move was allowed and the last role may end a conversation.
    """
    listed = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn_no", "part", "segment"))).alias("__parts"),
        F.sort_array(F.collect_list(
            F.when(F.col("loss"), F.struct("start", (F.col("start") + F.length("segment")).alias("stop")))
        )).alias("loss_spans"),
        F.bool_and("allowed").alias("__allowed"), F.max_by("role", "turn_no").alias("__last"),
    )
    return listed.select(
        "conv_id", F.array_join(F.col("__parts.segment"), "").alias("formatted"), "loss_spans",
        (F.col("__allowed") & F.col("__last").isin(*template.final)).alias("valid"),
    )


def format_chats(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Formatted conversations; see :func:`segments` for the defined cases.

    An empty table gives no rows; other columns are not read.
    """
    template = template or Template()
    return assembled(segments(conversations, template), template)


_DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of what a reader gets back from the formatted text and its loss spans.

    Of assembled conversations; :func:`stream_digests` gives the same for any length.
    """
    template = template or Template()

    @F.pandas_udf(_DIGEST)
    def read(formatted: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, ranges in zip(formatted, spans, strict=True):
            turns = template.turns(text)
            said = "".join(f"{role}\n{content}\n" for role, content in turns)
            loss = "".join(template.plain(text[r["start"]:r["stop"]]) for r in ranges)
            out.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return chats.select("conv_id", read("formatted", "loss_spans").alias("__d"), "valid").select(
        "conv_id", "__d.*", "valid"
    )


class _Reader:
    """What a reader of one conversation's segments, in order, has seen so far."""

    def __init__(self, template: Template):
        self.template, self.turn, self.role = template, [], ""
        self.n_turns = self.chars = self.loss_chars = 0
        self.said, self.loss, self.allowed = hashlib.sha256(), hashlib.sha256(), True

    def add(self, part: int, segment: str, loss: bool, start: int, allowed: bool, role: str) -> None:
        if start != self.chars or part != len(self.turn):
            raise ValueError(f"segment out of place at {start}")
        self.chars += len(segment)
        self.turn.append(segment)
        if loss:
            text = self.template.plain(segment)
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        if part == 2:
            ((name, content),) = self.template.turns("".join(self.turn))
            self.said.update(f"{name}\n{content}\n".encode())
            self.n_turns, self.turn = self.n_turns + 1, []
            self.allowed, self.role = self.allowed and allowed, role

    def result(self) -> tuple:
        return (self.n_turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.allowed and self.role in self.template.final)


def stream_digests(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """The digests of :func:`digests`, for conversations of any length.

    The segments stay rows, sorted by conversation and place; a task keeps
    running checksums and one turn at a time.
    """
    template = template or Template()
    columns = ("part", "segment", "loss", "start", "allowed", "role")
    names = [f.split()[0] for f in _DIGEST.split(", ")] + ["valid"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now, kind = None, None, None

        def told(rows: list[tuple]) -> pa.RecordBatch:
            found = [pa.array([r[i + 1] for r in rows], t) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), *found], names=["conv_id", *names])

        for batch in batches:
            done, kind = [], batch.schema.field("conv_id").type
            taken = [batch[c] for c in columns]
            for i, conv in enumerate(batch["conv_id"].to_pylist()):
                if reader is None or conv != now:
                    if reader is not None:
                        done.append((now, *reader.result()))
                    reader, now = _Reader(template), conv
                reader.add(*[c[i].as_py() for c in taken])
            if done:
                yield told(done)
        if reader is not None:
            yield told([(now, *reader.result())])

    parts = segments(conversations, template)
    schema = f"conv_id {parts.schema['conv_id'].dataType.simpleString()}, {_DIGEST}, valid boolean"
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no", "part")
    return ordered.select("conv_id", *columns).mapInArrow(run, schema)
