r"""Conversations as training windows with a loss mask.

The template of a turn is

    <|ROLE|> newline TEXT <|end|> newline

where the bar of every mark is a control character: inside roles and texts a backslash is
written ``\\`` and a bar ``\p``, so that no text can open or close a turn, and reading undoes it.

Turns of a conversation stand by ``turn`` (nulls first, then role, then text). Prefix sums of
their tokens choose windows of at most ``budget`` tokens that begin and end with whole turns.
Every window after the first repeats the system turn that opens the conversation, and as many
whole turns before it as ``history`` tokens hold, fewer where the next turn needs the room. The
mask covers the texts of assistant turns where they are new, so each text counts once however
often it is repeated. A turn that is longer than the budget stands alone behind the system turn
(``over_budget``); no text is cut.

A conversation is dealt by itself, a very long one in chapters of ``chapter_turns`` turn numbers,
each in any task: windows start afresh with a chapter, behind the system turn. A task streams
through its turns in order and holds one window. Reading back digests every conversation in
order; those of one window where they stand, the others streamed in one task each, since a digest
of a whole conversation has to be made in sequence.

Defined results: a null text or role counts as empty; rows without ``conv_id`` are one
conversation; repeated rows are turns of their own; conversations without assistant turns have an
empty mask; an empty table gives no windows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from effortlens.llm.storage import written

BUDGET = 2048
HISTORY = 256
CHAPTER_TURNS = 4096
MARK_TOKENS = 4
BATCH_BYTES = 1 << 20

_END = "<|end|>\n"
_PLAIN = {"\\\\": "\\", "\\p": "|"}
_SPAN = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)


def word_tokens(text: Column) -> Column:
    """Runs of letters and digits, and other characters that are not blank, one by one."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")).cast("long")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("|", "\\p")


def unescape(text: str) -> str:
    return re.sub(r"\\.", lambda m: _PLAIN[m[0]], text) if "\\" in text else text


def turns_in(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    at = 0
    while at < len(text):
        head = text.index("|>\n", at)
        end = text.index(_END, head + 3)
        if text[at : at + 2] != "<|":
            raise ValueError("not a window of this template")
        yield unescape(text[at + 2 : head]), unescape(text[head + 3 : end])
        at = end + len(_END)


@dataclass
class _Turn:
    role: str
    head: str
    body: str
    tokens: int
    upto: int  # tokens of the chapter up to the end of this turn


@dataclass
class _Windows:
    """Windows of one chapter, filled turn by turn."""

    budget: int
    history: int
    system: _Turn | None = None
    recent: deque = field(default_factory=deque)  # turns that a next window may repeat
    repeated: list = field(default_factory=list)
    fresh: list = field(default_factory=list)
    before: int = 0  # tokens of the chapter before the window
    made: int = 0

    def add(self, turn: _Turn, opens: bool) -> Iterator[tuple]:
        """Take a turn; the window that it no longer fits into comes out."""
        if self.fresh and self._repeats() + turn.upto - self.before > self.budget:
            yield self.close(last=False)
        if not self.fresh:
            self._open(turn)
        self.fresh.append(turn)
        if opens and turn.role == "system":
            self.system = turn
            return
        self.recent.append(turn)
        while self.recent and turn.upto - self.recent[0].upto + self.recent[0].tokens > self.history:
            self.recent.popleft()

    def _repeats(self) -> int:
        return sum(t.tokens for t in self.repeated)

    def _open(self, turn: _Turn) -> None:
        self.before = turn.upto - turn.tokens
        self.repeated = [self.system] if self.system else []
        room = self.budget - self._repeats() - turn.tokens
        back: list[_Turn] = []
        for old in reversed(self.recent):
            room -= old.tokens
            if room < 0:
                break
            back.append(old)
        self.repeated += reversed(back)

    def close(self, last: bool) -> tuple:
        parts, spans, at = [], [], 0
        for place, turn in enumerate([*self.repeated, *self.fresh]):
            start = at + len(turn.head)
            at = start + len(turn.body) + len(_END)
            parts += [turn.head, turn.body, _END]
            if place >= len(self.repeated) and turn.role == "assistant":
                spans.append({"start": start, "end": start + len(turn.body)})
        tokens = self._repeats() + self.fresh[-1].upto - self.before
        out = (
            self.made,
            "".join(parts),
            spans,
            len(self.repeated),
            tokens,
            tokens > self.budget,
            last and not self.made,
        )
        self.made += 1
        self.fresh = []
        return out


def _batches(rows: Iterator[tuple], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of about ``BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    tokens: Callable[[Column], Column] = word_tokens,
    chapter_turns: int = CHAPTER_TURNS,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id, chapter, window, text, loss, n_repeated, n_tokens, over_budget, whole``.

    ``loss`` lists the spans (code points, end exclusive) of ``text`` that are learnt;
    ``n_repeated`` turns at the head are repeated ones; ``whole`` marks windows that hold a
    whole conversation. ``tokens`` counts a text's tokens; marks count ``MARK_TOKENS`` a turn.
    """
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    number = F.expr(f"turn div {int(chapter_turns)}")
    rows = rows.withColumn("chapter", F.coalesce(number, F.lit(-(1 << 62)).cast("long")))
    bounds = rows.groupBy("conv_id").agg(
        F.min("chapter").alias("first"), F.max("chapter").alias("last")
    )
    # Only conversations of several chapters are told to the others.
    several = written(bounds.filter("first < last").select("conv_id", "first"), "long-conversations")
    long_ones = several.withColumnRenamed("conv_id", "long_id")
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    parts = rows.join(long_ones, same, "inner").drop("long_id")
    heads = (
        parts.filter("chapter = first")
        .groupBy("conv_id")
        .agg(F.min(F.struct("turn", "role", "text")).alias("h"))
        .filter("h.role = 'system'")
        .select(F.col("conv_id").alias("long_id"), "h.*")
    )
    later = parts.filter("chapter > first").select("conv_id", "chapter").distinct()
    leads = later.join(heads, same, "inner").select(
        "conv_id", "chapter", "turn", "role", "text", F.lit(True).alias("lead"),
        F.lit(False).alias("opens"), F.lit(False).alias("alone"),
    )
    own = rows.join(long_ones, same, "left").select(
        "conv_id", "chapter", "turn", "role", "text", F.lit(False).alias("lead"),
        (F.col("first").isNull() | (F.col("chapter") == F.col("first"))).alias("opens"),
        F.col("first").isNull().alias("alone"),
    )
    order = [F.col("lead").desc(), "turn", "role", "text"]
    sums = Window.partitionBy("conv_id", "chapter").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    counted = own.unionByName(leads).withColumn(
        "tokens", F.coalesce(tokens(F.col("text")), F.lit(0)).cast("long") + MARK_TOKENS
    )
    summed = counted.withColumn("upto", F.sum("tokens").over(sums))
    summed = summed.sortWithinPartitions("conv_id", "chapter", *order)

    result = T.StructType(
        [
            T.StructField("conv_id", rows.schema["conv_id"].dataType),
            T.StructField("chapter", T.LongType()),
            T.StructField("window", T.IntegerType()),
            T.StructField("text", T.StringType()),
            T.StructField("loss", _SPAN),
            T.StructField("n_repeated", T.IntegerType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_budget", T.BooleanType()),
            T.StructField("whole", T.BooleanType()),
        ]
    )
    names = ("conv_id", "chapter", "role", "text", "lead", "opens", "alone", "tokens", "upto")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, now, alone = None, None, False
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            for conv, chapter, who, said, lead, opens, single, size, upto in zip(*columns, strict=True):
                first = key != (conv, chapter)
                if first:
                    if now and now.fresh:
                        yield *key, *_flagged(now.close(last=True), alone)
                    key, now, alone = (conv, chapter), _Windows(budget, history), single
                one = _Turn(who, f"<|{escape(who)}|>\n", escape(said), size, upto)
                if lead:
                    now.system = one
                    continue
                for window in now.add(one, opens and first):
                    yield *key, *_flagged(window, alone)
        if now and now.fresh:
            yield *key, *_flagged(now.close(last=True), alone)

    schema = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(windows(batches), schema, lambda row: len(row[3]))

    return summed.mapInArrow(run, result)


def _flagged(window: tuple, alone: bool) -> tuple:
    return *window[:-1], window[-1] and alone


class _Reading:
    """Digests of one conversation, window by window."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def take(self, text: str, loss: list[dict], n_repeated: int) -> None:
        for place, (role, said) in enumerate(turns_in(text)):
            if place >= n_repeated:
                self.n_turns += 1
                self.turns.update(f"{role}\n{said}\n".encode())
        for span in loss:
            learnt = unescape(text[span["start"] : span["end"]])
            self.loss_chars += len(learnt)
            self.loss.update(learnt.encode())
        self.chars += len(text)

    def row(self) -> tuple:
        found = self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest()
        return self.n_turns, *found, self.chars


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows of every conversation hold, parsed out of their texts.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    key = windows.schema["conv_id"]
    digests = [
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
    whole = T.StructType([key, *digests])
    rest = [T.StructField(n, windows.schema[n].dataType) for n in ("chapter", "window", "text", "loss", "n_repeated")]
    mixed = T.StructType([*whole, *rest])

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for w in batch.to_pylist():
                if w["whole"]:
                    reading = _Reading()
                    reading.take(w["text"], w["loss"], w["n_repeated"])
                    yield w["conv_id"], *reading.row(), *[None] * len(rest)
                else:
                    yield w["conv_id"], *[None] * len(digests), *[w[f.name] for f in rest]

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, reading = None, None
        for batch in batches:
            for w in batch.to_pylist():
                if reading is None or w["conv_id"] != current:
                    if reading is not None:
                        yield current, *reading.row()
                    current, reading = w["conv_id"], _Reading()
                reading.take(w["text"], w["loss"], w["n_repeated"])
        if reading is not None:
            yield current, *reading.row()

    def over(rows, fields: T.StructType):
        schema = to_arrow_schema(fields)

        def size(row: tuple) -> int:
            return 200 + sum(len(v) for v in row if isinstance(v, str))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _batches(rows(batches), schema, size)

        return run

    done = written(windows.mapInArrow(over(first_pass, mixed), mixed), "read-windows")
    parts = done.filter("n_turns is null").select("conv_id", *[f.name for f in rest])
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "chapter", "window")
    long_ones = ordered.mapInArrow(over(second_pass, whole), whole)
    return done.filter("n_turns is not null").select(*whole.names).unionByName(long_ones)
