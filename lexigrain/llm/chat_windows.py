r"""Chat formatting: conversations as training windows of a token budget.

A conversation is cut at turn ends into windows of at most ``budget`` tokens. Prefix sums of the turns' tokens give
the cuts by binary search. Every window after the first begins with the conversation's system
turn and with as many turns before the cut as ``history`` tokens and the budget allow; these are
repeated for context only. The loss mask covers the texts of assistant turns that are new in their window, so
every assistant text is a target exactly once.

The template marks turns with control strings. In texts and role names a backslash is doubled and one is put
after the first character of anything that reads like a control string, so texts never hold one,
and undoing both gives the text back. A line feed between marks and text keeps them from joining.

Conversations are cut into parts of ``PART_BYTES`` first, at places that the prefix sums of their
turns' bytes fix, and every part is formatted on its own (with the system turn and the last
turns of the part before as copies), so a conversation that holds a third of all rows is many tasks' work. One row
of output holds the windows of one part. No task holds more than one part.

Defined results: null role or text is empty; turns are ordered by turn number, null first, equal ones by role, then
by a hash of the text; equal rows are turns of their own; rows of a null ``conv_id`` form one
conversation; a turn larger than the budget is a window of its own (turns are never cut); an empty table gives an
empty table; further columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrain.llm.common import Batches, split_words, store
from lexigrain.llm.pieces import TOKENIZER_FILE, LibraryEncoder, library_encoder, tokenizer_path
from lexigrain.operators.ranking import prefix_sums

BUDGET, HISTORY = 2_048, 256
#: Bytes of turns that are formatted together, and from how far back in the part before history may come.
PART_BYTES, REACH_BYTES = 1 << 20, 1 << 16

#: Control strings of the template (fixed values).
BEGIN, END = "<s>", "</s>"
SYSTEM = ("<<SYS>>", "<</SYS>>")
USER = ("[INST]", "[/INST]")
ROLE = ("<<ROLE>>", "<</ROLE>>")
CONTROL = (BEGIN, END, *SYSTEM, *USER, *ROLE)

_control_start = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)).sub
_undo = re.compile(r"\\(\\?)").sub
_SYSTEM_COPY, _HISTORY_COPY, _OWN = 0, 1, 2

WINDOW = "text string, repeated int, tokens int, loss array<struct<start int, stop int>>"
PART_ROW = f"conv_id long, part long, alone boolean, windows array<struct<{WINDOW.replace(' string', ': string').replace(' int', ': int').replace('loss array', 'loss: array')}>>"
_LOSS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_WINDOW_TYPE = pa.struct([("text", pa.string()), ("repeated", pa.int32()), ("tokens", pa.int32()), ("loss", _LOSS_TYPE)])


# ---------------------------------------------------------------------------- template
def escape(text: str) -> str:
    return _control_start(lambda found: found[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _undo(r"\1", text) if "\\" in text else text


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template's marks, where its text begins in it, and the number of marks."""
    body = escape(text)
    if role == "system":
        open_, close, marks = f"{SYSTEM[0]}\n", f"\n{SYSTEM[1]}", 2
    elif role == "user":
        open_, close, marks = f"{USER[0]}\n", f"\n{USER[1]}", 2
    elif role == "assistant":
        open_, close, marks = "\n", f"\n{END}", 1
    else:
        open_, close, marks = f"{ROLE[0]}\n{escape(role)}\n{ROLE[1]}\n", f"\n{END}", 3
    return open_ + body + close, len(open_), marks


def parsed(window: str) -> Iterator[tuple[str, str]]:
    """The turns (role, text) of a window."""

    def until(mark: str) -> str:
        nonlocal at
        end = window.index("\n" + mark, at)
        text, at = window[at:end], end + 1 + len(mark)
        return unescape(text)

    at = len(BEGIN)
    while at < len(window):
        if window.startswith(SYSTEM[0], at):
            at += len(SYSTEM[0]) + 1
            yield "system", until(SYSTEM[1])
        elif window.startswith(USER[0], at):
            at += len(USER[0]) + 1
            yield "user", until(USER[1])
        elif window.startswith(ROLE[0], at):
            at += len(ROLE[0]) + 1
            role = until(ROLE[1])
            at += 1
            yield role, until(END)
        else:
            at += 1
            yield "assistant", until(END)


# ----------------------------------------------------------------------------- windows
@dataclass
class Turn:
    role: str
    text: str
    tokens: int


def token_cost(encoder: LibraryEncoder, role: str, text: str) -> int:
    """Tokens of a turn: those of its text, of an unusual role's name, and one for each mark."""
    named = 0 if role in ("system", "user", "assistant") else len(encoder.encode(split_words(role))) // 4
    return len(encoder.encode(split_words(text))) // 4 + named + rendered(role, "")[2]


def spans(costs: list[int], copies: int, system: int, first_is_system: bool, budget: int, history: int) -> list[tuple[int, int, int]]:
    """Windows (begin of history, first new turn, end) over turns of these costs.

    The first ``copies`` turns are history only. ``system`` is the cost of the system turn that later windows (all
    windows, where the turns begin after it) repeat.
    """
    sums = [0, *accumulate(costs)]
    out, first = [], copies
    while first < len(costs):
        at_start = first_is_system and first == 0
        room = budget - 1 - (0 if at_start else system)  # one for the mark that begins a window
        reach = min(history, room - costs[first])
        lowest = 1 if first_is_system and first else 0
        back = bisect_left(sums, sums[first] - reach, lowest, first) if reach > 0 else first
        end = max(first + 1, bisect_right(sums, sums[back] + room) - 1)
        out.append((back, first, end))
        first = end
    return out


@dataclass
class Part:
    """The turns of one part of a conversation."""

    conv_id: int | None
    part: int
    alone: bool
    system: Turn | None = None
    copies: int = 0
    own: int = 0
    turns: list[Turn] = field(default_factory=list)

    def add(self, kind: int, turn: Turn) -> None:
        if kind == _SYSTEM_COPY:
            self.system = self.system or turn
            return
        self.copies += kind == _HISTORY_COPY
        self.own += kind == _OWN
        self.turns.append(turn)

    def windows(self, budget: int, history: int) -> list[dict]:
        first_is_system = self.part == 0 and self.turns[0].role == "system"
        system = self.turns[0] if first_is_system else self.system
        cost = system.tokens if system else 0
        out = []
        for back, first, end in spans([turn.tokens for turn in self.turns], self.copies, cost, first_is_system, budget, history):
            lead = [system] if system and not (first_is_system and first == 0) else []
            lead += self.turns[back:first]
            pieces, loss, at = [BEGIN], [], len(BEGIN)
            for place, turn in enumerate([*lead, *self.turns[first:end]]):
                piece, start, _ = rendered(turn.role, turn.text)
                if place >= len(lead) and turn.role == "assistant" and turn.text:
                    loss.append({"start": at + start, "stop": at + len(piece) - len(END) - 1})
                pieces.append(piece)
                at += len(piece)
            tokens = 1 + sum(turn.tokens for turn in lead) + sum(turn.tokens for turn in self.turns[first:end])
            out.append({"text": "".join(pieces), "repeated": len(lead), "tokens": tokens, "loss": loss})
        return out


def dealt_parts(conversations: DataFrame, part_bytes: int = PART_BYTES, reach_bytes: int = REACH_BYTES) -> DataFrame:
    """``name, conv_id, part, alone, kind, turn, role, hash, text``: every turn in its part, and the copies a part needs."""
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("name"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.xxhash64(text).alias("hash"),
        text.alias("text"),
    )
    size = F.octet_length("role") + F.octet_length("text") + 1
    long = store(rows.groupBy("name").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > part_bytes).select("name"), "chat-long")
    own = ["name", "conv_id", "turn", "role", "hash", "text"]
    if long.isEmpty():
        return rows.select(*own, F.lit(0).cast("long").alias("part"), F.lit(True).alias("alone"), F.lit(_OWN).alias("kind"))
    # Of long conversations only places and sizes are summed up; equal rows share a place.
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "hash")
    sizes = rows.join(long, "name", "left_semi").groupBy("name", place.alias("place")).agg(F.sum(size).alias("bytes"))
    part = F.floor(F.col("before_bytes") / part_bytes).cast("long")
    # Turn numbers cut the ranges, the whole place orders the rows of one.
    turn_number = F.when(F.col("place.known"), F.col("place.turn").cast("double")).otherwise(float("-inf"))
    summed = prefix_sums(sizes.withColumn("number", turn_number), ["name"], ["bytes"], value="number", then=["place"])
    placed = summed.select("name", "place", "before_bytes", part.alias("part"))
    placed = store(placed, "chat-places")
    marked = rows.withColumn("place", place).join(placed, ["name", "place"], "left")
    every = marked.select(
        *own, F.coalesce("part", F.lit(0)).alias("part"), F.col("part").isNull().alias("alone"), F.lit(_OWN).alias("kind"),
        "before_bytes",
    )
    near_end = F.col("before_bytes") >= (F.col("part") + 1) * part_bytes - reach_bytes
    kinds = F.array(
        F.struct(F.col("part").alias("part"), F.col("kind").alias("kind")),
        F.when(near_end, F.struct((F.col("part") + 1).alias("part"), F.lit(_HISTORY_COPY).alias("kind"))),
    )
    each = every.select(*own, "alone", "before_bytes", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("to"))
    turns = each.select(*own, F.col("to.part").alias("part"), "alone", F.col("to.kind").alias("kind"))
    last = placed.groupBy("name").agg(F.max("part").alias("last")).where("last > 0")
    first_turns = marked.where((F.col("before_bytes") == 0) & (F.col("role") == "system")).join(last, "name")
    system = first_turns.select(
        *own, F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("part"), F.lit(False).alias("alone"), F.lit(_SYSTEM_COPY).alias("kind")
    )
    return turns.unionByName(system)


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    tokenizer: str = TOKENIZER_FILE,
    part_bytes: int = PART_BYTES,
    reach_bytes: int = REACH_BYTES,
    flush: int = 2_000_000,
) -> DataFrame:
    """``conv_id, part, alone, windows``: a row holds the windows of one part, ``alone`` if it is the whole conversation."""
    model = tokenizer_path(tokenizer)

    def batch_of(parts: list[Part]) -> pa.RecordBatch:
        columns = [
            pa.array([part.conv_id for part in parts], pa.int64()),
            pa.array([part.part for part in parts], pa.int64()),
            pa.array([part.alone for part in parts], pa.bool_()),
            pa.array([part.windows(budget, history) for part in parts], pa.list_(_WINDOW_TYPE)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "alone", "windows"])

    def run(batches: Batches) -> Batches:
        encoder = library_encoder(model)
        now, key, done, held = None, None, [], 0
        for batch in batches:
            for name, conv_id, part, alone, kind, role, text in zip(*[column.to_pylist() for column in batch.columns]):
                if (name, part) != key:
                    if now and now.own:  # copies for a part without turns of its own give no row
                        done.append(now)
                    if held >= flush:
                        yield batch_of(done)
                        done, held = [], 0
                    now, key = Part(conv_id, part, alone), (name, part)
                now.add(kind, Turn(role, text, token_cost(encoder, role, text)))
                held += len(text) + len(role) + 16
        if now and now.own:
            done.append(now)
        if done:
            yield batch_of(done)

    dealt = dealt_parts(conversations, part_bytes, reach_bytes).repartition("name", "part")
    ordered = dealt.sortWithinPartitions("name", "part", "kind", "turn", "role", "hash", "text")
    return ordered.select("name", "conv_id", "part", "alone", "kind", "role", "text").mapInArrow(run, PART_ROW)


def write_windows(conversations: DataFrame, path: str, **settings: int) -> None:
    format_windows(conversations, **settings).write.option("compression", "zstd").parquet(path)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PART_ROW).parquet(path)


def restored(windows: list[dict]) -> Iterator[tuple[str, str]]:
    """The turns of a part, each once, from the text of its windows."""
    for window in windows:
        for place, turn in enumerate(parsed(window["text"])):
            if place >= window["repeated"]:
                yield turn


class _Digest:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, windows: list[dict]) -> None:
        for role, text in restored(windows):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for window in windows:
            self.formatted_chars += len(window["text"])
            for span in window["loss"]:
                target = unescape(window["text"][span["start"] : span["stop"]])
                self.loss_chars += len(target)
                self.loss.update(target.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)


_DIGEST_ROW = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST_TYPE = pa.schema(
    [(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (part.split() for part in _DIGEST_ROW.split(", "))]
)


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation what its windows give back: turns, text under the loss mask, and formatted length.

    Where a row holds a whole conversation it is read where it lies; only parts of long ones are brought
    together, in order, and pass through a running hash.
    """

    def run(batches: Batches) -> Batches:
        now: _Digest | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                done = []
                columns = [column.to_pylist() for column in batch.slice(at, 256).columns]
                for conv_id, alone, windows in zip(*columns):
                    if now and (alone or conv_id != now.conv_id):
                        done.append(now.row())
                        now = None
                    now = now or _Digest(conv_id)
                    now.add(windows)
                    if alone:
                        done.append(now.row())
                        now = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind.type) for values, kind in zip(zip(*done) if done else [[]] * 6, _DIGEST_TYPE)],
                    schema=_DIGEST_TYPE,
                )
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([value], kind.type) for value, kind in zip(now.row(), _DIGEST_TYPE)], schema=_DIGEST_TYPE)

    whole = rows.where("alone").select("conv_id", "alone", "windows")
    parts = rows.where("NOT alone").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.mapInArrow(run, _DIGEST_ROW).unionByName(parts.select("conv_id", "alone", "windows").mapInArrow(run, _DIGEST_ROW))


def window_digests(conversations: DataFrame, path: str, **settings: int) -> DataFrame:
    """Write the windows to ``path``, read them back, and return what they hold."""
    write_windows(conversations, path, **settings)
    return digests(read_windows(conversations.sparkSession, path))
