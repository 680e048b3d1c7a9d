"""Conversations as budgeted training windows with a loss mask.

A turn is ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a
line feed.  Prefix sums of the turns' tokens choose the spans: a window holds
as many whole new turns as its budget takes, after the conversation's system
turn and a limited number of the turns before them, which are repeated and
masked.  The prefix sums are made over range partitions, and long
conversations are cut into segments by them, so that no task ever holds a whole
conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propmart.llm.common import pieces, sorted_groups, written
from propmart.llm.tokens import encoder

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LEARNED, SYSTEM = "assistant", "system"
BUDGET = 1024  # tokens of a window
HISTORY = 256  # tokens of repeated turns in a window, without the system turn
SEGMENT = 64  # budgets per segment of a conversation


def escape(text: str) -> str:
    """The text without any ``<|``: one backslash more after ``<`` wherever a bar follows."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def format_turn(role: str, text: str) -> str:
    return f"{OPEN}{_role_line(role)}\n{escape(text)}{CLOSE}"


def parse_turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns of a window; the places are those of the text as it is written there."""
    out, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(CLOSE, line)
        out.append((_role_of(formatted[at + len(OPEN) : line]), unescape(formatted[line + 1 : end]), line + 1, end))
        at = end + len(CLOSE)
    return out


def span(start: np.ndarray, size: np.ndarray, at: int, room: int, history: int) -> tuple[int, int]:
    """(first repeated turn, end) of the window whose first new turn is ``at``.

    ``start`` are the prefix sums of the turns and ``size`` their tokens.  The
    window takes whole turns up to ``room`` tokens, one new turn at least;
    turns before ``at`` are repeated, up to ``history`` tokens, only as far as
    the first new one still fits.
    """
    again = max(0, min(history, room - int(size[at])))
    low = int(np.searchsorted(start[: at + 1], start[at] - again))
    end = at + int(np.searchsorted(start[at:] + size[at:], start[low] + room, side="right"))
    return low, max(end, at + 1)


TURNS = "part int, conv_id long, at long, n long, role string, text string"


def turn_tokens(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """The turns in range partitions, with their tokens and the sum of those before within the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer)
        last, total = None, 0
        for batch in pieces(batches, "text"):
            ids, roles, texts = (batch.column(i).to_pylist() for i in range(3))
            formatted = [format_turn(r, t) for r, t in zip(roles, texts, strict=True)]
            if len(formatted) == 1:  # perhaps a very long one
                n = np.array([sum(len(made.encode([p])[0]) for p in made.parts(formatted[0]))])
            else:
                n = made.encode(formatted)[1]
            at = []
            for key, size in zip(ids, n.tolist(), strict=True):
                total = 0 if last != (key,) else total
                last = (key,)
                at.append(total)
                total += size
            part = pa.array(np.full(len(ids), TaskContext.get().partitionId(), np.int32))
            columns = [part, batch.column(0), pa.array(at, pa.int64()), pa.array(n.astype(np.int64)), batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in TURNS.split(", ")])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"), F.col("turn").cast("long").alias("turn"))
    rows = rows.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256)).withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha"), F.col("copy")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    return written(dealt.mapInArrow(run, TURNS), "chat-turns")


def prefix_sums(turns: DataFrame) -> DataFrame:
    """``turns`` with ``start``, the tokens of all earlier turns of the conversation.

    Only the first conversation of a partition can have begun before it, so
    what is carried over is a row per partition at most.
    """
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = turns.groupBy("part", "conv_id").agg(F.sum("n").alias("n"))
    carried = sums.select(F.col("part").alias("p"), F.col("conv_id").alias("c"), F.sum("n").over(before).alias("before")).where("before IS NOT NULL")
    joined = turns.join(F.broadcast(carried), (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return joined.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("start"), "n", "role", "text")


WINDOWS = "conv_id long, first long, formatted string, n_repeated int, n_new int, loss array<struct<low:long,high:long>>"
_LOSS = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))


def make_windows(conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT) -> DataFrame:
    """The windows of all conversations.

    Columns conv_id, first (tokens of the conversation before the first new
    turn, which orders its windows), formatted, n_repeated (turns in front
    that other windows also hold), n_new, and loss (places in ``formatted``
    of the new assistant texts, in code points).

    Turns are ordered by ``turn`` (null first), then role, then the SHA-256 of
    the text; repeated rows are turns of their own.  A null text or role is
    empty, a null conv_id is a conversation.  The first turn is retained in
    every window if its role is ``system``.  A turn is never cut: one that
    exceeds the budget has a window without repeated turns.  Windows end at
    each ``segment`` budgets of tokens, where the next one repeats as much as
    elsewhere.  Other columns are not read; an empty table gives no window.
    """
    long = budget * segment
    if not 0 <= history < long:
        raise ValueError("the history must be shorter than a segment")
    rows = written(prefix_sums(turn_tokens(conversations, tokenizer)), "chat-prefix")
    seg = lambda tokens: F.floor(tokens / F.lit(long))
    own = seg(F.col("start"))
    later = F.when(F.col("n") <= history, F.sequence(seg(F.col("start") + F.col("n")), F.greatest(seg(F.col("start") + F.lit(history)), seg(F.col("start") + F.col("n")))))
    to = F.array_union(F.array(own), F.coalesce(later, F.array(own)))
    dealt = rows.withColumn("own", own).withColumn("seg", F.explode(to))
    dealt = dealt.select(F.col("conv_id").isNull().alias("absent"), "conv_id", "seg", (F.col("own") == F.col("seg")).alias("own"), "start", "n", "role", "text")
    system = rows.where((F.col("start") == 0) & (F.col("role") == SYSTEM)).select(F.col("conv_id").alias("c"), "n", "role", "text")
    parts = rows.where(own > 0).select("conv_id", own.alias("seg")).distinct()
    copies = parts.join(system, F.col("conv_id").eqNullSafe(F.col("c")))
    copies = copies.select(F.col("conv_id").isNull().alias("absent"), "conv_id", "seg", F.lit(False).alias("own"), F.lit(-1).cast("long").alias("start"), "n", "role", "text")
    dealt = dealt.where("own OR start > 0 OR role <> 'system'").union(copies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            is_own = np.asarray(group.column("own"), bool)
            if not is_own.any():
                continue
            start, size = (np.asarray(group.column(c), np.int64) for c in ("start", "n"))
            roles, texts = group.column("role").to_pylist(), group.column("text").to_pylist()
            system = roles[0] == SYSTEM and start[0] <= 0
            out: list[list] = [[] for _ in range(6)]
            conv = None if group.column("absent")[0].as_py() else group.column("conv")[0].as_py()
            for window in _windows(start, size, roles, texts, int(np.argmax(is_own)), system, budget, history):
                for column, value in zip(out, (conv, *window), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), _LOSS)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["conv_id", "first", "formatted", "n_repeated", "n_new", "loss"])

    keyed = dealt.select("absent", F.coalesce("conv_id", F.lit(0)).alias("conv"), "seg", "own", "start", "n", "role", "text")
    keyed = keyed.repartition("absent", "conv", "seg").sortWithinPartitions("absent", "conv", "seg", "start")
    return keyed.mapInArrow(run, WINDOWS)


def _windows(start: np.ndarray, size: np.ndarray, roles: Sequence[str], texts: Sequence[str], at: int, system: bool, budget: int, history: int) -> Iterator[tuple]:
    """The windows of one segment, whose new turns begin at ``at``; the first turn is the retained one if ``system``."""
    formatted = [format_turn(r, t) for r, t in zip(roles, texts, strict=True)]
    while at < len(formatted):
        skip = int(system and at > 0)  # what may be repeated lies after the system turn
        low, end = span(start[skip:], size[skip:], at - skip, budget - skip * int(size[0]), history)
        again = [*range(skip), *range(low + skip, at)]
        new = range(at, end + skip)
        place, loss = sum(len(formatted[i]) for i in again), []
        for i in new:
            if roles[i] == LEARNED:
                head = len(OPEN) + len(_role_line(roles[i])) + 1
                loss.append({"low": place + head, "high": place + len(formatted[i]) - len(CLOSE)})
            place += len(formatted[i])
        yield int(start[at]), "".join(formatted[i] for i in [*again, *new]), len(again), len(new), loss
        at = end + skip


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_windows(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: its turns, the text under the mask, and their digests.

    The windows are taken apart where they lie; a conversation's digests then
    run over its windows in order, one window at a time.
    """

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "formatted"):
            out: list[list] = [[] for _ in range(5)]
            for text, repeated, loss in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)), strict=True):
                turns = parse_turns(text)[repeated:]
                learned = [unescape(text[x["low"] : x["high"]]) for x in loss]
                values = (len(turns), "".join(f"{role}\n{said}\n" for role, said, _, _ in turns), "".join(learned), sum(map(len, learned)), len(text))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = [*batch.columns[:3], *(pa.array(c, t) for c, t in zip(out, types, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=["absent", "conv", "first", "n_turns", "turns", "learned", "loss_chars", "formatted_chars"])

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums, shas = None, [0, 0, 0], []

        def row() -> list:
            return [None if key[0] else key[1], sums[0], shas[0].hexdigest(), sums[1], shas[1].hexdigest(), sums[2]]

        for batch in batches:
            done = []
            for absent, conv, _, n, turns, learned, chars, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (absent, conv):
                    if key is not None:
                        done.append(row())
                    key, sums, shas = (absent, conv), [0, 0, 0], [hashlib.sha256(), hashlib.sha256()]
                for i, x in enumerate((n, chars, size)):
                    sums[i] += x
                shas[0].update(turns.encode())
                shas[1].update(learned.encode())
            if done:
                yield _digest_batch(done)
        if key is not None:
            yield _digest_batch([row()])

    parts = "absent boolean, conv long, first long, n_turns long, turns string, learned string, loss_chars long, formatted_chars long"
    keyed = windows.select(F.col("conv_id").isNull().alias("absent"), F.coalesce("conv_id", F.lit(0)).alias("conv"), "first", "formatted", "n_repeated", "loss")
    apart = keyed.mapInArrow(take_apart, parts)
    return apart.repartition("absent", "conv").sortWithinPartitions("absent", "conv", "first").mapInArrow(join_up, DIGESTS)


def _digest_batch(rows: list[list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [f.split()[0] for f in DIGESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def format_and_read(conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT) -> DataFrame:
    """Write the windows of all conversations into the shared folder and read the turns back from them."""
    return read_windows(written(make_windows(conversations, tokenizer, budget, history, segment), "chat-windows"))
