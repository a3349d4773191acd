"""Chat formatting by columnar byte assembly, and reading the format back.

The turns of a batch are laid out at once: segment lengths, their running sums and
one scatter per kind of byte fill a single preallocated buffer, which becomes the
Arrow column as it is.

Control strings start with `[` or `<`, and a role's name ends before `|`. Inside
texts these characters and the backslash get a backslash in front, so no text can
look like a control string and every text can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices_by_bytes

# What stands before and after a turn's text, by role. What stands after
# starts with a character that texts escape, so a text ends at the first such character.
BEGIN = "<s>"
MARKS = {
    "user": ("[INST] ", "[/INST]"),
    "assistant": (" ", "</s>"),
    "system": ("<<SYS>>\n", "<</SYS>>\n"),
}
OTHER_MARKS = ("<|role {}|>\n", "<|end|>")
LEARNED_ROLE = "assistant"

PIECE_BYTES = 4 << 20  # a conversation of more text comes in several pieces

_ESCAPED = np.zeros(256, dtype=bool)
_ESCAPED[list(b"\\[<|")] = True
_BODY = r"((?:[^\\\[<|]++|\\.)*+)"
_turn = re.compile(
    rf"(?:<s>)?+(?:\[INST\] {_BODY}\[/INST\]|<<SYS>>\n{_BODY}<</SYS>>\n|<\|role {_BODY}\|>\n{_BODY}<\|end\|>| {_BODY}</s>)",
    re.DOTALL,
)
_escape = re.compile(r"[\\\[<|]")
_unescape = re.compile(r"\\(.)", re.DOTALL)

_span = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def unescape(text: str) -> str:
    return _unescape.sub(r"\1", text) if "\\" in text else text


def _marks(role: str) -> tuple[bytes, bytes]:
    if role in MARKS:
        return tuple(mark.encode() for mark in MARKS[role])
    before, after = OTHER_MARKS
    return before.format(_escape.sub(r"\\\g<0>", role)).encode(), after.encode()


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and where each value starts (and the last ends)."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    source = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return source[ends[0] : ends[-1]], ends - ends[0]


def assemble(roles: list[str], texts: pa.Array, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns, where each turn starts, and each text's span in them.

    opens: turns that begin a conversation.
    """
    source, starts = _bytes_of(texts)
    special = _ESCAPED[source]
    seen = np.concatenate([[0], np.cumsum(special)])
    body = np.diff(starts) + np.diff(seen[starts])
    kinds, kind = np.unique(np.array([f"{int(o)}{r}" for o, r in zip(opens, roles)], dtype=object), return_inverse=True)
    marks = [(BEGIN.encode() * (k[0] == "1") + _marks(k[1:])[0], _marks(k[1:])[1]) for k in kinds]
    before = np.array([len(b) for b, _ in marks], dtype=np.int64)[kind]
    after = np.array([len(a) for _, a in marks], dtype=np.int64)[kind]
    ends = np.cumsum(before + body + after)
    turn_at = np.concatenate([[0], ends])
    text_at = turn_at[:-1] + before
    out = np.empty(int(turn_at[-1]), np.uint8)
    shift = np.repeat(text_at - starts[:-1] - seen[starts[:-1]], np.diff(starts))
    place = shift + np.arange(len(source)) + seen[1:]
    out[place] = source
    out[place[special] - 1] = ord("\\")
    for k, (b, a) in enumerate(marks):
        rows = np.flatnonzero(kind == k)
        out[turn_at[rows][:, None] + np.arange(len(b))] = np.frombuffer(b, np.uint8)
        out[(ends[rows] - len(a))[:, None] + np.arange(len(a))] = np.frombuffer(a, np.uint8)
    return out, turn_at, np.stack([text_at, text_at + body], axis=1)


def format_conversations(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """`conv_id, piece, n_turns, formatted, loss`, a row per conversation.

    `loss` holds the byte spans of `formatted` that are an assistant's words. Turns
    go by number, then role, then text, nulls first; repeated rows are turns of
    their own. Null roles and texts count as empty, and a null `conv_id` is a
    conversation like another. Only a conversation of more than PIECE_BYTES gets
    several rows, which follow each other in its partition.
    """
    frame = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, piece, waiting = None, 0, None  # last: the conversation that has pieces already

        def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal last, piece
            ids = batch.column(0).to_pylist()
            news = np.array([i == 0 or a != ids[i - 1] for i, a in enumerate(ids)])
            opens = news.copy()
            opens[0] = last is None or last[0] != ids[0]
            roles = batch.column(2).to_pylist()
            out, turn_at, spans = assemble(roles, batch.column(3), opens)
            first = np.flatnonzero(news)
            numbers = []
            for i in first:
                piece = 0 if opens[i] else piece + 1
                numbers.append(piece)
            last = (ids[-1],)
            edges = np.append(first, len(ids))
            learned = np.array([r == LEARNED_ROLE for r in roles])
            at = turn_at[edges]
            loss = [
                [{"start": int(s - at[k]), "end": int(e - at[k])} for s, e in spans[a:b][learned[a:b]]]
                for k, (a, b) in enumerate(zip(edges, edges[1:]))
            ]
            column = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(out))
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(first)), pa.array(numbers, pa.int32()), pa.array(np.diff(edges), pa.int64()), column.cast(pa.string()), pa.array(loss, pa.list_(_span))],
                names=["conv_id", "piece", "n_turns", "formatted", "loss"],
            )

        for batch in slices_by_bytes(batches, "text", PIECE_BYTES):
            if waiting is not None:
                joined = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()
                batch = joined[0]
            ids = batch.column(0).to_pylist()
            open_from = len(ids) - 1
            while open_from and ids[open_from - 1] == ids[-1]:
                open_from -= 1
            tail = batch.slice(open_from)
            if tail.column(3).nbytes > PIECE_BYTES:
                open_from, tail = batch.num_rows, None
            if open_from:
                yield pieces(batch.slice(0, open_from))
            waiting = tail
        if waiting is not None:
            yield pieces(waiting)

    kind = frame.schema["conv_id"].dataType.simpleString()
    ordered = frame.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(
        formatted,
        f"conv_id {kind}, piece int, n_turns long, formatted string, loss array<struct<start:bigint,end:bigint>>",
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """`(role, text)` of each turn; anything that isn't the format is an error."""
    turns, at = [], 0
    while at < len(formatted):
        m = _turn.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        user, system, role, other, assistant = m.groups()
        if user is not None:
            turns.append(("user", unescape(user)))
        elif system is not None:
            turns.append(("system", unescape(system)))
        elif role is not None:
            turns.append((unescape(role), unescape(other)))
        else:
            turns.append(("assistant", unescape(assistant)))
        at = m.end()
    return turns


def read_back(pieces: DataFrame) -> DataFrame:
    """A row per conversation: `conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`.

    Reads the rows of `format_conversations` as they lie, so it needs no exchange.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        done: list[tuple] = []
        now: list | None = None  # identifier, turns, hash, loss characters, hash, characters

        def close() -> None:
            if now is not None:
                done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        for batch in batches:
            for conv, piece, formatted, loss in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4))):
                if piece == 0:
                    close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = parse(formatted)
                now[1] += len(turns)
                now[2].update("".join(f"{role}\n{text}\n" for role, text in turns).encode())
                data = formatted.encode()
                learned = unescape_all(data, loss)
                now[3] += len(learned)
                now[4].update(learned.encode())
                now[5] += len(formatted)
            columns = list(zip(*done)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=names,
            )
            kind = batch.schema.field(0).type
            done.clear()
        close()
        if done:
            columns = list(zip(*done))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=names,
            )

    kind = pieces.schema["conv_id"].dataType.simpleString()
    return pieces.mapInArrow(
        digested,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def unescape_all(data: bytes, spans: list[dict]) -> str:
    return "".join(unescape(data[s["start"] : s["end"]].decode()) for s in spans)
