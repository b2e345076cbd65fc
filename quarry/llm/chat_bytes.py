"""Chat formatting by columnar byte assembly (operator 6).

Turns are sorted by conversation; each task then formats whole Arrow
batches in numpy: segment lengths, cumulative offsets and scatter indices,
and one preallocated buffer per batch into which role headers and contents
are copied. No per-turn Python. A conversation that goes on in the next
batch is carried over, so memory holds one batch and one conversation.

Template, per turn: ``<s>`` header text ``</s>``, with header ``[INST]`` for
user, ``[/INST]`` for assistant, ``<<SYS>>`` for system, and
``[ROLE]name[/ROLE]`` for any other role. Inside texts and names a backslash
is doubled and a control string gets ``\\!`` after its first character, so no
control string is left and the text can be read back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
HEADERS = {"user": "[INST]", "assistant": "[/INST]", "system": "<<SYS>>"}
BEGIN, END = "<s>", "</s>"

#: bytes that are indexed at a time
PIECE = 4 << 20

FORMATTED = "conv bigint, n_turns bigint, formatted string, loss array<struct<start:bigint,stop:bigint>>"


def escape(text: Column) -> Column:
    """Reversible: doubled backslashes, control strings broken by ``\\!``."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\!" + c[1:]))
    return out


def _bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(starts, data) of a string array without nulls: n + 1 offsets into data."""
    col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return off, data


def _scatter(out: np.ndarray, at: np.ndarray, src: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
    """Copy segment k, src[start[k] : start[k] + size[k]], to out[at[k] :].

    Long segments are copied as slices, the others through scatter indices for at
    most about ``PIECE`` bytes at a time, so the indices stay small."""
    large = size > PIECE // 16
    for k in np.flatnonzero(large):
        out[at[k]:at[k] + size[k]] = src[start[k]:start[k] + size[k]]
    at, start, size = at[~large], start[~large], size[~large]
    ends = np.cumsum(size)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PIECE, side="right")))
        n = size[a:b]
        total = int(n.sum())
        inner = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(at[a:b], n) + inner] = src[np.repeat(start[a:b], n) + inner]
        a = b


def _chars_before(out: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Code points of the UTF-8 bytes ``out`` before each place, ``PIECE`` bytes at a time."""
    order = np.argsort(places, kind="stable")
    sorted_, found = places[order], np.empty(len(places), dtype=np.int64)
    total, i = 0, 0
    for a in range(0, max(1, len(out)), PIECE):
        block = out[a:a + PIECE]
        last = a + PIECE >= len(out)
        j = int(np.searchsorted(sorted_, a + len(block), side="right" if last else "left"))
        chars = np.concatenate([[0], np.cumsum((block & 0xC0) != 0x80)])
        found[order[i:j]] = total + chars[sorted_[i:j] - a]
        total, i = total + int(chars[-1]), j
    return found


def _assemble(conv: pa.Array, group: np.ndarray, role: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """Format turns; ``group`` numbers the conversations from 0, ascending."""
    n, groups = len(text), int(group[-1]) + 1
    known = list(HEADERS)
    kind = pc.index_in(role, value_set=pa.array(known)).fill_null(len(known)).to_numpy(zero_copy_only=False)
    # the header bytes of each kind, one after the other; other roles bring their own name
    pieces = [(BEGIN + HEADERS[r]).encode() for r in known] + [(BEGIN + "[ROLE]").encode()]
    table = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    piece_len = np.array([len(p) for p in pieces])
    piece_at = np.cumsum(piece_len) - piece_len
    head_len, other = piece_len[kind], kind == len(known)
    role_off, role_data = _bytes(role)
    name_len = np.where(other, np.diff(role_off), 0)
    close, end = np.frombuffer(b"[/ROLE]", np.uint8), np.frombuffer(END.encode(), np.uint8)
    close_len = np.where(other, len(close), 0)
    text_off, text_data = _bytes(text)
    text_len = np.diff(text_off)
    size = head_len + name_len + close_len + text_len + len(end)
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), dtype=np.uint8)
    _scatter(out, at, table, piece_at[kind], head_len)
    _scatter(out, at + head_len, role_data, role_off[:-1], name_len)
    _scatter(out, at + head_len + name_len, close, np.zeros(n, np.int64), close_len)
    text_at = at + head_len + name_len + close_len
    _scatter(out, text_at, text_data, text_off[:-1], text_len)
    _scatter(out, text_at + text_len, end, np.zeros(n, np.int64), np.full(n, len(end)))

    first = np.searchsorted(group, np.arange(groups))
    conv_at = np.append(at[first], len(out))
    formatted = pa.LargeStringArray.from_buffers(groups, pa.py_buffer(conv_at.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
    # code points before the conversations and the texts, for the loss spans
    learn = kind == known.index("assistant")
    base, start, stop = (_chars_before(out, places) for places in (at[first], text_at[learn], (text_at + text_len)[learn]))
    lo, hi = start - base[group[learn]], stop - base[group[learn]]
    spans = pa.StructArray.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=["start", "stop"])
    per = np.bincount(group[learn], minlength=groups)
    loss = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), spans)
    turns = pa.array(np.bincount(group, minlength=groups), pa.int64())
    return pa.RecordBatch.from_arrays([conv.take(pa.array(first)), turns, formatted, loss], names=["conv", "n_turns", "formatted", "loss"])


def _format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns in, one row per conversation out."""
    held: list[pa.RecordBatch] = []  # the turns of the last conversation so far
    last = None

    def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        conv, role, text = (t.column(k).combine_chunks() if isinstance(t.column(k), pa.ChunkedArray) else t.column(k) for k in range(3))
        return _assemble(conv, _groups(conv), role, text)

    for batch in batches:
        if not len(batch):
            continue
        g = _groups(batch.column(0))
        cut = int(np.searchsorted(g, g[-1]))  # where the last conversation of the batch begins
        if cut == 0 and held and last == batch.column(0)[0]:
            held.append(batch)
            continue
        ready = held if held and (last != batch.column(0)[0]) else []
        if ready:
            yield done(ready)
            held = []
        if cut:
            yield done(held + [batch.slice(0, cut)])
        held, last = [batch.slice(cut)], batch.column(0)[len(batch) - 1]
    if held:
        yield done(held)


def _groups(conv: pa.Array) -> np.ndarray:
    """0, 0, 1, ...: a new number where the (sorted) id changes; null is an id."""
    valid = conv.is_valid().to_numpy(zero_copy_only=False)
    v = conv.fill_null(0).to_numpy(zero_copy_only=False)
    new = (v[1:] != v[:-1]) | (valid[1:] != valid[:-1])
    return np.concatenate([[0], np.cumsum(new)]).astype(np.int64)


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per conversation: conv, n_turns, formatted, loss.

    ``loss`` lists the code point ranges [start, stop) of the assistant texts
    in ``formatted``. Turns are ordered by turn number (null last), ties by
    role and text, so repeated rows appear next to each other. Null text and
    null role are empty. Rows with a null id form one conversation. A
    conversation is one output value and is formatted in one task.
    """
    t = turns.select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.select("conv", "turn", escape(F.col("role")).alias("role"), escape(F.col("text")).alias("text"))
    t = t.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_last(), "role", "text")
    return t.select("conv", "role", "text").mapInArrow(_format_batches, FORMATTED)


_MARK = re.compile(r"\\(?:(\\)|!)")
PARSED = "conv bigint, n_turns bigint, formatted_chars bigint, turns array<struct<role:string,text:string>>, learned array<string>"


def _unescape(s: str) -> str:
    return _MARK.sub(lambda m: m[1] or "", s) if "\\" in s else s


def _parse_turn(piece: str) -> tuple[str, str]:
    body = piece[len(BEGIN):]
    for role, head in HEADERS.items():
        if body.startswith(head):
            return role, _unescape(body[len(head):])
    name, _, text = body[len("[ROLE]"):].partition("[/ROLE]")
    return _unescape(name), _unescape(text)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        for k in range(len(batch)):  # a row at a time: formatted conversations can be long
            s, loss = batch.column(2)[k].as_py(), batch.column(3)[k].as_py()
            turns = [_parse_turn(p) for p in s.split(END)[:-1]]
            learned = [_unescape(s[x["start"]:x["stop"]]) for x in loss]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([len(s)], pa.int64()),
                pa.array([[{"role": r, "text": t} for r, t in turns]], kinds), pa.array([learned], pa.list_(pa.string()))],
                names=["conv", "n_turns", "formatted_chars", "turns", "learned"])


def read_chat(formatted: DataFrame) -> DataFrame:
    """(conv, n_turns, formatted_chars, turns, learned): the turns as
    array<struct<role,text>> and the unescaped texts under the loss ranges,
    parsed from ``formatted`` and ``loss`` alone."""
    return formatted.select("conv", "n_turns", "formatted", "loss").mapInArrow(_parse_batches, PARSED)
