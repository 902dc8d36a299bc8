"""Chat formatting by columnar byte assembly, with a loss mask, and the reader of what it writes.

A turn becomes ``### role: text</turn>`` and a line end.  In role and text a backslash goes before every
backslash and before every control string (``### `` and ``</turn>``; in a role, before ``:`` too), so
no text can open or close a turn and the reader gets every character back.  The loss mask holds the byte spans
of the texts of ``assistant`` turns.

A batch of turns is one pass in numpy: lengths of the segments (header, role, separator, text, end), their
cumulative offsets, and the places of constants and backslashes in one buffer that is allocated once and
becomes the Arrow column; the bytes of the texts fill the places that are left, in order.

Turns of a conversation go by ``turn`` (null first), ties by role, then text; repeated rows are turns each.
Null roles and texts are empty.  A null ``conv_id`` is a conversation of its own.  Columns beyond conv_id, turn, role
and text are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaslens.llm.common import cut, hot_keys, shuffle_parts

OPEN, SEPARATOR, CLOSE = b"### ", b": ", b"</turn>"
END = CLOSE + b"\n"
ESCAPE, COLON, LINE = 92, 58, 10
LOSS_ROLE = "assistant"
#: Bytes of text that one pass assembles; a longer text is a pass of its own.
SLICE = 1 << 22

PARTS = "conv_id long, deal int, seq long, n_turns long, text binary, loss_start array<long>, loss_end array<long>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column and the offsets of its rows in them; null is empty."""
    big = pa.large_binary()
    column = pc.fill_null(column.cast(big) if column.type != big else column, b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _find(data: np.ndarray, word: bytes) -> np.ndarray:
    """Places of ``word`` in ``data``."""
    at = np.flatnonzero(data[: max(len(data) - len(word) + 1, 0)] == word[0])
    for k, byte in enumerate(word[1:], 1):
        at = at[data[at + k] == byte]
    return at


def _escapes(data: np.ndarray, offsets: np.ndarray, colon: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places that get a backslash before them, ascending, and how many of them come before each offset."""
    found = [np.flatnonzero(data == ESCAPE)]
    for word in (OPEN, CLOSE):
        at = _find(data, word)
        end = offsets[np.searchsorted(offsets, at, side="right")]
        found.append(at[at + len(word) <= end])  # a control string lies within one text
    if colon:
        found.append(np.flatnonzero(data == COLON))
    places = np.sort(np.concatenate(found))
    return places, np.searchsorted(places, offsets)


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges from ``starts`` of ``lengths``."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - before, lengths)


def _escaped_places(starts: np.ndarray, offsets: np.ndarray, places: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Where the backslashes go, when row r of the source begins at ``starts[r]`` of the target."""
    row = np.searchsorted(offsets, places, side="right") - 1
    return starts[row] + places - offsets[row] + np.arange(len(places)) - before[row]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns one behind the other, the offsets of the turns, and where their texts begin and end."""
    role, role_at = _bytes(roles)
    text, text_at = _bytes(texts)
    role_esc, role_before = _escapes(role, role_at, colon=True)
    text_esc, text_before = _escapes(text, text_at, colon=False)
    role_len = np.diff(role_at) + np.diff(role_before)
    text_len = np.diff(text_at) + np.diff(text_before)
    turn_at = np.concatenate(([0], np.cumsum(role_len + text_len + len(OPEN) + len(SEPARATOR) + len(END))))
    start = turn_at[:-1]
    role_start = start + len(OPEN)
    sep_start = role_start + role_len
    text_start = sep_start + len(SEPARATOR)
    text_end = text_start + text_len

    out = np.empty(turn_at[-1], np.uint8)
    is_text = np.ones(len(out), bool)
    for at, word in ((start, OPEN), (sep_start, SEPARATOR), (text_end, END)):
        places = at[:, None] + np.arange(len(word))
        out[places] = np.frombuffer(word, np.uint8)
        is_text[places] = False
    places = _ragged(role_start, role_len)
    is_text[places] = False
    out[_escaped_places(role_start, role_at, role_esc, role_before)] = ESCAPE
    is_role = np.ones(len(places), bool)
    is_role[_escaped_places(np.cumsum(role_len) - role_len, role_at, role_esc, role_before)] = False
    out[places[is_role]] = role
    places = _escaped_places(text_start, text_at, text_esc, text_before)
    out[places] = ESCAPE
    is_text[places] = False
    out[is_text] = text
    return out, turn_at, text_start, text_end


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold ``SLICE`` bytes of text, or one row that holds more."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + SLICE, side="right")))
        yield lo, hi
        lo = hi


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    deal, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        for lo, hi in _slices(batch.column("text")):
            b = batch.slice(lo, hi - lo)
            out, turn_at, text_start, text_end = assemble(b.column("role"), b.column("text"))
            ids = b.column("conv_id")
            null = np.asarray(ids.is_null())
            key = ids.fill_null(0).to_numpy()
            first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (null[1:] != null[:-1]))))
            edge = np.append(first, hi - lo)
            base = turn_at[first]
            in_loss = np.asarray(pc.fill_null(pc.equal(b.column("role"), LOSS_ROLE), False))
            part = np.repeat(np.arange(len(first)), np.diff(edge))[in_loss]
            loss_at = np.searchsorted(part, np.arange(len(first) + 1)).astype(np.int32)
            spans = [pa.ListArray.from_arrays(pa.array(loss_at), pa.array(x[in_loss] - base[part])) for x in (text_start, text_end)]
            offsets = turn_at[edge].astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(first)), pa.array(np.full(len(first), deal, np.int32)), pa.array(np.arange(seq, seq + len(first))), pa.array(np.diff(edge)),
                pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out)]), *spans,
            ], names=["conv_id", "deal", "seq", "n_turns", "text", "loss_start", "loss_end"])
            seq += len(first)


def _turns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    order = ["conv_id", "turn", "role", "text"]
    return df.select(*order), order


def format_turns(df: DataFrame, by_range: bool = False) -> DataFrame:
    """Formatted parts of conversations: consecutive turns of one conversation, ``text`` the bytes, ``loss_start`` and
    ``loss_end`` byte offsets in them; parts of a conversation follow each other by ``deal``, ``seq``.

    Turns are dealt by conversation, so a conversation is within one partition in order; with ``by_range`` by
    ranges of (conversation, turn), which splits a conversation of any size over tasks."""
    rows, order = _turns(df)
    n = shuffle_parts(df.sparkSession)
    dealt = rows.repartitionByRange(n, *order) if by_range else rows.repartition(n, "conv_id")
    return dealt.sortWithinPartitions(*order).select("conv_id", "role", "text").mapInArrow(_format, PARTS)


def _parse(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``data`` as role, line end, text, line end for every turn without escapes, and the places taken out."""
    slashes = np.flatnonzero(data == ESCAPE)
    new_run = np.concatenate(([True], np.diff(slashes) != 1)) if len(slashes) else np.empty(0, bool)
    run_start = np.flatnonzero(new_run)
    rank = np.arange(len(slashes)) - np.repeat(run_start, np.diff(np.append(run_start, len(slashes))))
    escapers = slashes[rank % 2 == 0]
    plain = np.ones(len(data) + 1, bool)
    plain[escapers + 1] = False
    plain[escapers] = True
    starts, ends, colons = _find(data, OPEN), _find(data, END), np.flatnonzero(data == COLON)
    starts, ends, colons = (x[plain[x]] for x in (starts, ends, colons))
    at = np.searchsorted(colons, starts)
    bounds = np.concatenate((starts, [len(data)]))
    if len(starts) != len(ends) or (at >= len(colons)).any() or not np.array_equal(ends + len(END), bounds[1:]) or not np.isin(offsets, bounds).all():
        raise ValueError("not the output of format_turns")
    seps = colons[at]
    keep = np.ones(len(data), bool)
    keep[escapers] = False
    for places, n in ((starts, len(OPEN)), (seps + 1, 1), (ends, len(CLOSE))):
        keep[places[:, None] + np.arange(n)] = False
    stream = data.copy()
    stream[seps] = LINE
    return stream[keep], np.flatnonzero(~keep)


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


class _Reader:
    """Digests of the conversation at hand, fed part by part."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.n_turns, self.loss_chars, self.formatted_chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    types = [pa.string() if x.endswith("string") else pa.int64() for x in DIGESTS.split(", ")]
    rows, now = [], None
    out = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    for batch in batches:
        for lo, hi in _slices(batch.column("text")):
            b = batch.slice(lo, hi - lo)
            data, offsets = _bytes(b.column("text"))
            stream, gone = _parse(data, offsets)
            bounds = offsets - np.searchsorted(gone, offsets)
            ids, counts = b.column("conv_id").to_pylist(), b.column("n_turns").to_pylist()
            spans = []
            for name in ("loss_start", "loss_end"):
                col = b.column(name)
                spans.append(col.flatten().to_numpy() + np.repeat(offsets[:-1], col.value_lengths().to_numpy()))
            n_spans = np.concatenate(([0], np.cumsum(b.column("loss_start").value_lengths().to_numpy())))
            from_, to = (x - np.searchsorted(gone, x) for x in spans)
            for k, conv_id in enumerate(ids):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        rows.append(now.row())
                    now = _Reader(conv_id)
                now.n_turns += counts[k]
                now.turns.update(stream[bounds[k] : bounds[k + 1]])
                now.formatted_chars += _chars(data[offsets[k] : offsets[k + 1]])
                for a, z in zip(from_[n_spans[k] : n_spans[k + 1]], to[n_spans[k] : n_spans[k + 1]]):
                    now.loss.update(stream[a:z])
                    now.loss_chars += _chars(stream[a:z])
            if len(rows) >= 4096:
                yield out()
                rows.clear()
    if now is not None:
        rows.append(now.row())
        yield out()


def read_parts(parts: DataFrame) -> DataFrame:
    """Per conversation, from the formatted bytes and the mask alone: turns, SHA-256 of role, line end, text, line end
    of every turn, code points and SHA-256 of the unescaped text under the mask, code points of the whole.
    ``parts`` holds the parts of a conversation one behind the other in one partition, as ``format_turns``
    leaves them."""
    return parts.mapInArrow(_read, DIGESTS)


def round_trip(df: DataFrame, hot_rows: int = 10_000) -> DataFrame:
    """Format all conversations and read them back.

    Both run in one stage behind one shuffle.  Conversations of more than ``hot_rows`` turns and a thousandth of all
    (so at most 1,000) are formatted by ranges over many tasks and written; only their digests, which are
    sequential by nature, are taken by one task each, from a stream of parts."""
    hot = hot_keys(df, "conv_id", hot_rows)
    if not hot:
        return read_parts(format_turns(df))
    is_hot = F.coalesce(F.col("conv_id").isin([k for k in hot if k is not None]), F.lit(False))
    if None in hot:
        is_hot = is_hot | F.col("conv_id").isNull()
    large = cut(format_turns(df.filter(is_hot), by_range=True))
    large = large.repartition(shuffle_parts(df.sparkSession), "conv_id").sortWithinPartitions("conv_id", "deal", "seq")
    return read_parts(format_turns(df.filter(~is_hot))).unionByName(read_parts(large))
