"""Sparse suffix positions of byte texts: the window minimisers that any long match must share.

A match of ``match`` bytes between two places covers ``match - gram + 1`` grams of ``gram``
bytes; the gram with the least hash (leftmost on ties) sits at the same place in both, so it
is enough to index that gram's position, the anchor.  Every window of ``match`` bytes belongs
to exactly one anchor, the windows of an anchor are consecutive, and equal windows have
anchors with equal grams.  All functions work on whole numpy buffers, no Python loop a byte.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Odd multipliers of the two independent rolling hashes.
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_TABLE = tuple(np.random.default_rng(seed).integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1) for seed in (11, 12))
#: Bytes handled at once; positions inside a piece take the low bits of the ordering value.
PIECE = 1 << 20
_POS_BITS = 21
_POS = _U((1 << _POS_BITS) - 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all of its bits depend on all bits of the input."""
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    h *= _U(0xA0761D6478BD642F)
    h ^= h >> _U(32)
    return h


def gram_hashes(buf: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Rolling hash of every run of ``size`` bytes (length ``len(buf) - size + 1``), built by doubling."""
    base = _BASE[which]
    h, have = _TABLE[which][buf], 1
    out, done = None, 0
    while True:
        if size & have:
            if out is None:
                out, done = h, have
            else:  # the part so far, then a block of ``have`` bytes
                n = len(buf) - done - have + 1
                out = out[:n] * _U(pow(base, have, 2**64)) + h[done : done + n]
                done += have
        if have * 2 > size:
            return out
        n = len(h) - have
        h = h[:n] * _U(pow(base, have, 2**64)) + h[have : have + n]
        have *= 2


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        v = np.minimum(v[: len(v) - have], v[have:])
        have *= 2
    rest = width - have
    return np.minimum(v[: len(v) - rest], v[rest:]) if rest else v


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        m = min(have, n - have)
        out[have : have + m] = out[:m] * _U(pow(base, have, 2**64))
        have += m
    return out


_POW = _powers(PIECE + 1, _BASE[1])
_INV = _powers(PIECE + 1, pow(_BASE[1], -1, 2**64))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``buf[start:end]`` for many spans, from one running sum (length mixed in)."""
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLE[1][buf] * _POW[: len(buf)], out=total[1:])
    return mix((total[end] - total[start]) * _INV[start] + (end - start).astype(np.uint64) * _U(0x9FB21C651E98DF25))


def pieces(texts: list[bytes], match: int):
    """(buffer, text ends in the buffer, rows, offset in the text) pieces of at most ``PIECE`` bytes.

    Short texts share a piece.  A longer text is cut with ``match - 1`` bytes of overlap, so each
    of its windows lies in exactly one piece."""
    held, rows, size = [], [], 0
    for row, text in enumerate(texts):
        if len(text) < match:
            continue
        if held and size + len(text) > PIECE:
            yield b"".join(held), np.cumsum([len(x) for x in held]), np.array(rows), np.zeros(len(rows), np.int64)
            held, rows, size = [], [], 0
        if len(text) > PIECE:
            at = 0
            while at + match <= len(text):
                part = text[at : at + PIECE]
                yield part, np.array([len(part)]), np.array([row]), np.array([at])
                at += PIECE - match + 1
        else:
            held.append(text)
            rows.append(row)
            size += len(text)
    if held:
        yield b"".join(held), np.cumsum([len(x) for x in held]), np.array(rows), np.zeros(len(rows), np.int64)


def anchors(texts: list[bytes], match: int, gram: int) -> dict[str, np.ndarray]:
    """Anchors of many texts: ``row`` (index of the text), ``gram`` and ``context`` hashes (the
    context spans all windows of the anchor), ``at`` (byte of the anchor), ``lo`` and ``hi``
    (first and last window start that the anchor stands for).  Texts shorter than ``match`` have none."""
    out: dict[str, list] = {k: [] for k in ("row", "gram", "context", "at", "lo", "hi")}
    for data, ends, rows, offsets in pieces(texts, match):
        buf = np.frombuffer(data, np.uint8)
        h = gram_hashes(buf, gram)
        v = (mix(h) & ~_POS) | np.arange(len(h), dtype=np.uint64)
        least = (sliding_min(v, match - gram + 1) & _POS).astype(np.int64)  # anchor of each window start
        # windows that cross into the next text count for nothing
        text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(least)]
        ok = np.arange(len(least)) + match <= ends[text]
        first = np.flatnonzero(ok & np.concatenate(([True], (least[1:] != least[:-1]) | ~ok[:-1])))
        last = np.flatnonzero(ok & np.concatenate(((least[1:] != least[:-1]) | ~ok[1:], [True])))
        at = least[first]
        text = text[first]
        begin = np.where(text > 0, ends[text - 1], 0) - offsets[text]
        out["row"].append(rows[text])
        out["gram"].append(mix(h[at]).view(np.int64))
        out["context"].append(span_hashes(buf, first, last + match).view(np.int64))
        for k, x in (("at", at), ("lo", first), ("hi", last)):
            out[k].append(x - begin)
    return {k: np.concatenate(x) if x else np.zeros(0, np.int64) for k, x in out.items()}


def window_hashes(context: bytes, match: int) -> np.ndarray:
    """Hash of each window of ``match`` bytes in a context."""
    return mix(gram_hashes(np.frombuffer(context, np.uint8), match, 1)).view(np.int64)
