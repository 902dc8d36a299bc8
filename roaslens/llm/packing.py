"""Best-fit packing of token pieces into sequences by exact-complement hashing.

Only the number of pieces of each length decides a packing, and there are at most ``capacity``
lengths, whatever the data.  ``plan`` works on those counts.  An index says for every sum how many single
lengths, pairs and triples of available lengths make it; it is kept up as lengths run out.  For the longest length
left, a combination that fills its gap exactly is looked up and consumed as often as the counts allow; of
several, the one whose lengths are most plentiful.  What is left is placed best-fit, longest first.

Exact complements can use up the short lengths that best-fit needs to close its sequences.  So they are consumed as long
as best-fit still closes the rest: the plan takes the longest run of them with the fewest sequences in all.

Each step empties a length or a gap, so the plan has few rows and goes to all tasks.  Pieces are numbered within their
length by one distributed ordering, and the number says sequence and offset.

Null texts count as empty (one piece, the end id); an empty table packs into nothing; equal rows are
packed each; other columns of the documents are not carried (join on the id).  Columns of packed items named like a
result (``sequence_id``, ``offset``) are replaced.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaslens.llm.bpe import encoder, runs
from roaslens.llm.common import cut, ordered_prefix, text_or_empty

PIECES = "doc_id long, piece int, start long, length long, ids binary"
DIGESTS = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Lengths of the run of exact combinations that ``plan`` weighs.
STEPS = 32


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, digests: bool = False) -> DataFrame:
    """Token pieces (``PIECES``; ids as little-endian unsigned 32-bit integers) of all documents, each
    ended by ``end_id``.  A longer document is cut into full pieces; the first may be shorter.  With ``digests``
    (``DIGESTS``) only the CRC-32 of the ids leaves the tasks."""
    value = zlib.crc32 if digests else bytes

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for pdf in batches:
            at = 0
            for some in runs(pdf["text"].tolist()):
                rows = []
                for doc_id, ids in zip(pdf["doc_id"].iloc[at : at + len(some)].tolist(), enc.encode(some), strict=True):
                    n = len(ids) // 4 + 1
                    ids, head = ids + end, n % capacity or capacity
                    cuts = [0, *range(head, n + 1, capacity)]
                    rows += [(doc_id, k, a, b - a, value(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
                at += len(some)
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32" if digests else "ids"])
                yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text")).mapInPandas(cut_up, DIGESTS if digests else PIECES)


Combos = list[tuple[list[int], int]]
Patterns = list[tuple[list[tuple[int, int]], int]]


class Sums:
    """Available lengths, and for every sum up to ``capacity`` the number of ordered pairs and triples of them that make it."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.single = (left > 0).astype(np.int64)
        self.single[0] = 0
        self.pair = np.convolve(self.single, self.single)[: len(left)]
        self.triple = np.convolve(self.pair, self.single)[: len(left)]

    def _shifted(self, x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(x)
        out[by:] = x[: max(len(x) - by, 0)]
        return out

    def _remove(self, x: int) -> None:
        """Length ``x`` has run out: with e its place, (A - e)^2 and (A - e)^3 of A's products."""
        n = len(self.left)
        self.triple += 3 * self._shifted(self.single, min(2 * x, n)) - 3 * self._shifted(self.pair, x)
        self.pair -= 2 * self._shifted(self.single, x)
        if 2 * x < n:
            self.pair[2 * x] += 1
        if 3 * x < n:
            self.triple[3 * x] -= 1
        self.single[x] = 0

    def take(self, combo: list[int], most: int | None = None) -> int:
        """How often ``combo`` can be taken from the counts; takes it."""
        need = Counter(combo)
        n = int(min(self.left[x] // k for x, k in need.items()))
        n = n if most is None else min(n, most)
        for x, k in need.items():
            self.left[x] -= n * k
            if not self.left[x] and self.single[x]:
                self._remove(x)
        return n

    def _pair(self, total: int) -> list[int] | None:
        """The two lengths that make ``total`` and can be taken most often."""
        if not self.pair[total]:
            return None
        a = np.flatnonzero(self.single[1 : total // 2 + 1] & self.single[total - 1 : (total - 1) // 2 : -1][: total // 2]) + 1
        times = np.minimum(self.left[a], self.left[total - a])
        times[2 * a == total] //= 2
        best = int(times.argmax()) if len(a) else 0
        return [int(total - a[best]), int(a[best])] if len(a) and times[best] else None

    def fill(self, gap: int) -> list[int] | None:
        """One, two or three lengths left that add up to ``gap``; the fewest, then the most plentiful."""
        if gap <= 0:
            return None
        if self.single[gap]:
            return [gap]
        if pair := self._pair(gap):
            return pair
        if not self.triple[gap]:
            return None
        third = np.flatnonzero(self.single[:gap] * self.pair[gap - np.arange(gap)])
        for c in third[np.argsort(-self.left[third], kind="stable")].tolist():
            self.left[c] -= 1
            combo = self._pair(gap - c)
            self.left[c] += 1
            if combo and all(self.left[x] >= k for x, k in Counter([c, *combo]).items()):
                return sorted([c, *combo], reverse=True)
        return None


def complements(left: np.ndarray, capacity: int) -> Combos:
    """Sequences that are filled exactly, and how often each is: openers from the longest down."""
    sums, found = Sums(left.copy()), []
    for length in range(capacity, 0, -1):
        while sums.left[length]:
            if length == capacity:
                found.append(([length], sums.take([length])))
                continue
            sums.left[length] -= 1  # the one that opens the sequence
            combo = sums.fill(capacity - length)
            sums.left[length] += 1
            n = sums.take([length, *combo]) if combo else 0
            if not n:
                break
            found.append(([length, *combo], n))
    return found


def best_fit(left: np.ndarray, capacity: int) -> Patterns:
    """What is left, longest first, each length into the sequences with the least room that holds it."""
    gaps: dict[int, list] = {}  # room -> patterns with that much
    rooms: list[int] = []  # its keys, ascending

    def put(room: int, pattern: tuple, n: int) -> None:
        if room not in gaps:
            insort(rooms, room)
            gaps[room] = []
        gaps[room].append((pattern, n))

    for length in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[length])
        while todo:
            at = bisect_left(rooms, length)
            if at == len(rooms):  # new sequences, each filled with as many of this length as fit
                each = min(capacity // length, todo)
                n = todo // each
                put(capacity - each * length, ((length, each),), n)
                todo -= n * each
                continue
            room = rooms[at]
            pattern, n = gaps[room].pop()
            each = min(room // length, todo)
            use = min(n, todo // each)
            if use < n:
                gaps[room].append((pattern, n - use))
            if not gaps[room]:
                del gaps[room], rooms[at]
            put(room - each * length, (*pattern, (length, each)), use)
            todo -= use * each
    return [(list(p), n) for held in gaps.values() for p, n in held]


def parts(counts: dict[int, int], capacity: int) -> tuple[Combos, Patterns]:
    """The run of exact combinations that is consumed, and the best-fit sequences of the rest."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    found = complements(left, capacity)

    def rest(k: int) -> np.ndarray:
        """The counts after the first ``k`` exact combinations."""
        out = left.copy()
        for combo, n in found[:k]:
            np.subtract.at(out, combo, n)
        return out

    def total(k: int) -> int:
        return sum(n for _, n in found[:k]) + sum(n for _, n in best_fit(rest(k), capacity))

    steps = sorted({round(len(found) * i / STEPS) for i in range(STEPS + 1)})
    sizes = {k: total(k) for k in steps}
    fewest = min(sizes.values())
    low = max(k for k, n in sizes.items() if n == fewest)
    high = min((k for k in steps if k > low), default=low)
    while high - low > 1:  # between two steps: as far as the rest still closes
        mid = (low + high) // 2
        low, high = (mid, high) if total(mid) <= fewest else (low, mid)
    return found[:low], best_fit(rest(low), capacity)


def plan(counts: dict[int, int], capacity: int) -> Patterns:
    """Patterns ``([(length, times), ...], how many sequences)`` that use up ``counts``."""
    exact, residual = parts(counts, capacity)
    return [(list(Counter(p).items()), n) for p, n in exact] + residual


def placements(patterns: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length, first number, times a sequence, first sequence, offset), sorted by length and number."""
    rows, used, base = [], Counter(), 0
    for pattern, n in patterns:
        offset = 0
        for length, times in pattern:
            rows.append((length, used[length], times, base, offset))
            used[length] += n * times
            offset += length * times
        base += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(items: DataFrame, capacity: int, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``items`` (with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    ``order`` numbers the pieces of a length; rows equal in it may swap places."""
    items = cut(items.drop("sequence_id", "offset"))
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    if any(not 1 <= k <= capacity for k in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    table = placements(plan(counts, capacity))
    shift = np.int64(1 << 44)  # numbers within a length stay below
    keys = table[:, 0] * shift + table[:, 1]
    lengths = sorted(counts)
    before = np.zeros(capacity + 2, np.int64)  # pieces of lesser lengths
    before[1:] = np.cumsum(np.bincount(lengths, [counts[k] for k in lengths], capacity + 1).astype(np.int64)) if lengths else 0

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        size = length.to_numpy(np.int64)
        rank = number.to_numpy(np.int64) - before[size]
        row = table[np.searchsorted(keys, size * shift + rank, "right") - 1]
        past = rank - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + past // row[:, 2], "offset": row[:, 4] + past % row[:, 2] * size})

    numbered = ordered_prefix(items, ["length", *order], {"_number": None})
    return numbered.withColumn("_place", place("length", "_number")).select(*items.columns, "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the token sequences themselves, from packed pieces that carry ``ids``."""
    held = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return held.select("sequence_id", "length", joined.alias("ids"))  # a sequence has at most ``capacity`` pieces
