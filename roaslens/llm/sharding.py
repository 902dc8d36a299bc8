"""Reproducible global shuffle into shards: a Feistel permutation of row numbers with cycle walking.

Rows get their number in ascending id; a keyed Feistel network permutes the smallest even power of
two that covers the count, and a value outside the count is walked on until it falls inside, which
is again a permutation.  Row ``r`` goes to place ``p = permute(r)``, shard ``p % shards``, slot
``p // shards``: shards differ by one row at most, slots have no gap, and both directions are plain
arithmetic, with no table kept.  The law is ``rows``; the method keeps no groups together (equal texts
are rows like others) and moves rows between all shards when their number changes.

Nulls: a null text has size 8 and checksum 0, a null id sorts first.  Rows that are equal in id, size
and checksum may swap places.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaslens.llm.common import cut, ordered_prefix

ROUNDS = 6
_U = np.uint64


def _round(half: np.ndarray, key: int, step: int) -> np.ndarray:
    x = half + _U((key * 0x9E3779B97F4A7C15 + (step + 1) * 0xBF58476D1CE4E5B9) % 2**64)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _feistel(x: np.ndarray, bits: int, key: int, back: bool) -> np.ndarray:
    mask, shift = _U((1 << bits) - 1), _U(bits)
    left, right = x >> shift, x & mask
    for step in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if back:
            left, right = right ^ (_round(left, key, step) & mask), left
        else:
            left, right = right, left ^ (_round(right, key, step) & mask)
    return (left << shift) | right


def permute(rows: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """Places of row numbers in 0..n-1 (``back``: row numbers of places)."""
    bits = max(1, -(-(max(n, 2) - 1).bit_length() // 2))
    out = _feistel(np.asarray(rows).astype(np.uint64), bits, key, back)
    while len(out_of := np.flatnonzero(out >= _U(n))):
        out[out_of] = _feistel(out[out_of], bits, key, back)
    return out.astype(np.int64)


def row_at(shard: int, slot: int, shards: int, n: int, key: int) -> int:
    """Row number that sits in a shard's slot."""
    return int(permute(np.array([slot * shards + shard]), n, key, back=True)[0])


def shard(rows: DataFrame, shards: int, key: int, order: list[str]) -> DataFrame:
    """``rows`` with ``row`` (number in ``order``), ``shard`` and ``slot``.  Rows are range-partitioned and
    written once; pass the columns that are wanted, not whole texts.  Columns of these three names are replaced."""
    rows = cut(rows.drop("row", "shard", "slot"))
    n = rows.count()

    @F.pandas_udf("shard int, slot long")
    def place(number: pd.Series) -> pd.DataFrame:
        p = permute(number.to_numpy(np.int64), n, key)
        return pd.DataFrame({"shard": (p % shards).astype(np.int32), "slot": p // shards})

    numbered = ordered_prefix(rows, order, {"row": None})
    return numbered.withColumn("_p", place("row")).select("*", "_p.shard", "_p.slot").drop("_p")
