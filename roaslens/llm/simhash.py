"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at most ``bits`` apart have a common variant within half that radius of
each.  So every distinct fingerprint emits all variants within ``bits // 2`` flips, one shuffle
brings the owners of a variant together, and the pairs found are checked by their bit distance.  A
variant has at most as many owners as its own ball has members (65 for one flip), so no group grows
with the data.  Components come from alternating star contraction on written tables.

Nulls count as empty texts; a text without words has fingerprint zero and is linked like any other.
Equal rows share a fingerprint and so a component; an empty table gives an empty result.  A null
doc_id is kept: its component is the smallest id of the others, null if all are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roaslens.llm.common import cut, drop_cut, row_key, text_or_empty


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of the XXH64 (seed 42) of all word shingles; words split at ASCII white space, A-Z lowered."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])
    n = max(1, len(words) - shingle + 1)
    ends = (starts[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts[:n].tolist(), ends, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # 64 bytes a shingle at once
        ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, shingle: int, text_col: str = "text", out: str = "fp") -> DataFrame:
    @F.pandas_udf("long")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], np.uint64).view(np.int64), dtype="int64")

    return docs.withColumn(out, simhash(text_or_empty(text_col)))


def _masks(radius: int) -> list[int]:
    masks = [sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, bits: int) -> DataFrame:
    """Links (a < b) between distinct fingerprints (column ``fp``) that connect all pairs at most ``bits`` apart.

    With an even ``bits`` all owners of a variant are within ``bits`` of each other, so a star from the
    least of them stands for every pair.  With an odd one two owners may be further apart; the radius is
    then rounded up and each pair is checked, inside a group of bounded size."""
    radius = (bits + 1) // 2
    variants = fps.select("fp", F.explode(F.lit(_masks(radius)).cast("array<bigint>")).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    met = variants.groupBy("variant").agg(F.min("fp").alias("least"), F.max("fp").alias("most"), F.count("*").alias("n")).filter("n > 1")
    met = cut(met)  # read twice below: written once, or the variants would be made and shuffled twice
    two = met.filter("n = 2").select(F.col("least").alias("a"), F.col("most").alias("b"))
    # owners of a variant with three or more: generated again from its ball, no second shuffle of all variants
    ball = met.filter("n > 2").select("least", "variant", F.explode(F.lit(_masks(radius)).cast("array<bigint>")).alias("mask"))
    ball = ball.select("least", "variant", F.col("variant").bitwiseXOR(F.col("mask")).alias("fp"))
    owners = ball.join(fps.select("fp"), "fp", "left_semi")
    if bits % 2 == 0:
        more = owners.select(F.col("least").alias("a"), F.col("fp").alias("b"))
    else:
        groups = owners.groupBy("variant").agg(F.sort_array(F.collect_list("fp")).alias("all"))
        more = groups.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b"))
    return two.unionByName(more).filter("a < b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes of undirected ``edges`` (a, b): root is the least node of the component.

    Alternating large and small stars: each node hangs its larger (then its smaller) neighbours on
    the least one, until nothing changes.  Minima are aggregated before they move and joined back;
    a node with very many neighbours is split by the adaptive skew join."""

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    held = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    before = state(held)
    while True:
        both = held.union(held.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        large = cut(large)
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(low, "b")
        small = joined.select(F.col("m").alias("x"), F.col("a").alias("y")).union(joined.select("m", "b"))
        after_frame = cut(small.filter("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        after = state(after_frame)
        drop_cut(held, large)
        held = after_frame
        if after == before:
            break
        before = after
    return held.select(F.col("b").alias("node"), F.col("a").alias("root")).union(held.select(F.col("a"), F.col("a"))).distinct()


def rooted(classes: DataFrame, bits: int) -> DataFrame:
    """``classes`` (one row a fingerprint, column ``fp``) with the ``root`` of each one's component."""
    roots = cut(components(links(classes, bits)))
    return classes.join(roots, classes["fp"] == roots["node"], "left").select(*[classes[c] for c in classes.columns], F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int, bits: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``; component_id is the smallest id reachable."""
    prints = cut(with_fingerprint(docs.select(id_col, text_col), shingle, text_col).select(id_col, "fp"))
    classes = cut(prints.groupBy("fp").agg(F.min(id_col).alias("least_id")))
    named = rooted(classes, bits)
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return prints.join(named.join(least, "root").select("fp", "component_id"), "fp")


def hex16(col: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def keep_one(docs: DataFrame, shingle: int, bits: int) -> DataFrame:
    """One row of ``docs`` for each component: that of the least id, null ids last; of equal ids the first by
    text hash, of equal texts the first by a hash of the whole row.  Ids may be null or repeated."""
    _, text_hash = row_key()
    keyed = docs.withColumns({"_text": text_hash, "_row": F.xxhash64(*docs.columns)})
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col("_text").alias("of_text"), F.col("_row").alias("of_row"))
    prints = with_fingerprint(keyed.select("doc_id", "text", "_text", "_row"), shingle).select("fp", key.alias("key"))
    classes = cut(prints.groupBy("fp").agg(F.min("key").alias("key")))
    found = rooted(classes, bits).groupBy("root").agg(F.min("key").alias("key")).select("key.*")
    same = keyed["doc_id"].eqNullSafe(found["id"]) & (keyed["_text"] == found["of_text"]) & (keyed["_row"] == found["of_row"])
    return keyed.join(found, same, "left_semi").dropDuplicates(["doc_id", "_text", "_row"]).select(*docs.columns)
