"""Trie of conversation prefixes with a count-min screen.

Each prefix of a conversation has a digest that can be put together in pieces: the exclusive or of hashes of
(place, turn), twice 64 bits, a turn being named by half of its SHA-256.  A count-min sketch of all
prefix digests is counted task by task and merged; it never counts too little, so an estimate of one proves that a
prefix has one member.  Nodes so proven are made where they are; only prefixes that may be shared are grouped
exactly.  The sketch takes what the turns need up to ``MAX_WIDTH`` counters a row; beyond that more singletons look
shared and are grouped with the rest, and the nodes stay the same.

Sums over a subtree need no walk: each node is owned by its smallest member, whose nodes are the lower end of its
path, so the subtree of a node is what its members own from its depth on.

Turns go by ``turn`` (null first), ties by the SHA-256 of (role, text); repeated rows are turns each.  A null role or text
is empty.  Rows without conv_id are in no conversation and take no part.  ``c % 100`` has the sign of c.  Other columns
are ignored, whatever their names; without conversations there are no nodes, not even a root.

A conversation may hold any share of the rows: what runs along it is carried from range partition to range
partition, and members of a node that is large are joined by broadcast of at most 4,096 nodes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roaslens.llm.common import cut, dealt, drop_cut, join_split, running, shuffle_parts, spanning

BLOCK, MOST = 100, 5
#: Rows of the sketch, its least and greatest width (counters a row), counters in a block that moves as one.
DEPTH, MIN_WIDTH, MAX_WIDTH, PIECE = 4, 1 << 14, 1 << 24, 1 << 16
#: Copies of the heads of base conversations, dealt to so many shares of a conversation's turns.
SALT = 16
NODE = ["x1", "x2"]
EMPTY = hashlib.sha256(b"").hexdigest()


def _placed(place: Column, said: Column) -> list[Column]:
    """Both hashes of the turn ``said`` at ``place``."""
    return [F.xxhash64(F.lit(seed), place.cast("long"), said) for seed in (1, 2)]


def turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, ``said`` (16 bytes that name role and text) and code points of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    return df.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", said.alias("said"), F.length(text).cast("long").alias("chars"))


def _heads(rows: DataFrame) -> DataFrame:
    """(base, head) of each conversation whose id is a multiple of ``BLOCK``: its first turns with their digests."""
    w = Window.partitionBy("conv_id").orderBy("turn", "said")
    first = rows.filter(F.col("conv_id") % BLOCK == 0).withColumn("depth", F.row_number().over(w).cast("long")).filter(F.col("depth") <= MOST)
    s1, s2 = _placed(F.col("depth"), F.col("said"))
    here = Window.partitionBy("conv_id").orderBy("depth")
    first = first.withColumns({"s1": s1, "s2": s2})
    first = first.withColumns({"x1": F.bit_xor("s1").over(here), "x2": F.bit_xor("s2").over(here)})
    node = F.struct("depth", "x1", "x2", F.col("x1").bitwiseXOR(F.col("s1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("s2")).alias("p2"), "chars")
    return first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(node)).alias("head"))  # MOST at most


def paths(df: DataFrame) -> DataFrame:
    """A row for each prefix of each rebuilt conversation: conv_id, depth, digest x1, x2, that of its parent p1, p2 (null at
    the root), code points of its last text, depth of the whole conversation."""
    rows = turns(df)
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    skip = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("long")
    heads = cut(_heads(rows))
    taken = F.least("skip", F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    at = lambda x: F.when(F.col("taken") > 0, F.element_at("head", F.col("taken").cast("int"))[x]).otherwise(F.lit(0).cast("long"))

    salted = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    own = rows.withColumns({"base": base, "skip": skip, "salt": F.pmod(F.xxhash64("turn", "said"), F.lit(SALT)).cast("int")})
    own = own.join(salted, ["base", "salt"], "left").withColumn("head", F.coalesce("head", F.array().cast(heads.schema["head"].dataType)))
    own = own.withColumn("taken", taken).select("conv_id", "turn", "said", "chars", "skip", "taken", at("x1").alias("h1"), at("x2").alias("h2"))
    own = dealt(own, ["conv_id", "turn", "said"])
    spans = spanning(own, "conv_id")
    own = running(own, "conv_id", ["turn", "said"], {"place": ("sum", F.lit(1).cast("long"))}, spans).filter("place > skip")
    own = own.withColumns({"depth": F.col("taken") + F.col("place") - F.col("skip"), "whole": F.col("taken") + F.col("place_total") - F.col("skip")})
    s1, s2 = _placed(F.col("depth"), F.col("said"))
    own = own.withColumns({"s1": s1, "s2": s2})
    own = running(own, "conv_id", ["place"], {"o1": ("xor", F.col("s1")), "o2": ("xor", F.col("s2"))}, spans)
    own = own.withColumns({"x1": F.col("h1").bitwiseXOR(F.col("o1")), "x2": F.col("h2").bitwiseXOR(F.col("o2"))})
    own = own.withColumns({"p1": F.col("x1").bitwiseXOR(F.col("s1")), "p2": F.col("x2").bitwiseXOR(F.col("s2"))})

    convs = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({"base": base, "skip": skip})
    convs = convs.join(heads, "base", "left").withColumn("head", F.coalesce("head", F.array().cast(heads.schema["head"].dataType)))
    convs = convs.withColumn("taken", taken).withColumn("whole", F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("skip")))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = F.array(F.struct(zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), none.alias("p1"), none.alias("p2"), zero.alias("chars")))
    tops = convs.select("conv_id", "whole", F.explode(F.concat(root, F.slice("head", F.lit(1), F.col("taken").cast("int")))).alias("node")).select("conv_id", "whole", "node.*")
    cols = ["conv_id", "depth", "x1", "x2", "p1", "p2", "chars", "whole"]
    return tops.select(*cols).unionByName(own.select(*cols))


def _cells(x1: np.ndarray, x2: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The counter of each digest in each row of the sketch, numbered over all rows."""
    step = x2.view(np.uint64) | np.uint64(1)
    at = x1.view(np.uint64)
    for row in range(DEPTH):
        yield (((at >> np.uint64(17)) ^ at) & np.uint64(width - 1)).astype(np.int64) + row * width
        at = at + step


def sketch(nodes: DataFrame, width: int) -> np.ndarray:
    """Bits of the count-min sketch of the digests: is the counter two or more?  The whole is ``DEPTH * width`` bits.

    Tasks count to two in memory and send blocks of two bits a counter; blocks are added as they come."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(DEPTH * width, np.uint8)
        for f in frames:
            for cells in _cells(f.x1.to_numpy(np.int64), f.x2.to_numpy(np.int64), width):
                at, n = np.unique(cells, return_counts=True)
                held[at] = np.minimum(2, held[at] + np.minimum(2, n))
        for block in np.flatnonzero(held.reshape(-1, PIECE).any(axis=1)):
            part = held[block * PIECE : (block + 1) * PIECE]
            yield pd.DataFrame({"block": [block], "bits": [zlib.compress(np.packbits([part >= 1, part >= 2]).tobytes(), 1)]})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}  # no more than the sketch
        for f in frames:
            for block, bits in zip(f.block, f.bits):
                planes = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8)).reshape(2, -1)
                held[block] = np.minimum(2, held.get(block, 0) + planes[0] + planes[1])
        for block, part in held.items():
            yield pd.DataFrame({"block": [block], "bits": [np.packbits(part >= 2).tobytes()]})

    spark = nodes.sparkSession
    blocks = nodes.select(*NODE).mapInPandas(count, "block long, bits binary")
    merged = blocks.repartition(shuffle_parts(spark), "block").mapInPandas(add, "block long, bits binary")
    out = np.zeros((DEPTH * width // PIECE, PIECE // 8), np.uint8)
    for r in merged.collect():
        out[r.block] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def _width(n: int) -> int:
    return min(MAX_WIDTH, max(MIN_WIDTH, 1 << (4 * n - 1).bit_length()))


def screened(nodes: DataFrame, width: int | None = None) -> DataFrame:
    """``nodes`` with ``shared`` (false: proven to have one member) and ``below_shared`` (false: so is its parent)."""
    spark = nodes.sparkSession
    width = width or _width(max(1, nodes.count()))
    bits = spark.sparkContext.broadcast(sketch(nodes.filter("depth > 0"), width))  # DEPTH * MAX_WIDTH / 8 bytes at most

    def many(x1: pd.Series, x2: pd.Series) -> np.ndarray:
        out = np.ones(len(x1), bool)
        for cells in _cells(x1.to_numpy(np.int64), x2.to_numpy(np.int64), width):
            out &= (bits.value[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
        return out

    def screen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            below = (f.depth <= 1) | many(f.p1, f.p2)
            yield f.assign(shared=(f.depth == 0) | (below & many(f.x1, f.x2)), below_shared=below)

    schema = ", ".join(f"{c} long" for c in nodes.columns) + ", shared boolean, below_shared boolean"
    p = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("p1", "p2")}  # the root's, which is 0 as digest too
    return nodes.withColumns(p).mapInPandas(screen, schema)


def _ends(members: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at a node, ascending and joined by commas; a stream, however many they are."""

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, sha, done = None, None, []
        for f in frames:
            for x1, x2, c in zip(f.x1, f.x2, f.conv_id):
                if (x1, x2) != node:
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (x1, x2), hashlib.sha256(str(c).encode())
                else:
                    sha.update(f",{c}".encode())
            if done:
                yield pd.DataFrame(done, columns=["x1", "x2", "ends_sha256"])
                done = []
        if node is not None:
            yield pd.DataFrame([(*node, sha.hexdigest())], columns=["x1", "x2", "ends_sha256"])

    ends = members.filter("depth = whole").select(*NODE, "conv_id")
    ends = ends.repartition(shuffle_parts(ends.sparkSession), *NODE).sortWithinPartitions(*NODE, "conv_id")
    return ends.mapInPandas(digest, "x1 long, x2 long, ends_sha256 string")


def trie(df: DataFrame, width: int | None = None) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations; ``width`` sets the counters in a row of the sketch."""
    every = cut(paths(df))
    flagged = cut(screened(every, width))
    drop_cut(every)
    members = flagged.filter("shared").drop("shared", "below_shared")
    total = members.count()

    groups = members.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("owner"), F.max("whole").alias("deepest"))
    groups = cut(groups)
    placed = join_split(members, groups, NODE, "n_convs", total)
    mine = F.col("owner") == F.col("conv_id")
    placed = placed.withColumns({
        "w": F.when(mine, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0),
        "l": F.when(mine & (F.col("depth") == F.col("whole")) & (F.col("deepest") == F.col("depth")), 1).otherwise(0),
        "e": F.when(F.col("depth") == F.col("whole"), 1).otherwise(0),
    })
    placed = dealt(placed, ["conv_id", "depth"])
    sums = {name: ("sum", F.col(name[0]).cast("long")) for name in ("weight", "leaf", "end")}
    placed = running(placed, "conv_id", ["depth"], sums, spanning(placed, "conv_id"))
    nodes = placed.groupBy(*NODE).agg(
        F.min("owner").alias("conv_id"), F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("n_convs").alias("n_convs"),
        F.sum(F.col("weight_total") - F.col("weight") + F.col("w")).alias("saved_tokens"),
        F.sum(F.col("leaf_total") + 1 - F.col("end_total")).alias("n_leaves"),  # a conversation that ends deeper owns its last node
    )
    nodes = cut(nodes)

    single = flagged.filter("not shared")
    kids = nodes.filter("depth > 0").select("p1", "p2").unionByName(single.filter("below_shared").select("p1", "p2"))
    kids = kids.groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")
    full = nodes.join(kids, NODE, "left").join(_ends(members), NODE, "left")
    full = full.select("conv_id", "depth", "p1", "p2", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens", ends)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = single.select(
        "conv_id", "depth", "p1", "p2", one.alias("n_convs"), (F.col("depth") < F.col("whole")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("depth") == F.col("whole"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY).alias("ends_sha256"), "below_shared",
    )

    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ask = full.filter("depth > 0").unionByName(alone.filter("below_shared").drop("below_shared"))
    parents = groups.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), "n_convs", F.col("owner").alias("parent")).withColumnRenamed("n_convs", "size")
    # a parent that is in no group is proven to have one member, which is this node's
    asked = join_split(ask, parents, ["p1", "p2"], "size", total, "left").withColumn("parent_conv_id", F.coalesce("parent", "conv_id"))
    root = full.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    local = alone.filter("not below_shared").withColumn("parent_conv_id", F.col("conv_id"))
    return asked.select(*out).unionByName(root.select(*out)).unionByName(local.select(*out))
