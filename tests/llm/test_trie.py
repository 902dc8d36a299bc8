"""The trie of conversation prefixes against a plain one, with sketches of several widths and long conversations."""

import hashlib
import random
import zlib

import pytest

from roaslens.llm import trie
from roaslens.llm.common import dealt, running, spanning

COLUMNS = "conv_id long, turn long, role string, text string, depth string, x1 int"


def brute(rows):
    own = {}
    said = lambda r, t: (r or "", t or "")
    name = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    for c, turn, r, t in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, name(*said(r, t))[:16], said(r, t)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids, out = {}, []
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        c = kids.get(node, [])
        weight = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below[node] = (1 if not c else sum(below[k][0] for k in c), weight + sum(below[k][1] for k in c))
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(rebuilt[c]) == len(node))
        out.append((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(kids.get(node, [])), *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table(seed, n=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in [*rng.sample(range(0, 420), n), 0, 100, 300, 301, 302, 303, -5, -100, -150, None]:
        for k in range(rng.choice([0, 1, 2, 5, 6, rng.randint(0, longest)])):
            rows.append((c, rng.choice([k, k, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "a", "b", "é𝄞", None, ""])))
    same = [(k, "user", f"t{k}") for k in range(40)]
    rows += [(c, *x) for c in range(500, 530) for x in same]
    rows += [(c, *x) for c in range(530, 536) for x in same[: c - 520]] * 2
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_trie(spark, seed):
    rows = table(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS).repartition(5)
    got = [tuple(r) for r in trie.trie(df).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_width_of_the_sketch_changes_no_node(spark, monkeypatch):
    rows = table(3)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS).repartition(3)
    every = trie.paths(df).cache()
    n_shared = [trie.screened(every, w).filter("shared").count() for w in (trie.MIN_WIDTH, 1 << 18)]
    monkeypatch.setattr(trie, "_cells", lambda x1, x2, width: iter([x1 * 0]))  # all digests in one counter
    assert trie.screened(every, trie.MIN_WIDTH).filter("not shared").count() == 0
    assert sorted((tuple(r) for r in trie.trie(df, trie.MIN_WIDTH).collect()), key=str) == brute(rows)
    assert every.count() > n_shared[0] >= n_shared[1]


def test_one_member_is_proven(spark):
    """No prefix of several members is ever taken for a single one, and most single ones are found."""
    df = spark.createDataFrame([(*r, "x", 1) for r in table(4)], COLUMNS)
    flagged = trie.screened(trie.paths(df).cache())
    rows = flagged.collect()
    size = {}
    for r in rows:
        size[r.x1, r.x2] = size.get((r.x1, r.x2), 0) + 1
    assert all(size[r.x1, r.x2] == 1 for r in rows if not r.shared)
    assert sum(not r.shared for r in rows) > 0.9 * sum(n == 1 for n in size.values())


def test_running_over_split_groups(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    rows = [(rng.choice([1, 1, 1, 2, 3, 9]), k, rng.randint(-(2**62), 2**62)) for k in range(3000)]
    ranged = dealt(spark.createDataFrame(rows, "g long, k long, v long"), ["g", "k"])
    spans = spanning(ranged, "g")
    assert 1 in spans
    got = {(r.g, r.k): (r.n, r.n_total, r.x, r.x_total) for r in running(ranged, "g", ["k"], {"n": ("sum", F.lit(1).cast("long")), "x": ("xor", F.col("v"))}, spans).collect()}
    want, at = {}, {}
    for g, k, v in sorted(rows):
        n, x = at.get(g, (0, 0))
        at[g] = (n + 1, x ^ v)
        want[g, k] = at[g]
    assert got == {(g, k): (n, at[g][0], x, at[g][1]) for (g, k), (n, x) in want.items()}
