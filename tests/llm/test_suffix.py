"""Exact passages against a brute force over all windows."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roaslens.llm import suffix


def brute(rows, match):
    seen = Counter()
    texts = [(t or "").encode() for _, t in rows]
    for t in texts:
        seen.update(t[i : i + match] for i in range(len(t) - match + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - match + 1):
            if seen[t[i : i + match]] > 1:
                gone[i : i + match] = b"\1" * match
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def corpus(seed, match):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randint(5, 60)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(0, 40)), rng.choice(shared), text(rng.randint(0, 10)), rng.choice(shared)]
        rows.append((i, " ".join(parts[: rng.randint(1, 4)])))
    hot = text(40)
    rows += [(100 + i, text(3) + hot + text(2)) for i in range(40)]
    rows += [(200, None), (201, ""), (202, "a" * (3 * match)), (203, "ab" * (2 * match)), (204, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (205, text(3000))]
    return rows


@pytest.mark.parametrize(("match", "gram", "batches", "group"), [(40, 16, 3, 4096), (50, 10, 1, 2), (64, 33, 5, 4)])
def test_removes_what_brute_force_removes(spark, match, gram, batches, group):
    rows = corpus(match, match)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string").withColumn("n_removed", F.lit("y")).repartition(5)
    got = suffix.remove_repeats(docs, match, gram, batches, group)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) == brute(rows, match)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.remove_repeats(docs, 50, 16).count() == 0


def test_levels_are_logarithmic(spark):
    index = suffix.SuffixIndex(spark)
    for b in range(5):
        index.add(spark.range(b * 10, b * 10 + 12).select(F.col("id").alias("gram")))
    assert sorted(index.levels) == [1, 4]
    assert sorted(r.gram for r in index.matched().collect()) == [10, 11, 20, 21, 30, 31, 40, 41]
