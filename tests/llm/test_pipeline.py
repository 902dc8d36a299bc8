"""The pipeline stage by stage against plain versions: every stage keeps clean documents and drops what it should."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from roaslens.llm.simhash import fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table():
    """Clean documents, junk, exact and near copies, repeated ids, null ids, shared passages, nulls."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(4000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    clean = [(i, text(rng.randint(30, 400))) for i in range(60)]
    rows = list(clean)
    rows += [(100 + i, clean[i][1]) for i in range(8)]  # copies
    rows += [(5, clean[5][1]), (6, text(50)), (None, text(60)), (None, text(60)), (None, clean[9][1])]  # repeated and null ids
    rows += [(200 + i, clean[20][1] + " one more end") for i in range(2)]
    rows += [(300, None), (301, ""), (302, " \n "), (303, "few words only"), (304, "spam spam spam spam spam spam spam spam " * 20), (305, "# $ % & | " * 30), (306, text(25) + "\n" + "same line\n" * 60)]
    passage = text(70)
    rows += [(400 + i, text(40) + " " + passage + " " + text(40)) for i in range(4)]
    rows += [(500, text(2600)), (501, "Ünïcödé " + text(40) + " " + passage)]
    return [(i, t, "x", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)]


def passes(text):
    """The rules of the policy: enough words, few repeated windows, few symbols, few repeated lines."""
    words = (text or "").encode().split()
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.encode().strip(b" \t\n\x0b\x0c\r")]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words) >= 20 and 100 * len(covered) <= 30 * len(words) and 10 * symbols <= len(words) and 10 * (len(lines) - len(set(lines))) <= 4 * len(lines)


def one_a_group(rows):
    """The row of the least id (null last) of each group of texts whose fingerprints link."""
    prints = [fingerprint(r[1], 3) for r in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                root[find(a)] = find(b)
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(find(k), []).append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()], list(groups.values())


def without_repeats(rows, n=200):
    where = Counter()
    for _, t, *_ in rows:
        data = (t or "").encode()
        where.update(data[i : i + n] for i in range(len(data) - n + 1))
    out = []
    for i, t, lang, source, _ in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - n + 1):
            if where[data[k : k + n]] > 1:
                gone[k : k + n] = True
        kept = bytes(x for x, g in zip(data, gone) if not g).decode("utf-8", "ignore")
        if kept.encode().strip(b" \t\n\x0b\x0c\r"):
            out.append((i, kept, lang, source, len(kept)))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(table(), SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*pipeline.COLUMNS).collect()), key=str)


def test_stages_against_plain_versions(spark, folder):
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "repeated_passages", "best_fit_packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = [r for r in table() if passes(r[1])]
    out = stages["quality_rules"](spark, docs, folder)
    assert out.columns == docs.columns and rows_of(out) == sorted(good, key=str) and len(good) > 60

    df = spark.createDataFrame(good, SCHEMA)
    kept, groups = one_a_group(good)
    got = rows_of(stages["near_duplicates"](spark, df, folder))
    assert len(got) == len(groups) and len(groups) < len(good) - 10
    for g in groups:  # one row of each group, of its least id
        mine = [r for r in got if r in g]
        assert len(mine) == 1 and (mine[0][0] is None, mine[0][0] or 0) == min((r[0] is None, r[0] or 0) for r in g)

    df = spark.createDataFrame(got, SCHEMA)
    want = without_repeats(got)
    out = stages["repeated_passages"](spark, df, folder)
    assert rows_of(out) == sorted(want, key=str) and sum(r[4] for r in want) < sum(r[4] for r in got)

    check_packing(spark.createDataFrame(want, SCHEMA), want, stages["best_fit_packing"](spark, spark.createDataFrame(want, SCHEMA), folder).collect())


def check_packing(df, rows, got):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = Counter()
    for i, t, *_ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        head = len(ids) % 2048 or 2048
        cuts = [0, *range(head, len(ids) + 1, 2048)]
        pieces.update((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(filled) <= -(-sum(r.length for r in got) // 2048) + 1


def test_run_is_its_stages(spark, folder):
    good = [r for r in table() if passes(r[1])]
    first = [min(g, key=lambda r: (r[0] is None, r[0] or 0, _text_hash(spark, r[1]))) for g in one_a_group(good)[1]]
    want = without_repeats(first)
    check_packing(None, want, pipeline.run(spark, folder).collect())


def _text_hash(spark, text):
    """The tie-breaker between rows of one id."""
    from pyspark.sql import functions as F

    return spark.createDataFrame([(text,)], "text string").select(F.xxhash64("text", F.lit(7))).first()[0]


def test_empty_table_and_clashing_names(spark, tmp_path):
    docs = spark.createDataFrame(table()[:12], SCHEMA).withColumnRenamed("lang", "lang")
    docs.limit(0).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    extra = {"n_words": "lang", "failures": "lang", "fp": "lang", "root": "lang", "kept": "lang", "spans": "lang", "ids": "lang", "sequence_id": "lang", "offset": "lang", "_text": "lang"}
    wide = docs.selectExpr("*", *[f"{v} AS {k}" for k, v in extra.items()])
    for _, stage in pipeline.STAGES:
        assert stage(spark, wide, "").count() >= 1


def test_digest_of_the_rows_does_not_depend_on_partitions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    marks = set()
    for n in (1, 9):
        out = docs.repartition(n)
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, out, folder)
        marks.add(hashlib.sha256(str(rows_of(out)).encode()).hexdigest())
    assert len(marks) == 1
