"""The operators against brute-force versions on a small fixture with nulls, ties and long texts."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from roaslens.llm import fingerprint, maxent, packing, pieces, quality, sharding, simhash, tokenfile, warc

BPE = public_tokenizers.path("byte_bpe_50k.json")


def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(n))
    rows = [(i, text(rng.randint(1, 120))) for i in range(60)]
    rows += [(100 + i, rows[i % 3][1]) for i in range(20)]
    rows += [(200 + i, rows[7][1] + f" tail{i}") for i in range(10)]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, text(6000)), (304, "one two three four five six seven eight " * 9), (305, "X\n\nX\nX $$$ | <>  y"), (306, "𝄞  a  b\r\n"), (5, rows[5][1]), (None, "no id here"), (None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in corpus()], "doc_id long, text string, n_words string, failures int").repartition(6).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def test_quality_measures(docs, empty):
    def brute(text):
        words = (text or "").encode().split()
        seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if x.encode().strip(b" \t\n\x0b\x0c\r")]
        return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), len(lines), sum("A" <= c <= "Z" for c in text or "")

    got = quality.ledger(docs)
    assert Counter((r.doc_id, *[r[m] for m in quality.MEASURES]) for r in got.collect()) == Counter((i, *brute(t)) for i, t in corpus())
    kept = {r.doc_id: r.ok for r in got.select("doc_id", quality.passes(quality.POLICIES["v2"]).alias("ok")).collect()}
    assert kept[304] is False and kept[303] is True
    policy = quality.POLICIES["v2"]
    masks = [r.failures for r in got.collect()]
    for r in quality.ablation(got, policy).collect():
        bit = next(1 << x.bit for x in quality.RULES if x.name == r.rule)
        assert r.n_failed == sum(bool(m & bit) for m in masks) and r.n_only == sum(m & policy.mask == bit for m in masks)
    assert quality.ledger(empty).count() == 0


def test_fingerprints(docs, empty):
    got = fingerprint.with_next(docs.select("doc_id", "text"))
    got = got.withColumn("edited", fingerprint.edited(F.col("text"), F.col("next_text")))
    for c, n in (("text", "own"), ("edited", "edit")):
        got = fingerprint.with_tree(got, c, n)
    got = got.withColumn("like", fingerprint.likeness("own", "edit")).withColumn("at", fingerprint.first_difference("own", "edit", "paragraphs")).collect()
    want = sorted(((i is not None, i or 0), t or "") for i, t in corpus())
    keys = [k for k, _ in want]
    assert len(got) == len(want)
    follows = {}
    for k, (_, t) in enumerate(want):
        follows.setdefault((keys[k], t), set()).add(want[(k + 1) % len(want)][0])
    texts = {}
    for k, t in want:
        texts.setdefault(k, set()).add(t)
    for r in got:
        key = ((r.doc_id is not None, r.doc_id or 0), r.text)
        single = len(texts[key[0]]) == 1
        if single and r.doc_id is not None:
            assert any(r.next_text in texts[n] for n in follows[key])
        half = len(r.text) // 2
        assert r.edited == r.text[: len(r.text) - half] + r.next_text[:half]
        assert (r.own_root == r.edit_root) == (r.text == r.edited)
        assert 0 <= r.like <= 1 and (r.at == -1) == (r.text == r.edited)
    roots = {}
    for r in got:
        roots.setdefault(r.own_root, set()).add(r.text)
    assert all(len(x) == 1 for x in roots.values()) and len(roots) == len({t or "" for _, t in corpus()})
    assert fingerprint.with_next(empty).count() == 0


def test_simhash_components(docs, empty):
    def brute(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = corpus()
    prints = [brute(t) for _, t in rows]
    for bits in (1, 2, 6):
        parent = list(range(len(rows)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a in range(len(rows)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= bits:
                    parent[find(a)] = find(b)
        least = {}
        for k, (i, _) in enumerate(rows):
            if i is not None:
                least[find(k)] = min(least.get(find(k), i), i)
        want = Counter((i, f"{prints[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows))
        if bits > 2:
            continue  # a radius of three bits is 43,745 variants a print: not for a small test
        got = simhash.near_duplicates(docs, 3, bits).select("doc_id", simhash.hex16("fp"), "component_id")
        assert Counter(tuple(r) for r in got.collect()) == want
    assert simhash.near_duplicates(empty, 3, 2).count() == 0


def test_keep_one_row_a_component(spark):
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))
    a, b, c, d, e, f, g = (text() for _ in range(7))
    rows = [(3, a), (5, a), (5, b)]  # 5's first text goes with 3, its other one stands alone
    rows += [(None, c), (None, d), (None, d), (None, a), (None, None), (None, "")]  # no ids, texts that differ
    rows += [(7, e), (7, f), (7, f), (9, f), (None, f), (1, g)]  # one id, unrelated texts
    rows = [(i, t, f"s{k}") for k, (i, t) in enumerate(rows)]
    prints = [simhash.fingerprint(t, 3) for _, t, _ in rows]
    for bits in (1, 2):
        groups = []  # of row numbers
        for k, p in enumerate(prints):
            near = [x for x in groups if any((p ^ prints[j]).bit_count() <= bits for j in x)]
            groups = [x for x in groups if x not in near] + [[k, *(j for x in near for j in x)]]
        want = Counter(min(((rows[k][0] is None, rows[k][0] or 0, rows[k][1] or "") for k in x)) for x in groups)
        assert len(want) == len(groups) == 8
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        for n in (1, 5):
            got = simhash.keep_one(docs.repartition(n), 3, bits).collect()
            assert Counter((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got) == want
            assert all(tuple(r) in rows for r in got)
    assert simhash.keep_one(docs.limit(0), 3, 2).count() == 0


def test_long_chain_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, i) for i in range(500, 600)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {**dict.fromkeys(range(201), 0), **dict.fromkeys([*range(500, 600), 1000], 500)}


def whole_ids(end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for _, x in corpus()]


def test_added_tokens_in_texts(spark):
    from tokenizers import Tokenizer

    mark = "<|endoftext|>"
    texts = ["one two", mark, f"one {mark} two", f"a{mark}b\n{mark}\n\n c", f" {mark} ", mark * 3, "<|endoftext|", f"one\n{mark}x {mark[:-1]} two", None, "one two three"]
    plain = Tokenizer.from_file(BPE)
    ids = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.count(50256) for x in ids] == [(t or "").count(mark) for t in texts]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.pieces(table, BPE, 0, 256).collect()
    assert {r.doc_id: bytes(r.ids) for r in got} == {i: np.array([*x, 0], "<u4").tobytes() for i, x in enumerate(ids)}
    starts = np.cumsum([0, *(len(x) + 1 for x in ids)]).tolist()
    read = tokenfile.read_documents(tokenfile.write(table, BPE, 50257, 2)).collect()
    assert {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in read} == {(i, starts[i], len(x) + 1, zlib.crc32(np.array([*x, 2], "<u4").tobytes())) for i, x in enumerate(ids)}


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        k = min((k for k, g in enumerate(gaps) if g >= n), key=gaps.__getitem__, default=None)
        if k is None:
            gaps.append(capacity - n)
        else:
            gaps[k] -= n
    return len(gaps)


def test_packing(docs, empty):
    got = packing.pack(packing.pieces(docs, BPE, 0, 256), 256).collect()
    want = Counter()
    for (i, _), ids in zip(corpus(), whole_ids(0), strict=True):
        head = len(ids) % 256 or 256
        cuts = [0, *range(head, len(ids) + 1, 256)]
        want.update((i, k, a, b - a, np.array(ids[a:b], "<u4").tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(filled) <= best_fit_decreasing([r.length for r in got], 256)
    assert packing.pack(packing.pieces(empty, BPE, 0, 256), 256).count() == 0
    joined = packing.sequences(packing.pack(packing.pieces(docs, BPE, 0, 256), 256)).collect()
    assert sum(len(r.ids) for r in joined) == 4 * sum(r.length for r in got) and all(len(r.ids) == 4 * r.length for r in joined)


def test_plan_uses_every_count():
    rng = random.Random(2)
    for capacity in (1, 7, 64):
        counts = {n: rng.randint(1, 50) for n in range(1, capacity + 1) if rng.random() < 0.6} or {1: 3}
        patterns = packing.plan(counts, capacity)
        used = Counter()
        for p, n in patterns:
            assert sum(a * k for a, k in p) <= capacity
            for a, k in p:
                used[a] += k * n
        assert used == counts


def test_token_files(docs, empty):
    manifest = tokenfile.write(docs, BPE, 50257, 2)
    got = tokenfile.read_documents(manifest).collect()
    ids = whole_ids(2)
    want = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in zip(corpus(), ids, strict=True))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    known = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert [x for x in known if x is not None] == sorted(x for x in known if x is not None) and known[0] is None
    one = tokenfile.Reader(manifest.first()["file"])
    assert (one.read(3, 40) == one.read(0, one.n)[3:40]).all()
    assert tokenfile.read_documents(tokenfile.write(empty, BPE, 50257, 2)).count() == 0


def test_bit_packing_round_trip():
    rng = np.random.default_rng(1)
    for width in (1, 5, 15, 16, 17, 31, 32):
        for n in (0, 1, 63, 64, 1000):
            ids = rng.integers(0, 2**width, n, dtype=np.uint64).astype(np.uint32)
            data = tokenfile.pack_bits(ids, width)
            assert len(data) == -(-n // 64) * 8 * width and (tokenfile.unpack_bits(data, width, n) == ids).all()


def test_sharding(docs, empty):
    rows = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("size"))
    got = sharding.shard(rows, 7, 99, ["doc_id", "size"]).collect()
    n = len(corpus())
    assert sorted(r.row for r in got) == list(range(n))
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert sharding.row_at(r.shard, r.slot, 7, n, 99) == r.row
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shard(empty.select("doc_id"), 7, 99, ["doc_id"]).count() == 0
    for n in (1, 2, 5, 1000):
        p = sharding.permute(np.arange(n), n, 3)
        assert sorted(p.tolist()) == list(range(n)) and (sharding.permute(p, n, 3, back=True) == np.arange(n)).all()


def test_pieces_slice_by_slice(monkeypatch):
    texts = ["", " ", "  ", "a  b ", " x", "one two three four five six", "\u2581 y\u2581\u2581z", "a\nb c\n\n d", "word " * 40]
    whole = pieces.Codec(public_tokenizers.path("piece_bpe_32k.model")).encode(texts)
    monkeypatch.setattr(pieces, "_SLICE", 5)
    assert pieces.Codec(public_tokenizers.path("piece_bpe_32k.model")).encode(texts) == whole


def test_pieces_against_the_other_library(docs, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    peer = sentencepiece.SentencePieceProcessor(model_file=path)
    got = pieces.decode(pieces.encode(docs, path), path).collect()
    assert all(r.parity for r in got) and len(got) == len(corpus())
    for r in got:
        ids = peer.encode(r.text or "")
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.decoded == peer.decode(ids)
    assert pieces.encode(empty, path).count() == 0


def test_warc_records(spark):
    page = '<html lang="de"><head><title>A &amp; B</title><script>x="</p>"</script></head><body><!-- no --><p>Eins<br>Zwei <a href="/x?a=1&amp;b=2">drei</a></p><p>' + "wort " * 50000 + "</p></body></html>"
    rows = [(1, "http://a/b", page), (2, None, None), (3, "http://c", ""), (1, "http://a/b", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.derivatives(warc.responses(pages, "2024-01-01T00:00:00Z")).collect()
    assert len(got) == 8
    for r in got:
        ((headers, block),) = warc.parse(bytes(r.record))
        assert block == bytes(r.block) and headers["WARC-Refers-To"] == r.refers_to and headers["WARC-Block-Digest"] == warc.digest(block) == r.block_digest
        assert headers.get("WARC-Target-URI") == r.target_uri and headers["WARC-Type"] == r.kind and headers["WARC-Date"] == "2024-01-01T00:00:00Z"
    first = {r.kind: bytes(r.block).decode() for r in got if r.page_id == 1}
    assert first["conversion"].startswith("A & B\nEins\nZwei drei\nwort wort") and "outlink: /x?a=1&b=2\r\n" in first["metadata"] and "language: de" in first["metadata"]
    assert len({r.record_id for r in got}) == 6
    assert warc.derivatives(warc.responses(pages.limit(0), "2024-01-01T00:00:00Z")).count() == 0


def test_model_scores(spark, docs, empty):
    got = maxent.fit_and_score(docs).collect()
    rows = corpus()
    held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for _, t in rows]
    counts = Counter(w for (i, _), x in zip(rows, tokens, strict=True) if not held(i) for w in x)
    total, distinct = sum(counts.values()), len(counts)
    base = lambda x: round(sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in x), 6)
    want = Counter((i, held(i), len(x), sum(w in counts for w in x), total, base(x)) for (i, _), x in zip(rows, tokens, strict=True))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert maxent.fit_and_score(empty).count() == 0


def test_model_is_a_distribution_and_learns():
    rng = np.random.default_rng(3)
    words = maxent._mix(np.arange(1, 41, dtype=np.uint64)).view(np.int64)
    steps = rng.integers(0, 2, 200_000)
    chain = words[np.cumsum(1 + steps) % 40]  # the next word is one of two
    ends = np.arange(100, len(chain) + 1, 100)
    t = maxent.Trainer(None)
    for _ in range(3):
        t.learn(chain, ends)
    code = maxent.code_of(chain)
    outer, _ = maxent.features(*maxent.history(chain, ends), code // maxent.WAYS)
    p = maxent._softmax(t.weights, outer)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    share = np.bincount(code // maxent.WAYS, minlength=maxent.WAYS) / len(code)
    assert np.log(p[np.arange(len(code)), code // maxent.WAYS]).mean() > np.log(share[code // maxent.WAYS]).mean() + 0.3


def test_model_is_whole_and_its_update_is_adagrad():
    assert (maxent.WAYS, maxent.ROWS, maxent.BATCH, maxent.RATE) == (32, 1 << 17, 16384, 0.1)
    rng = np.random.default_rng(4)
    one, two, first = rng.integers(1, 50, 3000).astype(np.uint64), rng.integers(1, 50, 3000).astype(np.uint64), rng.integers(0, maxent.WAYS, 3000)
    outer, inner = maxent.features(one, two, first)
    assert outer.shape == inner.shape == (3000, 4)
    skips = {}
    for a, b, r in zip(two.tolist(), first.tolist(), inner[:, 2].tolist(), strict=True):
        assert skips.setdefault((a, b), r) == r  # the skip feature depends on the token two back and the class alone
    weights, squares, seen = np.zeros((maxent.ROWS, maxent.WAYS)), np.full(maxent.ROWS, 1e-6), np.zeros(maxent.ROWS)
    t = maxent.Trainer(None)
    for rows in (outer, inner, outer):
        target = rng.integers(0, maxent.WAYS, len(rows))
        p = np.exp(weights[rows].sum(axis=1))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(rows)), target] -= 1
        total = np.zeros_like(weights)
        np.add.at(total, rows.ravel(), np.repeat(p, 4, axis=0))
        np.add.at(seen, rows.ravel(), 1)
        squares += (total * total).mean(axis=1)
        weights -= (maxent.RATE / np.sqrt(squares))[:, None] * total
        t.update(rows, target)
    assert np.allclose(t.weights, weights, atol=1e-4) and (t.seen == seen).all()


def test_model_sums_and_shares():
    """Sums by table row for rows that one, two and all tokens have; shares of very large and usual weights."""
    rng = np.random.default_rng(5)
    n = 5000
    rows = np.stack([np.full(n, 7), rng.integers(10, 40, n), rng.integers(100, 4000, n), 10_000 + np.arange(n)]).astype(np.int64).T
    error = rng.normal(size=(n, maxent.WAYS)).astype(np.float32)
    row, hits, total = maxent._sums(error, rows)
    want = np.zeros((maxent.ROWS, maxent.WAYS))
    np.add.at(want, rows.ravel(), np.repeat(error.astype(np.float64), 4, axis=0))
    count = np.bincount(rows.ravel(), minlength=maxent.ROWS)
    assert (row == np.flatnonzero(count)).all() and (hits == count[row]).all() and {1, 2, n} <= set(hits.tolist())
    assert np.allclose(total, want[row], atol=1e-3)
    row, hits, total = maxent._sums(error[:1], rows[:1])
    assert row.tolist() == sorted(rows[0].tolist()) and hits.tolist() == [1] * 4 and (total == error[0]).all()
    for scale in (1, 1000):
        weights = rng.normal(scale=scale, size=(maxent.ROWS, maxent.WAYS)).astype(np.float32)
        logits = weights[rows].astype(np.float64).sum(axis=1)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        got = maxent._softmax(weights, rows)
        assert np.isfinite(got).all() and np.allclose(got, p / p.sum(axis=1, keepdims=True), atol=2e-4)
        target = rng.integers(0, maxent.WAYS, n)
        assert (maxent._share(weights, rows, target) == got[np.arange(n), target]).all()
    assert (maxent._row_sums(error) == error.sum(axis=1, keepdims=True)).all()  # to the last bit: scores stay as they were


def test_pipeline_on_small_table(spark):
    import corpus_pipeline as c

    assert [n for n, _ in c.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "best_fit_packing"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        docs = out
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    got = c.run(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in got} == ids
    assert sum(r.length for r in got) > 0 and len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_sums_index_is_kept_up():
    rng = random.Random(6)
    left = np.array([0, *[rng.choice([0, 1, 2, 5]) for _ in range(60)]])
    sums = packing.Sums(left.copy())
    while (sums.left > 0).any():
        have = [x for x in range(1, 61) if sums.left[x]]
        assert sums.pair.tolist() == [sum(a + b == s for a in have for b in have) for s in range(61)]
        assert sums.triple.tolist() == [sum(a + b + c == s for a in have for b in have for c in have) for s in range(61)]
        gap = rng.randint(1, 60)
        combo = sums.fill(gap)
        if combo:
            assert sum(combo) == gap and len(combo) <= 3
        best = 1 if gap in have else 2 if any(sums.left[a] >= 1 + (2 * a == gap) and gap - a in have for a in have) else 3
        assert combo is None or len(combo) == best
        assert sums.take(combo or [have[0]], 1) == 1


def test_plan_reaches_the_bound_with_pairs_and_triples(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = packing.pieces(docs, BPE, 0, 2048, digests=True).groupBy("length").count().collect()
    counts = {r.length: r["count"] for r in rows}
    exact, rest = packing.parts(counts, 2048)
    assert sum(n for _, n in exact + rest) == -(-sum(k * n for k, n in counts.items()) // 2048) == 481
    assert all(sum(combo) == 2048 for combo, _ in exact)
    by = Counter()
    for combo, n in exact:
        by[len(combo) - 1] += n
    assert by[1] and by[2] and by[3]
    assert sum(n for _, n in packing.best_fit(np.array([counts.get(k, 0) for k in range(2049)]), 2048)) >= 481
