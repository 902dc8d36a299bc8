"""Hashed maximum-entropy language model with a class-factored softmax.

A token's 64-bit hash gives its class (``WAYS`` of them), its subclass (``WAYS`` in each) and so its
bucket.  The model is P(class | history) P(subclass | class, history) P(token | bucket): the first two
are softmaxes over weights of hashed features (bias, previous token, the one before it skipped to,
both together; the subclass features are hashed with the class), the third the add-one share of the
token among its bucket's training tokens.

Work is in blocks: a scan turns documents into blocks of token numbers with the block's own
vocabulary; vocabularies are counted over the whole table by one shuffle on the token hash, and each
block gets the counts of its own tokens back, so no task and not the driver holds the vocabulary.
Training is distributed gradient descent with mixing: every partition of blocks makes a pass of
minibatch updates (Adagrad by row) from the same start, the tables are averaged by how often each saw
a row, in a tree of bounded groups, and the mean starts the next round.  The table's size is fixed by
``ROWS`` and ``WAYS`` (so the driver and the broadcast hold 8 MB), what is gathered to fit it grows
with the input.

Tokens are words between ASCII white space, A-Z lowered, then one end a document.  Words are told
apart by their 64-bit XXH64.  Null texts count as empty (the end alone); equal rows score alike; an
empty table gives an empty result; a null doc_id counts as the text "" for the split.
"""

from __future__ import annotations

import itertools
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roaslens.llm.bpe import runs
from roaslens.llm.common import cut, drop_cut, text_or_empty

WAYS, ROWS = 32, 1 << 17
BATCH, CHUNK = 16384, 512
RATE = 0.1
MIX_FAN_IN = 32
BLOCK_CHARS = 1 << 24
END = b"\n"  # no word holds white space
_U = np.uint64


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % 7 == 2


BLOCKS = "block long, doc_ids array<long>, held array<boolean>, ends array<int>, vocab array<long>, tf array<int>, tokens binary"


def token_blocks(docs: DataFrame) -> DataFrame:
    """Blocks (``BLOCKS``): ``tokens`` number the block's ``vocab`` (hashes); ``tf`` counts training tokens."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = 0
            for some in runs(pdf["text"].tolist(), BLOCK_CHARS):
                rows = pdf.iloc[done : done + len(some)]
                done += len(some)
                number = defaultdict(itertools.count(1).__next__, {END: 0})  # in the order in which tokens are met
                parts = []
                for text in some:
                    words = text.encode("utf-8", "surrogatepass").lower().split()
                    words.append(END)
                    parts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                tokens, sizes = np.concatenate(parts), np.array([len(x) for x in parts])
                held = rows["held"].to_numpy(bool)
                tf = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(number))
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number)).view(np.int64)
                yield pd.DataFrame({
                    "block": [uuid.uuid4().int >> 65], "doc_ids": [[None if pd.isna(x) else int(x) for x in rows["doc_id"]]], "held": [held.tolist()],
                    "ends": [np.cumsum(sizes).astype(np.int32)], "vocab": [hashes], "tf": [tf.astype(np.int32)], "tokens": [tokens.tobytes()],
                })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held"), text_or_empty("text").alias("text"))
    return rows.mapInPandas(scan, BLOCKS)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def code_of(hashes: np.ndarray) -> np.ndarray:
    """Bucket (class * WAYS + subclass) of token hashes."""
    return (_mix(hashes.astype(np.int64).view(np.uint64)) % _U(WAYS * WAYS)).astype(np.int64)


def history(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token before each one and the one before that; ``hashes`` are the tokens of whole documents, ``ends`` where each ends."""
    h = hashes.view(np.uint64)
    start = np.zeros(len(h), bool)
    start[0] = True
    start[ends[:-1]] = True
    one = np.roll(h, 1)
    one[start] = _U(1)  # nothing before
    two = np.roll(one, 1)
    two[start] = _U(2)
    return one, two


def features(one: np.ndarray, two: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table for tokens with this history and these classes (``first``): (n, 4) for the
    class and (n, 4) for the subclass; a batch at a time, as they are wide."""
    # column by column, each in one stretch of memory; ROWS is a power of two
    keys = [np.full(len(one), 3, np.uint64), one, two * _U(0x9E3779B97F4A7C15) + _U(5), _mix(two) * _U(0x94D049BB133111EB) + one]
    keys = [_mix(x + _U(0xA24BAED4963EE407 * (k + 1) % 2**64)) for k, x in enumerate(keys)]
    own = (first.astype(np.uint64) + _U(1)) * _U(0xD6E8FEB86659FD93)
    outer = np.stack([x & _U(ROWS - 1) for x in keys])
    inner = np.stack([_mix(x + own) & _U(ROWS - 1) for x in keys])
    return outer.view(np.int64).T, inner.view(np.int64).T


def _row_sums(x: np.ndarray) -> np.ndarray:
    """``x.sum(axis=1, keepdims=True)`` of ``WAYS`` columns, with numpy's order of additions, all rows at a time."""
    s = x[:, :8] + x[:, 8:16]
    for at in range(16, WAYS, 8):
        s += x[:, at : at + 8]
    while s.shape[1] > 1:
        s = s[:, ::2] + s[:, 1::2]
    return s


def _powers(weights: np.ndarray, rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """The softmax's numerators, exp of the logits less their greatest, for stretches of ``rows`` that a core's cache
    holds; the next stretch takes the same memory."""
    held, more = np.empty((2, min(len(rows), 2048), WAYS), np.float32)
    for at in range(0, len(rows), 2048):
        own = slice(at, min(at + 2048, len(rows)))
        part, logits = rows[own], held[: own.stop - at]
        np.take(weights, part[:, 0], axis=0, out=logits, mode="clip")
        for k in range(1, rows.shape[1]):
            logits += np.take(weights, part[:, k], axis=0, out=more[: len(part)], mode="clip")
        top = logits
        while (half := top.shape[1] // 2) > 0:
            top = np.maximum(top[:, :half], top[:, half:])
        logits -= top
        np.exp(logits, out=logits)
        yield own, logits


def _softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), WAYS), np.float32)
    for own, x in _powers(weights, rows):
        np.divide(x, _row_sums(x), out=out[own])
    return out


def _share(weights: np.ndarray, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The softmax at ``target``."""
    out = np.empty(len(rows), np.float32)
    for own, x in _powers(weights, rows):
        np.divide(x[np.arange(len(x)), target[own]], _row_sums(x)[:, 0], out=out[own])
    return out


def _sums(error: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that occur in ``rows``, ascending, how often each does, and the sum of ``error`` over its tokens."""
    pairs = (rows.T << 32 | np.arange(len(rows))).ravel()  # table row and token
    pairs.sort()
    row, token = pairs >> 32, pairs & 0xFFFFFFFF
    start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    hits = np.diff(start, append=len(row))
    total = error.take(token[start], axis=0)  # all of it for most rows
    two = np.flatnonzero(hits == 2)
    total[two] += error.take(token[start[two] + 1], axis=0)
    many = np.flatnonzero(hits > 2)
    if len(many):  # one lane of the softmax at a time, as a lane fits the cache
        token = token[np.repeat(hits > 2, hits)]
        begins = np.cumsum(hits[many]) - hits[many]
        lanes, held, wide = np.ascontiguousarray(error.T), np.empty(len(token), np.float32), np.empty(len(token))
        sums = np.empty((WAYS, len(many)))
        for lane in range(WAYS):
            np.take(lanes[lane], token, out=held, mode="clip")
            wide[:] = held  # sums in float64
            np.add.reduceat(wide, begins, out=sums[lane])
        total[many] = sums.T
    return row[start], hits, total


class Trainer:
    def __init__(self, start: np.ndarray | None):
        self.weights = np.zeros((ROWS, WAYS), np.float32) if start is None else start.astype(np.float32)
        self.seen = np.zeros(ROWS, np.float32)
        self.squares = np.full(ROWS, 1e-6, np.float32)

    def update(self, rows: np.ndarray, target: np.ndarray) -> None:
        """One minibatch gradient step (Adagrad by row): the gradient is summed by row, over the rows the batch has, before
        it is applied."""
        error = _softmax(self.weights, rows)
        error[np.arange(len(target)), target] -= 1
        row, hits, total = _sums(error, rows)
        self.seen[row] += hits
        for at in range(0, len(row), 2048):  # what a core's cache holds
            r, step = row[at : at + 2048], total[at : at + 2048]
            self.squares[r] += _row_sums(step * step)[:, 0] / WAYS
            step *= (RATE / np.sqrt(self.squares[r]))[:, None]
            held = self.weights.take(r, axis=0)
            held -= step
            self.weights[r] = held

    def learn(self, hashes: np.ndarray, ends: np.ndarray) -> None:
        code = code_of(hashes)
        one, two = history(hashes, ends)
        for at in range(0, len(code), BATCH):
            part = slice(at, at + BATCH)
            outer, inner = features(one[part], two[part], code[part] // WAYS)
            self.update(outer, code[part] // WAYS)
            self.update(inner, code[part] % WAYS)


def train(blocks: DataFrame, rounds: int = 1) -> np.ndarray:
    """Weights (``ROWS`` x ``WAYS``, float16) learnt from the training documents of all blocks."""
    spark = blocks.sparkSession
    weights = None
    schema = "chunk int, trainer int, seen binary, weights binary"
    for _ in range(rounds):
        start = spark.sparkContext.broadcast(weights)  # fixed size

        def fit(batches: Iterator[pd.DataFrame], start=start) -> Iterator[pd.DataFrame]:
            t, trainer = None, 0
            for pdf in batches:
                for b in pdf.itertuples():
                    ends = np.asarray(b.ends, np.int64)
                    keep = ~np.asarray(b.held, bool)
                    if not keep.any():
                        continue
                    if t is None:
                        t, trainer = Trainer(start.value), int(b.trainer)
                    sizes = np.diff(ends, prepend=0)
                    hashes = np.asarray(b.vocab, np.int64)[np.frombuffer(b.tokens, np.int32)[np.repeat(keep, sizes)]]
                    sizes = sizes[keep]
                    # about a million tokens at once, whole documents
                    cuts = np.searchsorted(np.cumsum(sizes), np.arange(1 << 20, int(sizes.sum()) + (1 << 20), 1 << 20), "left") + 1
                    before = 0
                    for group in np.split(sizes, np.unique(cuts[cuts < len(sizes)])):
                        n = int(group.sum())
                        t.learn(hashes[before : before + n], np.cumsum(group))
                        before += n
            if t is not None:
                chunks = [slice(c, c + CHUNK) for c in range(0, ROWS, CHUNK)]
                made = [(c.start // CHUNK, trainer, t.seen[c].tobytes(), t.weights[c].astype(np.float16).tobytes()) for c in chunks if t.seen[c].any()]
                for at in range(0, len(made), 64):
                    yield pd.DataFrame(made[at : at + 64], columns=["chunk", "trainer", "seen", "weights"])

        def mean(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("trainer")
            seen = np.stack([np.frombuffer(x, np.float32) for x in pdf["seen"]])
            total = seen.sum(axis=0)
            held = np.stack([np.frombuffer(x, np.float16).reshape(CHUNK, WAYS) for x in pdf["weights"]]).astype(np.float32)
            mixed = (held * seen[:, :, None]).sum(axis=0) / np.maximum(total, 1)[:, None]
            return pd.DataFrame([(int(pdf["chunk"].iloc[0]), int(pdf["trainer"].iloc[0]) // MIX_FAN_IN, total.tobytes(), mixed.astype(np.float16).tobytes())], columns=pdf.columns)

        source = blocks.select("held", "ends", "vocab", "tokens", F.spark_partition_id().alias("trainer"))
        many = source.rdd.getNumPartitions()
        tables = source.mapInPandas(fit, schema)
        while True:  # a group never holds more than MIX_FAN_IN tables of a chunk
            tables = tables.groupBy("chunk", F.floor(F.col("trainer") / MIX_FAN_IN).alias("g")).applyInPandas(lambda pdf: mean(pdf), schema)
            many = -(-many // MIX_FAN_IN)
            if many <= 1:
                break
        fresh = np.zeros((ROWS, WAYS), np.float16) if weights is None else weights.copy()
        for r in tables.select("chunk", "seen", "weights").collect():  # the table, of fixed size
            part = slice(r["chunk"] * CHUNK, (r["chunk"] + 1) * CHUNK)
            seen = np.frombuffer(r["seen"], np.float32) > 0
            fresh[part][seen] = np.frombuffer(r["weights"], np.float16).reshape(CHUNK, WAYS)[seen]
        weights = fresh
    return weights if weights is not None else np.zeros((ROWS, WAYS), np.float16)


def vocabulary_counts(blocks: DataFrame) -> tuple[DataFrame, int, int, np.ndarray]:
    """(block, counts by place in the block's vocabulary), training tokens, distinct ones, and by
    bucket (n, 2) both; a token's rows are one a block."""
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("vocab", "tf")).alias("pos", "x")).select("block", "pos", F.col("x.vocab").alias("hash"), F.col("x.tf").alias("tf"))
    same = Window.partitionBy("hash")
    counted = cut(pairs.select("block", "pos", F.when(F.row_number().over(same.orderBy("block")) == 1, F.col("hash")).alias("hash"), F.sum("tf").over(same).alias("c")))

    @F.pandas_udf("int")
    def bucket(h: pd.Series) -> pd.Series:
        return pd.Series(code_of(h.to_numpy(np.int64)).astype(np.int32))

    known = counted.filter("hash is not null and c > 0")
    by = known.groupBy(bucket("hash").alias("bucket")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()  # WAYS * WAYS rows
    sums = np.zeros((WAYS * WAYS, 2))
    for r in by:
        sums[r["bucket"]] = r["n"], r["v"]
    lists = counted.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "c"))), lambda x: x["c"]).alias("counts"))
    return lists, int(sums[:, 0].sum()), int(sums[:, 1].sum()), sums


def score(blocks: DataFrame, counts: DataFrame, total: int, distinct: int, sums: np.ndarray, weights: np.ndarray) -> DataFrame:
    model = blocks.sparkSession.sparkContext.broadcast(weights)  # fixed size

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = None
        share = np.log10(1.0 / (sums.sum(axis=1) + 1))
        for pdf in batches:
            table = model.value.astype(np.float32) if table is None else table
            for b in pdf.itertuples():
                ends = np.asarray(b.ends, np.int64)
                tokens, vocab, c = np.frombuffer(b.tokens, np.int32), np.asarray(b.vocab, np.int64), np.asarray(b.counts, np.int64)
                seen = np.log10(c + 1.0)
                code = code_of(vocab)
                value = (seen + share[code])[tokens]
                hashes, codes = vocab[tokens], code[tokens]
                begins = np.concatenate(([0], ends[:-1]))
                cuts = np.unique(np.append(np.searchsorted(ends, np.arange(1 << 20, int(ends[-1]), 1 << 20)) + 1, len(ends)))
                last = 0
                for upto in cuts.tolist():  # about a million tokens at once, whole documents
                    lo, hi = int(begins[last]), int(ends[upto - 1])
                    one, two = history(hashes[lo:hi], ends[last:upto] - lo)
                    last = upto
                    for at in range(0, hi - lo, BATCH):
                        part, own = slice(at, min(at + BATCH, hi - lo)), slice(lo + at, min(lo + at + BATCH, hi))
                        outer, inner = features(one[part], two[part], codes[own] // WAYS)
                        value[own] += np.log10(_share(table, outer, codes[own] // WAYS).astype(np.float64) + 1e-30)
                        value[own] += np.log10(_share(table, inner, codes[own] % WAYS).astype(np.float64) + 1e-30)
                base = seen[tokens] - np.log10(total + distinct + 1.0)
                yield pd.DataFrame({
                    "doc_id": pd.array([None if pd.isna(x) else int(x) for x in b.doc_ids], "Int64"), "held_out": np.asarray(b.held, bool), "n_tokens": ends - begins,
                    "n_known": np.add.reduceat((c > 0)[tokens].astype(np.int64), begins), "train_tokens": total,
                    "base_score": np.add.reduceat(base, begins), "score": np.add.reduceat(value, begins),
                })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.join(counts, "block").select("doc_ids", "held", "ends", "vocab", "counts", "tokens").mapInPandas(scan, schema)


def fit_and_score(docs: DataFrame, rounds: int = 1) -> DataFrame:
    """Scores of all documents by a model trained on those that are not held out."""
    blocks = cut(token_blocks(docs))
    counts, total, distinct, sums = vocabulary_counts(blocks)
    counts = cut(counts)
    weights = train(blocks, rounds)
    out = cut(score(blocks, counts, total, distinct, sums, weights))
    drop_cut(blocks, counts)
    return out
