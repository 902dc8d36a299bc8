"""Exact repeated passages by a logarithmic family of suffix arrays.

Every string of ``match`` bytes that starts at two places is found, across and within documents, and
all bytes such strings cover can be cut.  The suffix arrays are sparse: they hold the positions of
``anchors`` (one or two in ``match`` bytes), each with the hash of the ``gram`` bytes that follow,
sorted by that hash, which finds all matches of ``match`` bytes or more because equal windows have
equal anchors.

``SuffixIndex`` takes batches.  A batch's array is merge-scanned against each level for grams in
common (and against itself), which are kept as matches; then it becomes a level, and levels of
equal size merge, so a batch meets a logarithmic number of levels and an entry is rewritten as often.
``repeated_spans`` settles the matched anchors:

* anchors whose whole context (all windows of the anchor) occurs twice: every window repeats;
* a context that occurs once in a gram with others (a passage's edge): its windows' hashes are
  compared with those of the gram's other distinct contexts, one row a context.  Grams with up to
  ``GROUP`` distinct contexts are compared in the task that holds the gram; those with more are
  spread over all tasks window by window.

Equality is that of two independent 64-bit hashes (gram and context, or gram and window).

A null text is empty; texts shorter than ``match`` bytes have no windows; rows equal in id and text are
copies of each other like any two documents.  Empty tables give empty results, other columns stay,
but for those named like a result (``n_removed``, ``kept``), which it replaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaslens.llm.anchors import anchors, window_hashes
from roaslens.llm.bpe import runs
from roaslens.llm.common import cut, drop_cut, row_key, shuffle_parts, text_or_empty

ANCHORS = "k1 long, k2 long, gram long, context long, at int, lo int, hi int"
GROUP = 4096


def document_anchors(docs: DataFrame, match: int, gram: int, text_col: str = "text") -> DataFrame:
    """Anchors of all texts (``ANCHORS``); (k1, k2) is ``row_key`` of the document."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = 0
            for some in runs(pdf["text"].tolist()):
                keys = pdf[["k1", "k2"]].to_numpy(np.int64)[done : done + len(some)]
                done += len(some)
                a = anchors([t.encode("utf-8", "surrogatepass") for t in some], match, gram)
                yield pd.DataFrame({"k1": keys[a["row"], 0], "k2": keys[a["row"], 1], "gram": a["gram"], "context": a["context"]} | {k: a[k].astype(np.int32) for k in ("at", "lo", "hi")})

    return docs.select(*row_key(), text_or_empty(text_col).alias("text")).mapInPandas(scan, ANCHORS)


class SuffixIndex:
    """Levels of sorted runs of gram hashes; ``levels`` maps a size in batches to the run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: dict[int, DataFrame] = {}
        self.matches: list[DataFrame] = []

    def add(self, batch: DataFrame) -> DataFrame:
        """Index a batch of anchors; returns (and keeps) its grams that occur twice in the batch or in an
        earlier one."""
        run = cut(batch.groupBy("gram").agg(F.count("*").alias("n")).sortWithinPartitions("gram"))
        found = run.filter("n > 1").select("gram")
        for level in self.levels.values():
            found = found.union(run.join(level, "gram", "left_semi").select("gram"))
        found = cut(found.distinct())
        self.matches.append(found)
        size, run = 1, run.select("gram")
        held = [run]
        while size in self.levels:  # equal levels merge, and the merged one may meet its equal
            held.append(self.levels.pop(size))
            size *= 2
        if len(held) > 1:
            merged = held[0]
            for other in held[1:]:
                merged = merged.union(other)
            run = cut(merged.distinct().sortWithinPartitions("gram"))
        self.levels[size] = run
        return found

    def matched(self) -> DataFrame:
        out = self.matches[0]
        for m in self.matches[1:]:
            out = out.union(m)
        return out.distinct()


def _edges_by_gram(rows: DataFrame, match: int) -> DataFrame:
    """Spans (k1, k2, start, end) of open contexts' windows that another context of the gram has."""

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [window_hashes(b, match) for b in pdf["bytes"]]
        sizes = np.array([len(x) for x in found])
        gram, hashes = np.repeat(pdf["gram"].to_numpy(np.int64), sizes), np.concatenate(found)
        order = np.lexsort((hashes, gram))
        same = (gram[order][1:] == gram[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        row = np.repeat(np.arange(len(pdf)), sizes)
        start = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(pdf["lo"].to_numpy(np.int64), sizes)
        keep = np.flatnonzero(twice & pdf["open"].to_numpy(bool)[row])
        row, start = row[keep], start[keep]
        if not len(row):
            return pd.DataFrame({"k1": row, "k2": row, "start": row.astype(np.int32), "end": row.astype(np.int32)})
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)))
        first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(row)) - 1
        keys = pdf[["k1", "k2"]].to_numpy(np.int64)[row[first]]
        return pd.DataFrame({"k1": keys[:, 0], "k2": keys[:, 1], "start": start[first].astype(np.int32), "end": (start[last] + match).astype(np.int32)})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # rows come sorted by gram; the last gram may go on in the next batch
        for pdf in batches:
            held = pdf if held is None else pd.concat((held, pdf), ignore_index=True)
            done = held["gram"] != held["gram"].iloc[-1]
            if done.any():
                yield settle(held[done].reset_index(drop=True))
                held = held[~done].reset_index(drop=True)
        if held is not None and len(held):
            yield settle(held)

    near = rows.repartition(shuffle_parts(rows.sparkSession), "gram").sortWithinPartitions("gram")
    return near.mapInPandas(scan, "k1 long, k2 long, start int, end int")


def _edges_by_window(rows: DataFrame, match: int) -> DataFrame:
    """The same for grams with very many contexts, every window a row, counted before they move."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at : at + 1024]
                found = [window_hashes(b, match) for b in part["bytes"]]
                out = part.loc[part.index.repeat([len(x) for x in found]), ["k1", "k2", "gram", "lo", "open"]]
                yield out.assign(hash=np.concatenate(found), start=(out["lo"] + np.concatenate([np.arange(len(x)) for x in found])).astype(np.int32)).drop(columns="lo")

    windows = cut(rows.mapInPandas(explode, "k1 long, k2 long, gram long, open boolean, hash long, start int"))
    twice = windows.groupBy("gram", "hash").agg(F.count("*").alias("n")).filter("n > 1").select("gram", "hash")
    found = windows.filter("open").join(twice, ["gram", "hash"], "left_semi")
    return found.select("k1", "k2", "start", (F.col("start") + match).alias("end"))


def repeated_spans(docs: DataFrame, found: DataFrame, matches: DataFrame, match: int, group: int = GROUP, text_col: str = "text") -> DataFrame:
    """(k1, k2, spans): the byte spans of each document that repeated windows cover, sorted by start."""
    hits = cut(found.join(matches, "gram", "left_semi"))
    place = F.struct("k1", "k2", "lo", "hi")
    contexts = cut(hits.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(place).alias("place")))
    mixed = contexts.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    whole = contexts.filter("n > 1").select("gram", "context")
    settled = hits.join(whole, ["gram", "context"], "left_semi").select("k1", "k2", F.col("lo").alias("start"), (F.col("hi") + match).alias("end"))
    edges = contexts.join(mixed, "gram").select("gram", "kinds", (F.col("n") == 1).alias("open"), "place.*")
    asked = edges.groupBy("k1", "k2").agg(F.collect_list(F.struct("gram", "kinds", "open", "lo", "hi")).alias("asked"))  # at most its anchors

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k1, k2, text, asks in zip(pdf["k1"], pdf["k2"], pdf["text"], pdf["asked"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                rows += [(k1, k2, a["gram"], a["kinds"], a["open"], a["lo"], data[a["lo"] : a["hi"] + match]) for a in asks]
            yield pd.DataFrame(rows, columns=["k1", "k2", "gram", "kinds", "open", "lo", "bytes"])

    texts = docs.select(*row_key(), text_or_empty(text_col).alias("text"))
    rows = cut(texts.join(asked, ["k1", "k2"]).mapInPandas(fetch, "k1 long, k2 long, gram long, kinds long, open boolean, lo int, bytes binary"))
    spans = settled.union(_edges_by_gram(rows.filter(F.col("kinds") <= group), match))
    if mixed.filter(F.col("kinds") > group).limit(1).count():
        spans = spans.union(_edges_by_window(rows.filter(F.col("kinds") > group), match))
    out = cut(spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")))
    drop_cut(hits, contexts, rows)
    return out


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by spans sorted by start."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[new], reach[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]


def find_repeats(docs: DataFrame, match: int = 200, gram: int = 64, batches: int = 4, group: int = GROUP, text_col: str = "text") -> DataFrame:
    """Repeated spans of a table, indexed in ``batches`` batches (by a hash of the row)."""
    of = F.pmod(F.col("k2"), F.lit(batches))
    found = cut(document_anchors(docs, match, gram, text_col).withColumn("batch", of))
    index = SuffixIndex(docs.sparkSession)
    for b in range(batches):
        index.add(found.filter(F.col("batch") == b).select("gram"))
    out = repeated_spans(docs, found.drop("batch"), index.matched(), match, group, text_col)
    drop_cut(found)
    return out


def remove_repeats(docs: DataFrame, match: int = 200, gram: int = 64, batches: int = 4, group: int = GROUP, text_col: str = "text", as_text: bool = False) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the remaining bytes) and ``kept_sha256``.

    ``as_text``: leave the parts of a character that a cut has split out of ``kept``, so that it is UTF-8."""
    spans = find_repeats(docs, match, gram, batches, group, text_col).withColumnsRenamed({"k1": "_k1", "k2": "_k2", "spans": "_spans"})
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
    k1, k2 = row_key()
    joined = docs.withColumns({"_a": k1, "_b": k2})
    joined = joined.join(spans, (F.col("_a") == F.col("_k1")) & (F.col("_b") == F.col("_k2")), "left")

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    def apply(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for text, got in zip(texts, lists, strict=True):
            data = text.encode("utf-8", "surrogatepass")
            if got is None or not len(got):
                rows.append((len(data), 0, 0, data, hashlib.sha256(data).hexdigest()))
                continue
            a, b = merge_spans(*(np.array([x[k] for x in got], np.int64) for k in ("start", "end")))
            kept = b"".join(data[i:j] for i, j in zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True))
            text = kept.decode("utf-8", "ignore").encode() if as_text else kept
            rows.append((len(data), len(data) - len(kept), len(a), text, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    done = joined.withColumn("_r", apply(text_or_empty(text_col), "_spans"))
    return done.select(*docs.columns, "_r.n_bytes", "_r.n_removed", "_r.n_spans", "_r.kept", "_r.kept_sha256")
