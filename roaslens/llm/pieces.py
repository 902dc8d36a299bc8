"""SentencePiece models on the tokenizers library: the model file is parsed here, its normaliser, space
marker, scores or merges and byte fallback are rebuilt there, and both libraries must agree.

A text is encoded in parts, each a run of spaces and what follows, which is lossless because no piece
of the model has the space marker after another character (checked when a model is loaded).  A part
seen before comes from a cache; new parts go to the library in batches, on as many threads as the task
has cores, and are held against the sentencepiece library's own ids: ``parity`` is about every part of
every text.

Null texts count as empty and have no pieces; equal rows have equal results; an empty table gives an
empty one; other columns pass through.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaslens.llm.bpe import runs
from roaslens.llm.common import text_or_empty

MARK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = range(1, 7)  # piece types of the file format
_UNIGRAM, _BPE = 1, 2
_CACHED = 500_000  # parts; about 0.1 GB a worker
_SLICE = 1 << 20  # characters split into parts at a time
_CUT = re.compile("(?<=[^ ]) (?=[^ ])")


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = _UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + n]
        at += n


def parse_model(data: bytes) -> Model:
    """Read a model file; field numbers are those of the public format."""
    m = Model()
    for number, value in _fields(data):
        if number == 1:
            got = dict(_fields(value))
            m.pieces.append((got.get(1, b"").decode(), struct.unpack("<f", got.get(2, b"\0\0\0\0"))[0], got.get(3, _NORMAL)))
        elif number == 2:
            got = dict(_fields(value))
            m.kind, m.byte_fallback = got.get(3, _UNIGRAM), bool(got.get(35, 0))
        elif number == 3:
            got = dict(_fields(value))
            m.charsmap = got.get(2, b"")
            m.add_prefix, m.remove_extra, m.escape = bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1))
    return m


def merges_of(m: Model) -> list[tuple[str, str]]:
    """Merges of a BPE model: every way to join two pieces into one, the best scored piece first."""
    ids = {p: i for i, (p, _, kind) in enumerate(m.pieces) if kind in (_NORMAL, _USER)}
    made = [(-m.pieces[i][1], i, ids[p[:k]], ids[p[k:]], p[:k], p[k:]) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
    return [(a, b) for *_, a, b in sorted(made)]


def build(m: Model):
    """The tokenizers model over parts that already carry the marker; line ends separate parts."""
    from tokenizers import Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next(p for p, _, kind in m.pieces if kind == _UNKNOWN)
    if m.kind == _BPE:
        model = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges_of(m), unk_token=unknown, fuse_unk=True, byte_fallback=m.byte_fallback)
    elif m.kind == _UNIGRAM:
        names = [p for p, _, _ in m.pieces]
        model = models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=names.index(unknown), byte_fallback=m.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models are supported")
    t = Tokenizer(model)
    if m.charsmap:
        t.normalizer = normalizers.Precompiled(m.charsmap)
    t.pre_tokenizer = pre_tokenizers.Split("\n", "isolated")
    t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return t


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            self.model = parse_model(f.read())
        self.tokenizer = build(self.model)
        self.peer = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = [p for p, _, kind in self.model.pieces if kind in (_NORMAL, _USER)]
        if any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in texts):
            raise ValueError("a piece of the model joins words; texts can't be encoded in parts")
        if self.model.charsmap or self.model.remove_extra or not (self.model.add_prefix and self.model.escape):
            self.whole = True  # normalisation looks across parts
        else:
            self.whole = False
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.cache: dict[str, bytes] = {}  # parts without their first marker, others as spaces
        self.differ: set[str] = set()  # parts on which the libraries differ
        self.surface = [bytes([int(p[3:5], 16)]) if kind == _BYTE else b"" if kind == _CONTROL else b" \xe2\x81\x87 " if kind == _UNKNOWN else p.replace(MARK, " ").encode() for p, _, kind in self.model.pieces]
        self.is_byte = np.array([kind == _BYTE for *_, kind in self.model.pieces])

    def _prepare(self, text: str) -> str:
        if self.model.remove_extra:
            text = re.sub(" +", " ", text.replace(MARK, " ")).strip(" ")
        return (MARK if self.model.add_prefix and text else "") + text.replace(" ", MARK)

    def _learn(self, parts: list[str]) -> None:
        """Parts without line ends go to the library many at a time, each after a line end."""
        plain = [p for p in parts if "\n" not in p]
        odd = [p for p in parts if "\n" in p]
        mark = self.line_end[0]
        for at in range(0, len(plain), 512):
            group = plain[at : at + 512]
            joined = "".join([f"\n{MARK}{p}" for p in group]).replace(" ", MARK)
            ids = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids
            array = np.array(ids, "<u4")
            starts = (np.flatnonzero(array == mark) + 1).tolist()
            if len(starts) != len(group):
                raise ValueError("the model joins line ends to words")
            data, ends = array.tobytes(), [x - 1 for x in starts[1:]] + [len(ids)]
            self._store(group, [ids[a:b] for a, b in zip(starts, ends, strict=True)], [data[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)])
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([MARK + p.replace(" ", MARK) for p in odd], add_special_tokens=False)]
        self._store(odd, ids, [np.array(x, "<u4").tobytes() for x in ids])

    def _store(self, parts: list[str], ids: list[list[int]], data: list[bytes]) -> None:
        self.cache.update(zip(parts, data, strict=True))
        # the peer adds the first marker itself, but none to an empty text
        for p, own, theirs in zip(parts, ids, self.peer.encode(parts, num_threads=1), strict=True):
            if own != (theirs if p else [self.peer.piece_to_id(MARK)]):
                self.differ.add(p)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """(ids as little-endian unsigned 32-bit integers, both libraries agree) of each text."""
        if self.whole:
            # ``nmt_nfkc`` and the like work on the whole text: no cache, one call a batch
            ids = [e.ids for e in self.tokenizer.encode_batch_fast([self._prepare(t) for t in texts], add_special_tokens=False)]
            same = [a == b for a, b in zip(self.peer.encode(texts, num_threads=1), ids, strict=True)]
            return [(np.array(x, "<u4").tobytes(), ok) for x, ok in zip(ids, same, strict=True)]
        texts = [t.replace(MARK, " ") for t in texts]
        if max(map(len, texts), default=0) <= _SLICE:
            return self._look_up([self._parts(t) for t in texts])
        out = []
        for t in texts:  # a very long text goes slice by slice
            got = [self._look_up([self._parts(x)])[0] for x in self._slices(t)]
            out.append((b"".join([ids for ids, _ in got]), all([same for _, same in got])))
        return out

    def _look_up(self, split: list[list[str]]) -> list[tuple[bytes, bool]]:
        new = {p for s in split for p in s if p not in self.cache}
        if len(self.cache) + len(new) > _CACHED:
            self.cache.clear()
            self.differ.clear()
            new = {p for s in split for p in s}
        self._learn(list(new))
        get = self.cache.__getitem__
        return [(b"".join(map(get, s)), not self.differ or self.differ.isdisjoint(s)) for s in split]

    @staticmethod
    def _slices(text: str) -> Iterator[str]:
        """The text cut at single spaces, each of which is the marker of the part behind it."""
        at = 0
        while len(text) - at > _SLICE and (cut := _CUT.search(text, at + _SLICE)):
            yield text[at : cut.start()]
            at = cut.end()
        yield text[at:]

    @staticmethod
    def _parts(text: str) -> list[str]:
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [p[1:] for p in re.findall(" +[^ ]*", " " + text)]
        return text.split(" ")

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.surface[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.model.add_prefix and text[:1] == " " else text

    def normalised(self, text: str) -> str:
        return text.replace(MARK, " ")


_CODECS: dict[str, Codec] = {}


def codec(path: str, threads: int = 1) -> Codec:
    """The worker's codec of a model file; ``threads`` are for the batches of new parts."""
    if path not in _CODECS:
        os.environ.update(TOKENIZERS_PARALLELISM="true", RAYON_NUM_THREADS=str(threads))
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, model: str, text_col: str = "text", threads: int | None = None) -> DataFrame:
    """``docs`` with ``ids`` (little-endian unsigned 32-bit integers) and ``parity``."""
    threads = threads or int(docs.sparkSession.conf.get("spark.task.cpus", "1"))

    @F.pandas_udf("ids binary, parity boolean")
    def to_ids(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(model, threads)
        for s in batches:
            for some in runs(s.tolist(), _SLICE):
                yield pd.DataFrame(c.encode(some), columns=["ids", "parity"])

    return docs.withColumn("_e", to_ids(text_or_empty(text_col))).select(*[c for c in docs.columns if c not in ("ids", "parity")], "_e.ids", "_e.parity")


def decode(rows: DataFrame, model: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids (byte pieces joined, invalid UTF-8 replaced) and ``n_bytes_pieces``."""

    @F.pandas_udf("text string, n_byte_pieces long")
    def to_text(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for s in batches:
            for some in runs([x or b"" for x in s], _SLICE):
                ids = [np.frombuffer(x, "<u4") for x in some]
                yield pd.DataFrame({"text": [c.decode(x) for x in ids], "n_byte_pieces": [int(c.is_byte[x].sum()) for x in ids]})

    return rows.withColumn("_d", to_text(ids_col)).select("*", F.col("_d.text").alias(out), "_d.n_byte_pieces").drop("_d")
