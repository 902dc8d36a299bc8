"""Byte-level BPE ids of whole texts with the tokenizers library, one call a distinct word.

The tokenizer's pattern never joins a word to the space after it, so a text is cut before every
single space and each part is encoded on its own: the ids are those of the whole text, and a part
seen before comes from a cache.  Line ends between two words are tokens of their own and cut likewise.  Texts where a space has white space on both sides, or one at the end
after white space, are the only ones where such a cut could move a border; they are encoded whole.
So are texts that hold the string of an added token (``<|endoftext|>``), which the library finds before it
looks for words and gives that token's id.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import threading
import time

import numpy as np
from tokenizers import Tokenizer

_UNSAFE = re.compile(r"\s (?:\s|\Z)")
_TOUCH = re.compile(r"\s\n|\n\s")  # a line end that is part of a longer run
_SPACE = re.compile(r"\s")
_KEPT = 500_000  # words of a generation of the cache; two of them are about 0.25 GB a worker
IDLE = 4.0  # seconds after its last text at which a worker gives its words back, as the next stage may need the memory
_ENCODERS: dict[str, Encoder] = {}


class Cache:
    """Ids of words in two generations: when the new one is full it becomes the old one, and words that are met again move
    back, so that frequent words stay."""

    def __init__(self, kept: int):
        self.kept, self.new, self.old = kept, {}, {}

    def unknown(self, words: set[str]) -> list[str]:
        """Brings ``words`` into the new generation; returns those that no generation has."""
        if len(self.new) > self.kept:
            self.old, self.new = self.new, {}
        missing = words.difference(self.new)
        again = {w: self.old[w] for w in missing if w in self.old}
        self.new.update(again)
        return list(missing.difference(again)) if again else list(missing)


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        if any(_SPACE.search(x) for x in self.added):
            raise ValueError("an added token holds white space; texts can't be encoded in parts")
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.space = self._ids([" "])[0]
        self.lock, self.used = threading.Lock(), time.monotonic()
        self.forget()

    def forget(self) -> None:
        self.odd: set[str] = set()  # words met that hold white space other than spaces and line ends
        self.cache = Cache(_KEPT)  # parts after a space, without it
        self.first = Cache(_KEPT // 4)  # parts at the start of a text

    def forget_when_idle(self) -> None:
        """Runs beside the worker's tasks for as long as the worker lives."""
        while True:
            time.sleep(IDLE / 4)
            with self.lock:
                if self.cache.new and time.monotonic() - self.used > IDLE:
                    self.forget()
                    trim()

    def _ids(self, parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _learn(self, cache: dict[str, bytes], words: list[str], lead: str) -> None:
        """Words without white space go to the library many at a time, each after a line end: the end is a
        token of its own there, and no such word holds it.  That spares an object a word."""
        groups, odd = [words[at : at + 512] for at in range(0, len(words), 512)], []
        for k, some in enumerate(groups):
            if _SPACE.search("".join(some)):
                odd += [w for w in some if _SPACE.search(w)]
                groups[k] = [w for w in some if not _SPACE.search(w)]
        self.odd.update(odd)
        between = f"\n{lead}"
        joined = [between + between.join(some) for some in groups]
        for at in range(0, len(groups), 16):
            for some, e in zip(groups[at : at + 16], self.tokenizer.encode_batch_fast(joined[at : at + 16], add_special_tokens=False), strict=False):
                if not some:
                    continue
                ids = np.array(e.ids, "<u4")
                ends = np.flatnonzero(ids == self.line_end)
                if len(ends) != len(some):
                    raise ValueError("the vocabulary joins line ends to words")
                data, at_byte = ids.tobytes(), (4 * ends).tolist() + [4 * len(ids)]
                cache.update([(w, data[a + 4 : b]) for w, a, b in zip(some, at_byte[:-1], at_byte[1:])])
        for at in range(0, len(odd), 4096):
            some = odd[at : at + 4096]
            cache.update(zip(some, self._ids([lead + w for w in some]), strict=True))

    def _split(self, text: str, careful: bool) -> list[list[str]] | None:
        """Words of the lines of ``text``; None if it goes whole, one line if line ends touch other white space.  Unless
        ``careful``, white space is taken to be spaces and line ends."""
        if any([x in text for x in self.added]) or ((careful or "  " in text or "\n " in text) and _UNSAFE.search(text)):
            return None
        touch = _TOUCH.search(text) if careful else " \n" in text or "\n " in text or "\n\n" in text
        return [x.split(" ") for x in ([text] if touch else text.split("\n"))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        with self.lock:
            out = self._encode(texts, careful=False)
            self.used = time.monotonic()
        return out

    def _encode(self, texts: list[str], careful: bool) -> list[bytes]:
        split = [self._split(t, careful) for t in texts]
        lines = [x for s in split if s for x in s]
        starts = [x.pop(0) for x in lines]
        if len(self.odd) > _KEPT:
            self.forget()
        for cache, words, lead, blank in ((self.cache, set().union(*lines), " ", self.space), (self.first, set(starts), "", b"")):
            words.discard("")
            unknown = cache.unknown(words)
            self._learn(cache.new, unknown, lead)
            cache.new[""] = blank
        get, first, line_end = self.cache.new.__getitem__, self.first.new, np.array([self.line_end], "<u4").tobytes()
        out, begin = [], iter(starts)
        for t, s in zip(texts, split, strict=True):
            if s is None:
                out.append(self._ids([t])[0])
                continue
            heads = [next(begin) for _ in s]
            if self.odd and not careful and not (self.odd.isdisjoint(heads) and all([self.odd.isdisjoint(x) for x in s])):
                out.append(None)  # other white space may touch a cut
                continue
            out.append(line_end.join([first[h] + b"".join(map(get, x)) for h, x in zip(heads, s)]))
        again = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(again, self._encode([texts[k] for k in again], careful=True) if again else ()):
            out[k] = ids
        return out


def trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; made once, kept with its cache."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads; idle ones of the library's own would spin
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
        threading.Thread(target=_ENCODERS[path].forget_when_idle, daemon=True).start()
    return _ENCODERS[path]


def runs(texts: list[str], size: int = 1 << 21):
    """Slices of ``texts`` of about ``size`` characters, to bound what one encode call holds."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield texts[at : i + 1]
            at, held = i + 1, 0
    if at < len(texts):
        yield texts[at:]
