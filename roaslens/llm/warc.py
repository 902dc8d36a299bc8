"""WARC derivatives: each response record yields a metadata and a plain-text conversion record.

Both keep the source's target URI and date, name it in ``WARC-Refers-To`` (with its target URI and
date) and carry their own block digest; the metadata block lists the source's HTTP headers, digest,
title, language and links, the conversion block is the page's text in UTF-8.  Record ids are
name-based UUIDs of the source id and the record type, so a repeated or retried run gives the same records.

Null bodies count as empty, null URLs leave the target header out; equal rows give equal records; an
empty table gives none.  Other columns pass through ``keep``; one named like a result is replaced by it.

Markup is read in one pass forward, whatever it looks like: once a search for the end of a tag has failed, none
behind it is made again, so broken pages of any length take time in proportion.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "WARC/1.1"
_HIDDEN = re.compile(r"<!--|<(script|style|noscript|template)\b", re.I)
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>", re.I)
_TAG = re.compile(r"<[/!?a-zA-Z][^>]*>")
_SPACES = re.compile(r"[^\S\n]+")
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title", re.I)
_HTML, _LANG = re.compile(r"<html\b[^>]*", re.I), re.compile(r"(?=\blang\s*=\s*[\"']?([\w-]+))", re.I)
_ANCHOR, _HREF = re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=\s*", re.I)
_VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)")
_CLOSE = {x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style", "noscript", "template")}


def visible(page: str) -> str:
    """The page with a space for each comment and each element whose text is not shown, up to its end or the page's."""
    out, at, from_ = [], 0, 0
    open_tags = True  # there may be an end of a tag ahead
    while m := _HIDDEN.search(page, from_):
        if m[1] is None:
            end = page.find("-->", m.end())
            end = len(page) if end < 0 else end + 3
        else:
            head = page.find(">", m.end()) if open_tags else -1
            if head < 0:
                open_tags, from_ = False, m.end()
                continue
            close = _CLOSE[m[1].lower()].search(page, head + 1)
            end = close.end() if close else len(page)
        out += [page[at : m.start()], " "]
        at = from_ = end
    return "".join([*out, page[at:]])


def text_of(page: str) -> str:
    """Text of a page: markup, scripts and comments out, block elements on lines of their own."""
    shown = visible(page)
    last = shown.rfind(">") + 1  # no tag ends behind it, and each tag before it does
    body = _TAG.sub("", _BREAK.sub("\n", shown[:last])) + shown[last:]
    lines = (x.strip() for x in _SPACES.sub(" ", html.unescape(body)).split("\n"))
    return "\n".join(x for x in lines if x)


def title_of(page: str) -> str | None:
    """What stands in the first title element, if it is closed."""
    if not (m := _TITLE.search(page)) or (head := page.find(">", m.end())) < 0 or not (end := _TITLE_END.search(page, head + 1)):
        return None
    return page[head + 1 : end.start()]


def language_of(page: str) -> str | None:
    """The last ``lang`` of the first html tag that has one."""
    for tag in _HTML.finditer(page):
        if found := [m[1] for m in _LANG.finditer(tag[0])]:
            return found[-1]
    return None


def links_of(page: str) -> list[str]:
    """Targets of the links, in order; a quoted one may hold ``>``."""
    shown, out, at, end = visible(page), [], 0, -1
    while tag := _ANCHOR.search(shown, at):
        at = tag.end()
        if end < at:  # of the tag, searched for once
            end = shown.find(">", at)
            end = len(shown) if end < 0 else end
        for m in _HREF.finditer(shown, at, end):
            if value := _VALUE.match(shown, m.end()):
                out.append(html.unescape(value[1] or value[2] or value[3] or ""))
                at = value.end()
                break
        else:
            at = end
    return out


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {source}')}>"


def serialise(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record's bytes; headers without a value are left out, line ends in values become spaces."""
    lines = [f"{k}: {re.sub(r'[\r\n]+', ' ', v)}" for k, v in headers if v is not None]
    head = "\r\n".join([VERSION, *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Records of a WARC byte string."""
    out, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        out.append((headers, data[start:stop]))
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has no end")
        at = stop + 4
    return out


def responses(pages: DataFrame, date: str, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Response records of a page table (url, html): record_id, target_uri, date, http_headers, body."""
    source = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in (*keep, "url")], F.sha2(F.coalesce("html", F.lit("")), 256))
    hexed = F.md5(source)
    parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"))
    return pages.select(
        *keep,
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        head.alias("http_headers"),
        body.alias("body"),
    )


def derive(source: dict) -> list[dict]:
    """The two records of one response."""
    body = bytes(source["body"] or b"")
    page = body.decode("utf-8", "replace")
    payload = digest(body)
    title, lang, links = title_of(page), language_of(page), links_of(page)
    fields = [("source-payload-digest", payload), ("source-length", str(len(body)))]
    fields += [("http-" + k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in (source["http_headers"] or "").split("\r\n")[1:])]
    fields += [("title", " ".join(text_of(title).split()))] if title is not None else []
    fields += [("language", lang)] if lang else []
    fields += [("outlink", x) for x in links]
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in fields).encode("utf-8", "replace")),
        "conversion": ("text/plain; charset=UTF-8", text_of(page).encode("utf-8", "replace")),
    }
    out = []
    for kind, (content, block) in blocks.items():
        own = record_id(source["record_id"], kind)
        headers = [
            ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", source["date"]), ("WARC-Target-URI", source["target_uri"]),
            ("WARC-Refers-To", source["record_id"]), ("WARC-Refers-To-Target-URI", source["target_uri"]), ("WARC-Refers-To-Date", source["date"]),
            ("WARC-Payload-Digest", payload if kind == "metadata" else None), ("WARC-Block-Digest", digest(block)), ("Content-Type", content),
        ]
        out.append({
            "kind": kind, "record_id": own, "refers_to": source["record_id"], "target_uri": source["target_uri"], "date": source["date"],
            "source_digest": payload, "block_digest": digest(block), "n_links": len(links), "block": block, "record": serialise(headers, block),
        })
    return out


def derivatives(sources: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Two rows a response: ``keep``, kind, record_id, refers_to, target_uri, date, source_digest,
    block_digest, n_links, block and record (the whole record's bytes)."""
    made = "kind string, record_id string, refers_to string, target_uri string, date string, source_digest string, block_digest string, n_links long, block binary, record binary"
    made = T.StructType.fromDDL(made)
    keep = tuple(c for c in keep if c not in made.names)
    schema = T.StructType([sources.schema[c] for c in keep] + made.fields)
    names = schema.names

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                rows = [{**{k: s[k] for k in keep}, **d} for s in pdf.iloc[at : at + 500].to_dict("records") for d in derive(s)]
                yield pd.DataFrame(rows, columns=names)

    return sources.mapInPandas(build, schema)


def sha256(col: str) -> Column:
    return F.sha2(F.col(col), 256)
