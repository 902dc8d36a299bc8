"""Reading of markup against plain regular expressions on small pages, and time on broken ones."""

import html
import random
import re
import time

import pytest

from roaslens.llm import sharding, warc

HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
BLOCK = r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
LANG = re.compile(r"<html\b[^>]*\blang\s*=\s*[\"']?([\w-]+)", re.I)


def plain_text(page):
    body = re.sub(r"<[/!?a-zA-Z][^>]*>", "", re.sub(BLOCK, "\n", HIDDEN.sub(" ", page), flags=re.I))
    return "\n".join(x for x in (re.sub(r"[^\S\n]+", " ", y).strip() for y in html.unescape(body).split("\n")) if x)


@pytest.mark.parametrize("seed", range(6))
def test_against_plain_expressions(seed):
    rng = random.Random(seed)
    bits = ["<a ", "<A HREF", "href", "=", '"', "'", ">", "<", "</", "x", " ", "\n", "<!--", "-->", "<script", "</script>", "</script >", "<style>", "</style>", "<p>", "</P>", "<br/>", "&amp;", "<title", "<title>",
            "</title>", "<html ", "lang=", "de", "lang", "a.b/c", "<template", "é", "&lt;a&gt;", "<1", "data-href="]
    for _ in range(1500):
        page = "".join(rng.choice(bits) for _ in range(rng.randint(0, 28)))
        assert warc.text_of(page) == plain_text(page), page
        assert warc.links_of(page) == [html.unescape(a or b or c) for a, b, c in LINK.findall(HIDDEN.sub(" ", page))], page
        assert warc.title_of(page) == (m[1] if (m := TITLE.search(page)) else None), page
        assert warc.language_of(page) == (m[1] if (m := LANG.search(page)) else None), page


@pytest.mark.parametrize("bit", ["<a ", "<script ", "<title>", "<html lang ", "<", "<!", "<a href='", '<a href="x" ', "<p ", "<a <p href=", "<!-- ", "<style> "])
def test_broken_pages_take_time_in_proportion(bit):
    def seconds(n):
        page, start = bit * (n // len(bit)), time.perf_counter()
        warc.derive({"body": page.encode(), "http_headers": "", "record_id": "r", "target_uri": "u", "date": "d"})
        return time.perf_counter() - start

    assert seconds(3_000_000) < 20


def test_names_like_results(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x", "old")], "page_id long, url string, html string, kind string")
    made = warc.derivatives(warc.responses(pages, "2024-01-01T00:00:00Z", ("page_id", "kind")), ("page_id", "kind"))
    assert sorted(r.kind for r in made.collect()) == ["conversion", "metadata"] and made.columns.count("kind") == 1
    rows = spark.createDataFrame([(i, "a", 5, 7) for i in range(9)], "doc_id long, shard string, slot int, row int")
    placed = sharding.shard(rows, 3, 1, ["doc_id"]).collect()
    assert sorted((r.shard, r.slot) for r in placed) == [(s, k) for s in range(3) for k in range(3)] and sorted(r.row for r in placed) == list(range(9))
