"""Extraction, urls, charsets, outcomes."""

import encodings.aliases
import random
import time
from urllib.parse import quote, unquote, urldefrag, urlsplit

import pyarrow as pa
from pyspark.sql import functions as F

from support import rows
from weblattice import schemas
from weblattice.functions.content import decode_body
from weblattice.functions.urls import host_key, is_crawlable, normalize_url, quote as quoted, unquote as unquoted
from weblattice.operators.extraction import extract_pages, page_links, with_outcome
from weblattice.operators.postings import word_postings
from weblattice.sources.responses import decode_responses

HTML = "text/html; charset=utf-8"


def responses(spark, *items):
    """Items are (url, body) or (url, body, content type, status, error)."""
    full = [(url, "o", 0, *(rest + [HTML, 200, None][len(rest) - 1:])) for url, *rest in map(list, items)]
    return spark.createDataFrame(
        full, "url string, origin_url string, depth int, body string, content_type string, status_code int, error string"
    )


def extracted(spark, body, url="http://h/en/12?x=1"):
    row = extract_pages(responses(spark, (url, body))).collect()[0]
    return row["title"], row["content"], row["links"], row["bad_links"]


def test_title_counts_in_text(spark):
    pages = extract_pages(responses(spark, ("u", "<title>ab</title><p>ab</p>")))
    assert pages.collect()[0]["content"] == "ab ab"
    assert rows(word_postings(pages), "word", "frequency") == [("ab", 2)]


def test_dropped_subtrees(spark):
    body = """<script>var t="</p>";<b>x</b></script><style>p{}</style><noscript><a href="/z">no</a></noscript>yes"""
    assert extracted(spark, body) == ("", "yes", [], 0)
    assert extracted(spark, "<div><noscript>x</div>y")[1] == "y"  # the closing div ends the noscript too
    assert extracted(spark, "a<template>t<b>u</b></template><!-- c -->b<ruby>k<rt>r</rt></ruby>")[1] == "a b k"


def test_inline_tags_split_words(spark):
    assert extracted(spark, "f<b>oo</b>")[1] == "f oo"
    assert extracted(spark, "a&amp;b &copy;&nope; &#65;&#150;<br/>c\n")[1] == "a&b ©&nope A– c"
    assert extracted(spark, "<![CDATA[x y]]>z")[1] == "x y z"


def test_title_rules(spark):
    assert extracted(spark, "<title> a <i>b</i>  </title><title>c</title>")[0] == "a b"
    assert extracted(spark, "<noscript><title>x</title></noscript><p>y")[0] == ""


def test_links(spark):
    body = "".join(
        f'<a href="{h}">t</a>' for h in ("/a", "b", "", "#f", "?q=2", "//o/p", "../z", "mailto:x@y", "javascript:0", "http://[bad", "/a")
    ) + "<a name=n>u</a><base href='http://other/'><A HREF=' /c#d '>v</A>"
    _, _, links, bad = extracted(spark, body)
    assert links == [
        "http://h/a", "http://h/en/b", "http://h/en/12?x=1", "http://h/en/12?x=1", "http://h/en/12?q=2", "http://o/p",
        "http://h/z", "http://h/a", "http://h/c",
    ]
    assert bad == 1
    edges = page_links(extract_pages(responses(spark, ("http://h/", "<a href=x></a><a href=x></a>"))))
    assert rows(edges) == [("http://h/", 0, "http://h/x"), ("http://h/", 1, "http://h/x")]


def test_routing_and_outcomes(spark):
    pages = with_outcome(extract_pages(responses(
        spark,
        ("plain", "w" * 1500 + "<a href=/x>", "text/plain", 200, None),
        ("none", "<p>x", None, 200, None),
        ("upper", "<p>x y", "TEXT/HTML", 200, None),
        ("gone", "<title>t</title>", HTML, 404, "HTTPError: Not Found"),
        ("teapot", "<title>t</title>z", HTML, 418, None),
        ("lost", None, None, None, "timed out"),
    )))
    got = {r["url"]: (r["outcome"], r["status_code"], r["error"], r["title"], len(r["content"]), r["links"]) for r in pages.collect()}
    assert got["plain"] == ("success", 200, None, "", 1000, [])
    assert got["none"] == ("success", 200, None, "", 4, [])
    assert got["upper"] == ("success", 200, None, "", 3, [])
    assert got["gone"] == ("error", 404, "HTTPError: Not Found", "", 0, [])
    assert got["teapot"] == ("http_error", 418, "HTTP 418", "t", 3, [])
    assert got["lost"] == ("error", 0, "timed out", "", 0, [])
    assert {r["url"] for r in word_postings(pages).collect()} == {"plain"}


def test_urls_equal_urllib(spark):
    pick = random.Random(3)
    heads = ["http://H.x", "HTTPS://u:p@h:8/", "http://h/a%20b", "mailto:x", "/rel", "", "ftp://f/", "http://h/ü"]
    tails = ["", "#", "#f", "?", "?#", "?q=1#x#y", "/../z", "%zz%41+", " ", "　", "\t#f\n", "a b*~!'()"]
    urls = sorted({pick.choice(["", " ", "\x1f"]) + pick.choice(heads) + pick.choice(tails) + pick.choice(tails) for _ in range(400)})
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r["url"]: r for r in frame.select(
        "url", normalize_url(F.col("url")).alias("n"), host_key(F.col("url")).alias("h"), is_crawlable(F.col("url")).alias("c"),
        quoted(F.col("url")).alias("q"), unquoted(F.col("url")).alias("uq"),
    ).collect()}
    for url in urls:
        assert got[url]["n"] == urldefrag(url.strip())[0], url
        assert got[url]["q"] == quote(url), url
        assert got[url]["uq"] == unquote(url), url
        if url.startswith(("http:", "HTTPS:")) and not set(" \t\n\x1f　#?") & set(url):
            parts = urlsplit(url)
            assert got[url]["h"] == f"{parts.scheme}://{parts.netloc}", url
            assert got[url]["c"]


def test_charsets(spark):
    text = "naïve “x” ß"
    cases = [
        ("a", text.encode("utf-8"), "text/html", text),
        ("b", b"a\xffb", "text/html; charset=UTF-8", "a�b"),
        ("c", text.encode("cp1252"), 'text/html; Charset="Windows-1252"', text),
        ("d", "naïve".encode("latin-1"), "text/html;charset=iso-8859-1", "naïve"),
        ("e", text.encode("utf-16"), "text/html; charset=utf-16", text),
        ("f", "日本".encode("shift_jis"), "text/html; charset=shift_jis", "日本"),
    ]
    frame = spark.createDataFrame(
        [(u, 200, t, bytearray(b), None) for u, b, t, _ in cases] + [("g", 200, "text/html; charset=no-such", bytearray(b"x"), None), ("h", 0, "", None, "timed out")],
        "url string, status_code int, content_type string, body binary, error string",
    )
    got = {r["url"]: r for r in decode_responses(frame).collect()}
    for url, _, _, wanted in cases:
        assert got[url]["body"] == wanted and got[url]["error"] is None, url
    assert (got["g"]["status_code"], got["g"]["body"], got["g"]["error"]) == (0, "", "unknown encoding: no-such")
    assert (got["h"]["body"], got["h"]["error"]) == (None, "timed out")


TAG_SOUP = ["<![foo[b]]>x", "<![ x", "a<![CDATA[b]]>c", "<![if !IE]>y<![endif]>z", "<!DOCTYPE [", "<![x", "<!-", "<!>", "</>", "<a href='", "<?php", "&#x110000;&#-1;&#;&x"]


def test_no_markup_ends_the_job(spark):
    rng = random.Random(11)
    parts = [*TAG_SOUP, "<", ">", "<p>", "</p>", "<br>", "</br>", "<title>", "text", "<script>", "]]>", "<!", "[", "\0"]
    bodies = TAG_SOUP + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    frame = spark.createDataFrame([(f"http://h/{i}", 200, "text/html", b, None) for i, b in enumerate(bodies)], schemas.RESPONSES)
    got = {r["url"]: r for r in with_outcome(extract_pages(frame)).collect()}
    assert len(got) == len(bodies)
    assert got["http://h/0"]["content"] == "x" and got["http://h/2"]["content"] == "a b c"
    assert all(r["outcome"] == ("success" if r["error"] is None else "error") for r in got.values())


def test_parse_time_follows_the_size(spark):
    def seconds(body):
        frame = spark.createDataFrame([("http://h/", 200, "text/html", body, None)], schemas.RESPONSES)
        began = time.perf_counter()
        extract_pages(frame).collect()
        return time.perf_counter() - began

    seconds("<p>x")
    assert seconds("<p>x" * 60_000 + "</i>" * 60_000) < 10
    assert seconds("<br><b>x</b>" * 60_000) < 10


def test_no_charset_ends_the_job(spark):
    names = sorted({*encodings.aliases.aliases, *encodings.aliases.aliases.values(), "base64", "hex", "rot13", "idna", "undefined", "no-such", "latin-1"})
    frame = spark.createDataFrame([(n, bytearray(b"caf\xe9 \xff\x00 abc"), f"text/html; charset={n}") for n in names], "name string, body binary, ct string")
    got = {r["name"]: (r["d"]["text"], r["d"]["error"]) for r in frame.select("name", decode_body(frame["body"], frame["ct"]).alias("d")).collect()}
    assert len(got) == len(names)
    for name in ("base64", "hex", "rot13", "no-such"):
        assert got[name][0] == "" and got[name][1]
    assert got["latin-1"] == ("caf\xe9 \xff\x00 abc", None) and got["ascii"] == ("caf� �\x00 abc", None)


def test_pages_are_parsed_once_even_under_filters(spark):
    """The filter of failed pages is not pushed below the parser with a parse of its own."""
    pages = extract_pages(responses(spark, ("http://h/a", "<p>one two</p>")).repartition(2))
    plan = word_postings(pages.filter(F.col("error").isNull()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert rows(word_postings(pages), "word") == [("one",), ("two",)]


def test_workers_get_small_batches_in_a_session_of_default_settings(spark, monkeypatch):
    """A worker would hold 10,000 pages at a time else, or as many as its partition has."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    raw = spark.range(1200, numPartitions=1).selectExpr(
        "concat('http://h/', id) AS url", "200 AS status_code", "'text/html' AS content_type", "'<p>x' AS body", "CAST(NULL AS string) AS error")
    try:
        for given, kept in (("10000", "500"), ("0", "500"), ("100", "100")):
            spark.conf.set(key, given)
            pages = extract_pages(raw)
            assert spark.conf.get(key) == kept
        spark.conf.set(key, "10000")
        sizes = extract_pages(raw).select("url").mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint")
        assert max(r["n"] for r in sizes.collect()) <= 500 and pages.count() == 1200
    finally:
        spark.conf.set(key, before)
