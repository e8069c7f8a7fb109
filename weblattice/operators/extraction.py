"""Page extraction: title, visible text and links of a page in one Arrow pass.

Only HTML bodies travel to Python workers; the routing, the excerpts and the outcome columns are
native expressions. The parser is the standard library's, read with the rules of a tag-soup tree:
an end tag closes up to the nearest open tag of that name, an unmatched one closes nothing.
"""

from __future__ import annotations

from collections import Counter
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from weblattice.functions.content import excerpt, is_html
from weblattice.runtime import ship_by_value, small_batches

# Subtrees without visible text, containers whose text does not count, void elements.
DROPPED = frozenset(("script", "style", "noscript"))
UNCOUNTED = frozenset(("template", "rt", "rp"))
VOID = frozenset((
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image",
    "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source",
    "spacer", "track", "wbr",
))

EXTRACT_TYPE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("links", T.ArrayType(T.StringType())),
    T.StructField("bad_links", T.IntegerType()),
    T.StructField("failure", T.StringType()),
])

ship_by_value(__name__)


class _PageReader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.open_tags: list[str] = []
        self.open_count: Counter[str] = Counter()  # of each name on the stack, so an end tag without a start costs nothing
        self.void_closed: Counter[str] = Counter()  # void elements whose own end tag may still follow
        self.hidden = 0  # open dropped subtrees
        self.muted = 0  # open containers with uncounted text
        self.pending: list[str] = []
        self.strings: list[str] = []
        self.title: list[str] | None = None
        self.title_depth = 0  # size of the tag stack while the first title is open
        self.hrefs: list[str] = []

    def _flush(self) -> None:
        if self.pending:
            text = "".join(self.pending).strip()
            self.pending.clear()
            if text and not self.hidden and not self.muted:
                self.strings.append(text)
                if self.title_depth:
                    self.title.append(text)

    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs)
        if tag in VOID:
            self._close(tag)
            self.void_closed[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.void_closed[tag]:
            self.void_closed[tag] -= 1
        else:
            self._close(tag)

    def _open(self, tag, attrs):
        self._flush()
        self.open_tags.append(tag)
        self.open_count[tag] += 1
        self.hidden += tag in DROPPED
        self.muted += tag in UNCOUNTED
        if self.hidden:
            return
        if tag == "title" and self.title is None:
            self.title, self.title_depth = [], len(self.open_tags)
        elif tag == "a":
            values = [value or "" for name, value in attrs if name == "href"]
            if values:
                self.hrefs.append(values[-1])

    def _close(self, tag):
        self._flush()
        if not self.open_count[tag]:
            return
        while True:
            closed = self.open_tags.pop()
            self.open_count[closed] -= 1
            self.hidden -= closed in DROPPED
            self.muted -= closed in UNCOUNTED
            if len(self.open_tags) < self.title_depth:
                self.title_depth = 0
            if closed == tag:
                return

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(html5.get(name + ";") or "&" + name)

    def handle_charref(self, name):
        text = None
        try:
            code = int(name[1:], 16) if name[0] in "xX" else int(name)
            # Numbers below 256 are read as windows-1252, which browsers do as well.
            text = bytes([code]).decode("windows-1252", "ignore") if code < 256 else None
            text = text or chr(code)
        except (ValueError, OverflowError):
            pass
        if not text or "\ud800" <= text <= "\udfff":
            text = "\N{REPLACEMENT CHARACTER}"
        self.pending.append(text)

    def unknown_decl(self, data):
        self._flush()
        if data[:6].upper() == "CDATA[":
            self.pending.append(data[6:])
            self._flush()

    def parse_html_declaration(self, i):
        """An unknown marked section (``<![foo[``) is a comment up to the next ``>``, as in a browser."""
        if self.rawdata.startswith("<![", i) and not self.rawdata.startswith("<![CDATA[", i):
            end = self.rawdata.find(">", i + 3)
            if end < 0:
                return -1
            self.handle_comment(self.rawdata[i + 2:end])
            return end + 1
        return super().parse_html_declaration(i)

    def _boundary(self, data):
        self._flush()

    handle_comment = handle_decl = handle_pi = _boundary

    def finish(self) -> None:
        self.close()
        self._flush()


def _resolve(base: str, hrefs: list[str]) -> tuple[list[str], int]:
    """Absolute http(s) links in order; a link that cannot be parsed is dropped and counted."""
    links, bad = [], 0
    for href in hrefs:
        try:
            link = urldefrag(urljoin(base, href).strip())[0]
            if urlsplit(link).scheme in ("http", "https"):
                links.append(link)
        except ValueError:
            bad += 1
    return links, bad


@arrow_udf(EXTRACT_TYPE)
def _extract_html(html: pa.Array, url: pa.Array) -> pa.Array:
    titles, texts, links, bad_links, failures = [], [], [], [], []
    for markup, base in zip(html, url):
        body = markup.as_py()
        if body is None:
            titles.append(None)
            texts.append(None)
            links.append(None)
            bad_links.append(None)
            failures.append(None)
            continue
        reader, failure = _PageReader(), None
        try:
            reader.feed(body)
            reader.finish()
        except Exception as error:  # one page must not end the job: it is an error row
            reader, failure = _PageReader(), f"{type(error).__name__}: {error}"
        failures.append(failure)
        found, bad = _resolve(base.as_py() or "", reader.hrefs)
        titles.append(" ".join(reader.title or ()))
        texts.append(" ".join(reader.strings))
        links.append(found)
        bad_links.append(bad)
    columns = [
        pa.array(titles, pa.string()), pa.array(texts, pa.string()),
        pa.array(links, pa.list_(pa.string())), pa.array(bad_links, pa.int32()), pa.array(failures, pa.string()),
    ]
    return pa.StructArray.from_arrays(columns, names=["title", "content", "links", "bad_links", "failure"])


# Called non-deterministic so that it runs once and where it stands: a filter on the failure would else be pushed below it with a parse of its own,
# down to the scan.
_extract_html = _extract_html.asNondeterministic()


def extract_html(html: Column, url: Column) -> Column:
    """``struct<title, content, links, bad_links, failure>``; null for a null body. ``failure`` says why a page cannot be parsed."""
    return _extract_html(html, url)


def extract_pages(responses: DataFrame, whole_text: bool = False) -> DataFrame:
    """Replace ``body`` by ``title``, ``content``, ``links`` and ``bad_links``.

    HTML is parsed; another type gives a 1,000-character excerpt without title or links, or its whole body if ``whole_text``; a response
    with an error gives empty text. A page that cannot be parsed becomes one with an error and empty text.
    The Arrow batches of the session are made small, so a worker's memory does not grow with its partition.
    """
    small_batches(responses.sparkSession)
    html = is_html(F.col("content_type"))
    clean = F.col("error").isNull()
    parsed = responses.withColumn("_page", extract_html(F.when(html & clean, F.col("body")), F.col("url")))
    no_links = F.array().cast("array<string>")
    plain = F.col("body") if whole_text else excerpt(F.col("body"))
    return parsed.select(
        *[F.coalesce("error", "_page.failure").alias("error") if c == "error" else F.col(c) for c in responses.columns if c != "body"],
        F.when(clean & html, F.coalesce("_page.title", F.lit(""))).otherwise("").alias("title"),
        F.when(~clean, "").when(html, F.coalesce("_page.content", F.lit("")))
        .otherwise(F.coalesce(plain, F.lit(""))).alias("content"),
        F.coalesce("_page.links", no_links).alias("links"),
        F.coalesce("_page.bad_links", F.lit(0)).alias("bad_links"),
    )


def with_outcome(pages: DataFrame) -> DataFrame:
    """Add ``outcome`` and the final ``error``: a transport error, an HTTP status from 400, or success."""
    failed = F.col("error").isNotNull()
    status = F.coalesce("status_code", F.lit(0))
    http_error = ~failed & (status >= 400)
    return pages.withColumns({
        "status_code": status,
        "outcome": F.when(failed, "error").when(http_error, "http_error").otherwise("success"),
        "error": F.when(http_error, F.concat(F.lit("HTTP "), status.cast("string"))).otherwise(F.col("error")),
    })


def page_links(pages: DataFrame) -> DataFrame:
    """One row per link, in document order: ``(src, pos, dst)``; duplicates are kept."""
    return pages.select(F.col("url").alias("src"), F.posexplode("links").alias("pos", "dst"))
