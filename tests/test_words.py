"""Word index, posting store and word search."""

import json

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from support import rows
from weblattice import schemas
from weblattice.functions.words import STOP_WORDS
from weblattice.operators.postings import append_postings, word_postings, words_on_many_urls
from weblattice.operators.word_search import audit_scores, search_words, search_words_batch
from weblattice.sources.results import search_response
from weblattice.sources.word_store import (
    append_posting_lines, parse_posting_lines, read_posting_lines, read_postings, write_postings,
)

GOLDEN = [
    "python https://docs.python.org/3/ https://docs.python.org/3/ 0 55",
    "python https://docs.python.org/3.13/ https://docs.python.org/3/ 1 55",
    "python https://docs.python.org/3.8/ https://docs.python.org/3/ 1 20",
]
DROPPED = ["", "w u o 1", "w u o x 1 2", "w u o x 3", "w u o 1 2.5"]


def lines_frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


@pytest.fixture(scope="module")
def golden(spark):
    return parse_posting_lines(lines_frame(spark, GOLDEN + DROPPED)).cache()


def page_frame(spark, texts):
    return spark.createDataFrame(
        [(f"u{i}", "o", 1, text) for i, text in enumerate(texts)], "url string, origin_url string, depth int, content string"
    )


def test_parse_keeps_only_full_lines(golden):
    assert golden.count() == 3
    assert dict(golden.dtypes) == {"word": "string", "url": "string", "origin_url": "string", "depth": "int", "frequency": "int"}


@pytest.mark.parametrize("query", ["python", " Python ", "\tPYTHON\n"])
def test_scores(golden, query):
    assert [r["score"] for r in search_words(golden, query).collect()] == [1550, 1545, 1195]


def test_no_match(golden):
    for query in ("", "   ", "python docs", "pytho"):
        assert search_words(golden, query).count() == 0


def test_sort_modes(spark):
    lines = ["w b o 3 9", "w a o 0 1", "w c o 3 200", "w a o 0 1"]
    postings = parse_posting_lines(lines_frame(spark, lines))
    urls = lambda mode: [r["url"] for r in search_words(postings, "w", mode).collect()]
    assert urls("depth") == ["a", "a", "b", "c"]  # duplicate postings are all returned
    assert urls("frequency") == ["c", "b", "a", "a"]
    assert urls("relevance") == urls("zzz") == ["c", "b", "a", "a"]


def test_posting_files(spark, tmp_path, golden):
    path = str(tmp_path / "lines")
    assert read_posting_lines(spark, path).count() == 0
    assert append_posting_lines(golden, path) == 3
    odd = spark.createDataFrame([("w", "http://h/a b", "o", 1, 2), ("", "u", "o", 1, 2), ("w", "u", "o", 1, 0)], schemas.WORD_POSTINGS)
    assert append_posting_lines(odd, path) == 1  # no empty word, no zero frequency
    assert append_posting_lines(golden, path) == 3
    assert read_posting_lines(spark, path).count() == 6  # the url with a blank is lost in the text form
    twin = str(tmp_path / "twin")
    write_postings(append_postings(golden, odd, golden), twin)
    assert read_postings(spark, twin).count() == 7


def expected_words(texts):
    """Counts by DuckDB: pieces between other signs than small letters and digits, of two signs or more, but for the stop words."""
    frame = pd.DataFrame({"n": range(len(texts)), "text": [t.lower() for t in texts]})  # noqa: F841
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    found = duckdb.sql(f"""SELECT n, piece, count(*) FROM (SELECT n, unnest(string_split_regex(text, '[^a-z0-9]')) AS piece FROM frame)
        WHERE length(piece) >= 2 AND piece NOT IN ({stop}) GROUP BY ALL""").fetchall()
    return {(f"u{n}", piece): count for n, piece, count in found}


TEXTS = st.text(alphabet=st.sampled_from("aàbdefhnort 0-'.ßİ\n　\U0001f600THE"), max_size=80)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXTS, min_size=30, max_size=60))
def test_counts_equal_plain_python(spark, texts):
    texts = texts + ["für", "f oo", "The theory of THE the", "ab ab abc a", "x" * 300, "10 10 x10", ""]
    found = {(r["url"], r["word"]): r["frequency"] for r in word_postings(page_frame(spark, texts)).collect()}
    assert found == expected_words(texts)


def test_words_on_many_urls(spark):
    postings = word_postings(page_frame(spark, ["dog cat cat", "dog bird", "dog"]))
    assert rows(words_on_many_urls(postings)) == [("dog", 3)]
    again = append_postings(postings, postings)
    assert again.count() == 2 * postings.count() and rows(words_on_many_urls(again)) == [("dog", 3)]


def test_batch_equals_single(spark, golden):
    other = parse_posting_lines(lines_frame(spark, ["spark x o 2 3", "spark y o 1 3"]))
    postings = append_postings(golden, other)
    queries = spark.createDataFrame([(1, " PYTHON"), (2, "spark"), (3, " "), (4, "python")], "query_id int, query string")
    got = {}
    for r in search_words_batch(postings, queries, limit=2).orderBy("query_id", "position").collect():
        got.setdefault(r["query_id"], []).append((r["url"], r["score"]))
    for number, word in ((1, "python"), (2, "spark"), (4, "python")):
        assert got[number] == [(r["url"], r["score"]) for r in search_words(postings, word, limit=2).collect()]
    assert 3 not in got


def test_audit(spark, golden):
    queries = spark.createDataFrame([("python", "python")], "query_id string, query string")
    results = search_words_batch(golden, queries, limit=3).withColumnRenamed("query_id", "word")
    assert all(r["passed"] for r in audit_scores(golden, results).collect())
    wrong = results.withColumn("score", results["score"] + (results["position"] == 2).cast("int"))
    assert [r["position"] for r in audit_scores(golden, wrong).filter("NOT passed").collect()] == [2]
    missing = results.filter("position <> 3")
    assert [r["passed"] for r in audit_scores(golden, missing).orderBy("position").collect()] == [True, True, False]


def test_response_shape(golden):
    pages = search_response(search_words(golden, "python"), "python", page_size=2).orderBy("page_no").collect()
    assert [(r["query"], r["page_no"], len(json.loads(r["response"])["results"])) for r in pages] == [("python", 0, 2), ("python", 1, 1)]
    text = search_response(search_words(golden, "python"), "python", limit=2).collect()[0]["response"]
    body = json.loads(text)
    assert body["query"] == "python"
    assert body["results"][0] == {"url": "https://docs.python.org/3/", "score": 1550, "frequency": 55, "depth": 0}
    assert len(body["results"]) == 2
    assert json.loads(search_response(search_words(golden, "none"), "none").collect()[0]["response"]) == {"query": "none", "results": []}
