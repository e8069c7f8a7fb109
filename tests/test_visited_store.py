"""The stored visited set: exact answers, and pieces that stay closed."""

import random

from pyspark.sql import functions as F

from support import rows
from weblattice import schemas
from weblattice.operators.visited import add_visited
from weblattice.sources import visited_store
from weblattice.sources.visited_store import VisitedStore


def urls(spark, names):
    found = spark.createDataFrame([(n, "o", 0) for n in names], "url string, origin_url string, depth int")
    return add_visited(spark.createDataFrame([], schemas.VISITED), found)


def test_lookup_is_exact(spark, tmp_path, monkeypatch):
    """Against a plain set, over parts of several pieces; also with too many pieces to broadcast, and without parts."""
    monkeypatch.setattr(visited_store, "URLS_A_PIECE", 40)
    rng = random.Random(1)
    store, known = VisitedStore(spark, str(tmp_path), ()), set()
    candidates = spark.createDataFrame([(f"http://h{i % 7}/{i}é", i) for i in range(600)], "url string, tag int")
    assert rows(store.unknown(candidates)) == rows(candidates)
    for number in range(3):
        new = {f"http://h{i % 7}/{i}é" for i in rng.sample(range(600), 90)} - known
        store, known = store.add(urls(spark, sorted(new)), number), known | new
    want = [r for r in rows(candidates) if r[0] not in known]
    assert rows(store.unknown(candidates)) == want and rows(store.all(), "url") == sorted((u,) for u in known)
    monkeypatch.setattr(visited_store, "MOST_PIECES", 1)
    assert store.touched(candidates) is None and rows(store.unknown(candidates)) == want


def test_untouched_pieces_stay_closed(spark, tmp_path, monkeypatch):
    """A range without a candidate, and one whose filter has none of them, are not read."""
    monkeypatch.setattr(visited_store, "URLS_A_PIECE", 100)
    store = VisitedStore(spark, str(tmp_path), ()).add(urls(spark, [f"a/{i:04}" for i in range(0, 400, 2)] + [f"m/{i:04}" for i in range(200)]), 0)
    store = store.add(urls(spark, [f"z/{i}" for i in range(50)]), 1)
    candidates = spark.createDataFrame([("a/0011",), ("a/0012",), ("q/1",)], "url string")
    touched = store.touched(candidates)
    assert len(touched) == 1 and touched[0][0] == 0
    files = store.unknown(candidates).select("url").inputFiles()
    assert files and all(f"batch=0/piece={touched[0][1]}/" in name for name in files)
    assert rows(store.unknown(candidates)) == [("a/0011",), ("q/1",)]
    assert store.touched(spark.createDataFrame([("a/0013",), ("n",)], "url string")) == []  # in a range, but the filter says no


def test_part_is_left_alone_when_written_again(spark, tmp_path):
    store = VisitedStore(spark, str(tmp_path), ()).add(urls(spark, ["a", "b"]), 4)
    again = store.add(urls(spark, ["c"]), 4)
    assert again.numbers == (4,) and rows(again.all(), "url") == [("a",), ("b",)]
    empty = again.add(urls(spark, ["x"]).filter(F.lit(False)), 5)
    assert rows(empty.unknown(spark.createDataFrame([("a",), ("x",)], "url string"))) == [("x",)]
