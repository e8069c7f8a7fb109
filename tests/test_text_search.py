"""Full text against golden ranks and against stock SQLite FTS5, in this process."""

import random
import shutil
import sqlite3

import pytest

from support import rows
from weblattice.functions.porter import with_stem
from weblattice.operators.text_index import (
    add_to_text_index, build_text_index, compact_text_index, corpus_stats, document_frequency, drop_covered, live_runs, load_text_index, replace_pages,
    save_text_index, stemmed_postings,
)
from weblattice.operators import text_search
from weblattice.operators.text_search import all_of, any_of, but_not, near, phrase, search_text, search_text_batch

GOLDEN_ROWS = [
    ("u1", "Python guide", "Python guide running runs fast für naïve"),
    ("u2", "Error", ""),
    ("u3", "", ""),
    ("u4", "Cats", "cats run the python nested relational"),
    ("u5", "Dogs", "dogs bark all day running"),
    ("u6", "", "hopping generalization python python"),
    ("u7", "z", "zz top"),
    ("u8", "q", "quiet place"),
]
GOLDEN = [
    (lambda: "python", [("u6", -0.626822), ("u1", -0.466441), ("u4", -0.351705)]),
    (lambda: "running", [("u1", -0.466441), ("u5", -0.381116), ("u4", -0.351705)]),
    (lambda: "runs", [("u1", -0.466441), ("u5", -0.381116), ("u4", -0.351705)]),
    (lambda: "fur", [("u1", -1.084914)]),
    (lambda: "für", [("u1", -1.084914)]),
    (lambda: "naive", [("u1", -1.084914)]),
    (lambda: "the", [("u4", -1.252360)]),
    (lambda: all_of("python", "running"), [("u1", -0.932882), ("u4", -0.703411)]),
    (lambda: any_of("python", "dogs"), [("u5", -1.962135), ("u6", -0.626822), ("u1", -0.466441), ("u4", -0.351705)]),
    (lambda: but_not("python", "cats"), [("u6", -0.626822), ("u1", -0.466441)]),
    (lambda: "python guide", [("u1", -1.660912)]),
    (lambda: phrase("pyth", prefix=True), [("u6", -0.626822), ("u1", -0.466441), ("u4", -0.351705)]),
    (lambda: phrase("python", columns="title"), [("u1", -1.084914)]),
    (lambda: near("cats", "python", distance=5), [("u4", -1.604066)]),
    (lambda: phrase("python", initial=True), [("u1", -1.660912)]),
    (lambda: "u1", []),
    (lambda: "   ", []),
]


def pages_frame(spark, rows):
    return spark.createDataFrame(
        [(url, "o", 0, title, content) for url, title, content in rows],
        "url string, origin_url string, depth int, title string, content string",
    )


def sqlite_index(rows, tokenizer="porter unicode61"):
    db = sqlite3.connect(":memory:")
    db.execute(f"create virtual table f using fts5(url unindexed, title, content, tokenize='{tokenizer}')")
    db.executemany("insert into f values (?, ?, ?)", rows)
    return db


def ranks(df):
    return [(r["url"], round(r["rank"], 6)) for r in df.collect()]


@pytest.fixture(scope="module")
def golden_index(spark):
    index = build_text_index(pages_frame(spark, GOLDEN_ROWS))
    import tempfile

    return save_text_index(index, tempfile.mkdtemp() + "/index")


@pytest.mark.parametrize("number", range(len(GOLDEN)))
def test_golden(golden_index, number):
    make, expected = GOLDEN[number]
    found = ranks(search_text(golden_index, make()))
    assert [url for url, _ in found] == [url for url, _ in expected]
    assert [rank for _, rank in found] == pytest.approx([rank for _, rank in expected], abs=1.1e-6)


def test_golden_vocabulary(golden_index):
    stems = sorted({r["term"] for r in stemmed_postings(golden_index).collect()})
    expected = "all bark cat dai dog error fast fur gener guid hop naiv nest place python q quiet relat run the top z zz"
    assert stems == expected.split()


def test_limit_and_empty_arguments(golden_index):
    assert [u for u, _ in ranks(search_text(golden_index, "python", limit=1))] == ["u6"]
    with pytest.raises(ValueError):
        all_of()


def test_replace_pages(spark, golden_index):
    changed = pages_frame(spark, [("u6", "", "no snakes"), ("u9", "new", "python")])
    index = replace_pages(golden_index, changed)
    rest = [r for r in GOLDEN_ROWS if r[0] != "u6"] + [("u6", "", "no snakes"), ("u9", "new", "python")]
    db = sqlite_index(rest)
    expected = db.execute("select url, round(bm25(f), 6) from f where f match 'python' order by bm25(f), url").fetchall()
    assert ranks(search_text(index, "python")) == expected
    assert [u for u, _ in ranks(search_text(index, "snakes"))] == ["u6"]


def test_tokens_and_folding(spark):
    texts = ["École x̰y z̲q", "x²y ǘb ﬁx straße ñandú", "_a-b'c", "人間 İstanbul ΑΣ", "don't stop ÀÉ K"]
    rows = [(f"d{i}", "", t) for i, t in enumerate(texts)]
    db = sqlite_index(rows)
    db.execute("create virtual table v using fts5vocab('f', 'row')")
    index = build_text_index(pages_frame(spark, rows))
    mine = sorted({r["term"] for r in stemmed_postings(index).collect()})
    assert mine == sorted(r[0] for r in db.execute("select term from v"))


def test_stems_equal_sqlite(spark):
    pick = random.Random(7)
    roots = ["relat", "hop", "happ", "tr", "fall", "bl", "siz", "agre", "y", "sy", "play", "enjoy", "vietnam", "é", "ll", "oss", "x1"]
    middles = ["", "e", "i", "y", "l", "s", "at", "iz", "bl", "ous", "iv", "al", "ful", "ness", "ement", "ion", "logi", "tt", "ow"]
    tails = ["", "s", "es", "sses", "ies", "ed", "ing", "eed", "ly", "ational", "tional", "izer", "bli", "alli", "ization",
             "iveness", "fulness", "biliti", "icate", "ative", "alize", "iciti", "ical", "ance", "able", "ent", "ment",
             "ion", "ou", "ism", "ate", "iti", "ive", "ize", "e", "ll", "y", "ey"]
    words = {pick.choice(roots) + pick.choice(middles) + pick.choice(middles) + pick.choice(tails) for _ in range(3000)}
    words |= {"".join(pick.choice("aeioubcdlstwxyz") for _ in range(pick.randint(1, 9))) + pick.choice(tails) for _ in range(3000)}
    words |= {"a" * 62 + "ing", "a" * 61 + "ing", "running" * 12}
    words = sorted(w for w in words if w)
    db = sqlite3.connect(":memory:")
    db.execute("create virtual table f using fts5(a, tokenize='porter unicode61')")
    db.execute("create virtual table v using fts5vocab('f', 'instance')")
    db.executemany("insert into f(rowid, a) values (?, ?)", list(enumerate(words)))
    expected = {words[doc]: term for term, doc in db.execute("select term, doc from v")}
    frame = spark.createDataFrame([(w,) for w in words], "term string")
    from weblattice.functions.text import fold
    mine = {r["word"]: r["stem"] for r in with_stem(frame.selectExpr("term as word", "term").withColumn("term", fold(frame["term"]))).collect()}
    wrong = [(w, expected[w], mine[w]) for w in words if expected[w] != mine[w]]
    assert not wrong, wrong[:20]


WORDS = ["red", "green", "blue", "fox", "dog", "cat"]


def random_rows(pick, n=120):
    def text(most):
        return " ".join(pick.choice(WORDS) for _ in range(pick.randint(0, most)))

    return [(f"p{i:03}", text(3), text(14)) for i in range(n)]


def random_query(pick, depth=2, top=True):
    kind = pick.choice(["term", "phrase", "prefix", "column", "initial", "near", "near3"] + ["all", "any", "not"] * (2 * (depth > 0)))
    word = lambda: pick.choice(WORDS)
    if kind == "term":
        w = word()
        return phrase(w), w
    if kind == "phrase":
        w = f"{word()} {word()}"
        return phrase(w), f'"{w}"'
    if kind == "prefix":
        w = word()[: pick.randint(1, 2)]
        return phrase(w, prefix=True), f"{w}*"
    if kind == "column":
        w, field = word(), pick.choice(["title", "content"])
        return phrase(w, columns=field), f"{field}: {w}"
    if kind == "initial":
        w = f"{word()} {word()}" if pick.random() < 0.5 else word()
        return phrase(w, initial=True), f'^ "{w}"'
    if kind in ("near", "near3"):
        ws = pick.sample(WORDS, 2 if kind == "near" else 3)
        # Below other operators only one-token members: SQLite ranks by stale positions otherwise.
        ws[0] = f"{ws[0]} {word()}" if top and pick.random() < 0.4 else ws[0]
        n = pick.randint(0, 4)
        return near(*ws, distance=n), "NEAR(" + " ".join(f'"{w}"' for w in ws) + f", {n})"
    left, right = random_query(pick, depth - 1, False), random_query(pick, depth - 1, False)
    make, sign = {"all": (all_of, "AND"), "any": (any_of, "OR"), "not": (but_not, "NOT")}[kind]
    return make(left[0], right[0]), f"({left[1]}) {sign} ({right[1]})"


def test_random_queries_equal_sqlite(spark, tmp_path):
    pick = random.Random(11)
    rows = random_rows(pick)
    db = sqlite_index(rows, "unicode61")
    index = save_text_index(build_text_index(pages_frame(spark, rows), stem=False), str(tmp_path / "i"))
    wrong = []
    for number in range(16):
        query, text = random_query(pick, number % 3)
        expected = [(u, round(r, 6)) for u, r in db.execute("select url, bm25(f) from f where f match ?", (text,))]
        mine = ranks(search_text(index, query, limit=None))
        if sorted(mine) != sorted(expected):
            wrong.append((text, len(mine), len(expected), sorted(set(mine) ^ set(expected))[:4]))
    assert not wrong, wrong


def test_batch_equals_single(spark, golden_index):
    queries = spark.createDataFrame([(1, "python dogs"), (2, "running"), (3, " "), (4, "python python")], "query_id int, query string")
    got = {}
    for r in search_text_batch(golden_index, queries).orderBy("query_id", "position").collect():
        got.setdefault(r["query_id"], []).append((r["url"], round(r["rank"], 6)))
    assert got[1] == ranks(search_text(golden_index, any_of("python", "dogs")))
    assert got[2] == ranks(search_text(golden_index, "running"))
    assert 3 not in got
    assert got[4] == ranks(search_text(golden_index, any_of("python", "python")))
    both = search_text_batch(golden_index, spark.createDataFrame([(1, "python running")], "query_id int, query string"), match="all")
    assert [(r["url"], round(r["rank"], 6)) for r in both.orderBy("position").collect()] == ranks(search_text(golden_index, all_of("python", "running")))


def test_replaced_pages_take_the_last_row_of_a_url(spark):
    columns = "url string, origin_url string, depth int, title string, content string, fetched_at int"
    old = spark.createDataFrame([("a", "o", 0, "", "one", 1), ("b", "o", 0, "", "two", 1)], columns)
    new = spark.createDataFrame([("b", "o", 0, "", "three", 2), ("b", "o", 0, "", "four", 3)], columns)
    index = replace_pages(build_text_index(old, stem=False), new)
    assert rows(index.documents, "url", "n_tokens") == [("a", 1), ("b", 1)]
    assert rows(index.postings, "term", "url") == [("four", "b"), ("one", "a")]


def test_unknown_columns_are_refused():
    with pytest.raises(ValueError):
        phrase("x", columns="body")


def test_near_ignores_members_without_a_token(spark):
    pages = spark.createDataFrame([("a", "o", 0, "", "cats and dogs"), ("b", "o", 0, "", "dogs")], "url string, origin_url string, depth int, title string, content string")
    index = build_text_index(pages, stem=False)
    assert rows(search_text(index, near("cats", " "))) == rows(search_text(index, near("cats"))) != []
    assert rows(search_text(index, any_of(near(" ", ""), "dogs")), "url") == [("a",), ("b",)]


def _best(found, limit):
    """Position, url and rank per query, from all matches."""
    lists = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"], r["url"])):
        lists.setdefault(r["query_id"], []).append((r["url"], r["rank"]))
    return {q: [(i + 1, *row) for i, row in enumerate(rows_[:limit])] for q, rows_ in lists.items()}


@pytest.mark.parametrize("cell", [None, (400, 7, 16)])
def test_pruned_batch_equals_all_matches(spark, monkeypatch, cell):
    """Hot words, ties, repeated query words, and queries with fewer than ``limit`` matches; in one cell, and in many of small blocks."""
    for name, value in zip(("HITS_A_LANE", "QUERIES_A_GROUP", "BLOCK_DOCUMENTS"), cell or ()):
        monkeypatch.setattr(text_search, name, value)
    random.seed(5)
    words = ["the", "of"] * 40 + [f"w{i}" for i in range(60)] + ["rare1"]
    pages = [(f"d{i:03}", "", " ".join(random.choices(words, k=random.randint(0, 30)))) for i in range(300)]
    pages += [(f"t{i}", "", "the of w1 tied") for i in range(40)] + [("x1", "", "lonely the"), ("x2", "", "lonely")]
    index = build_text_index(pages_frame(spark, pages), stem=False)
    asked = [(i, " ".join(random.choices(words, k=random.randint(1, 12)))) for i in range(40)]
    asked += [(100, "tied the of"), (101, "lonely nowhere"), (102, "nowhere"), (103, "the the the w2"), (104, ""), (105, "the of w1 tied")]
    queries = spark.createDataFrame(asked, "query_id int, query string")
    complete = search_text_batch(index, queries, limit=None)
    for limit in (3, 25):
        found = {}
        for r in search_text_batch(index, queries, limit=limit).collect():
            found.setdefault(r["query_id"], []).append((r["position"], r["url"], r["rank"]))
        assert {q: sorted(rows_) for q, rows_ in found.items()} == _best(complete, limit)


def test_batch_forms_rows_for_the_best_of_a_cell_only(spark, monkeypatch):
    """Common words in all documents: a row for each of the best of a cell, not one for each pair, and blocks below the floor passed over."""
    random.seed(6)
    pages = [(f"d{i:04}", "", " ".join(random.choices(["a1", "b1", "c1", "d1"], k=random.randint(1, 60)))) for i in range(600)]
    index = build_text_index(pages_frame(spark, pages), stem=False)
    asked = spark.createDataFrame([(q, word, 1) for q in range(20) for word in ("a1", "b1", "c1")], "query_id int, term string, weight bigint")
    terms = spark.createDataFrame([("a1", 1.0, 30.0, 0), ("b1", 2.0, 30.0, 1), ("c1", 0.5, 30.0, 2)], "term string, idf double, avg_tokens double, number bigint")
    monkeypatch.setattr(text_search, "HITS_A_LANE", 1200)
    hits = index.frequencies.join(terms.select("term"), "term", "left_semi").cache()
    lanes = -(-hits.count() // 1200)
    found = text_search._any_word(hits, terms, asked, 5).groupBy("query_id").count().collect()
    assert len(found) == 20 and all(r["count"] == 5 * lanes for r in found)


def test_batch_all_words_needs_every_word(spark, golden_index):
    queries = spark.createDataFrame([(1, "python running"), (2, "python nowhere"), (3, "run run cats")], "query_id int, query string")
    for limit in (None, 5):
        found = search_text_batch(golden_index, queries, limit=limit, match="all")
        assert rows(found, "query_id", "url") == [(1, "u1"), (1, "u4"), (3, "u4")]


def test_segments_equal_one_index(spark, tmp_path):
    """Pages added in segments, replaced, merged and added again: as one index over the latest rows."""
    random.seed(9)
    root, latest = str(tmp_path / "index"), {}
    queries = spark.createDataFrame([(1, "cat running"), (2, "dog bird the")], "query_id int, query string")
    for turn in range(3):
        pages = [(f"u{random.randrange(12)}", "t" * (i % 2), " ".join(random.choices("cat dog cats run running the bird".split(), k=i))) for i in range(6)]
        pages = list({url: (url, title, text) for url, title, text in pages}.values())
        latest.update({url: (url, title, text) for url, title, text in pages})
        index = add_to_text_index(spark, root, pages_frame(spark, pages))
        if turn == 1:
            before = ranks(search_text(index, any_of("cat", "run")))
            assert live_runs(spark, root) == [(0, 1)] and compact_text_index(spark, root) is None  # merged by the writer
            index = load_text_index(spark, root)
            assert index.replaced is None and ranks(search_text(index, any_of("cat", "run"))) == before
        whole = build_text_index(pages_frame(spark, list(latest.values())))
        assert rows(corpus_stats(index)) == rows(corpus_stats(whole))
        assert ranks(search_text(index, any_of("cat", "run"))) == ranks(search_text(whole, any_of("cat", "run")))
        assert rows(document_frequency(index)) == rows(document_frequency(whole))
    assert all("/counts/" in name for name in document_frequency(index).inputFiles())  # no postings are read
    assert rows(index.live(index.documents)) == rows(whole.documents)
    assert rows(document_frequency(index)) == rows(document_frequency(whole))
    assert rows(stemmed_postings(index)) == rows(stemmed_postings(whole))
    assert rows(search_text_batch(index, queries)) == rows(search_text_batch(whole, queries))


def test_many_segments_stay_few_runs(spark, tmp_path):
    """Eleven segments, some of pages of before: runs as in a binary counter, a lost merge made up for, and old files dropped."""
    root, latest = str(tmp_path / "index"), {}
    for number in range(11):
        for i in range(3):
            row = (f"u{(5 * number + i) % 20:02}", "", f"cat w{number} dog")
            latest[row[0]] = row
        pages = [latest[f"u{(5 * number + i) % 20:02}"] for i in range(3)]
        index = add_to_text_index(spark, root, pages_frame(spark, pages), stem=False)
        if number == 6:  # the writer is lost before its merge counts
            shutil.rmtree(f"{root}/runs/4-5")
    assert live_runs(spark, root) == [(0, 7), (8, 9), (10, 10)]
    whole = build_text_index(pages_frame(spark, list(latest.values())), stem=False)
    assert rows(corpus_stats(index), "n_docs", "avg_tokens") == rows(corpus_stats(whole), "n_docs", "avg_tokens")
    assert drop_covered(spark, root) and live_runs(spark, root) == [(0, 7), (8, 9), (10, 10)]
    index = load_text_index(spark, root, stem=False)
    assert ranks(search_text(index, "cat", limit=None)) == ranks(search_text(whole, "cat", limit=None))
    assert compact_text_index(spark, root, stem=False) == 10 and live_runs(spark, root) == [(0, 10)]
    assert rows(load_text_index(spark, root, stem=False).frequencies.drop("segment")) == rows(whole.frequencies)


def test_runs_of_other_urls_are_not_searched_for_replacements(spark, tmp_path):
    root = str(tmp_path / "index")
    for prefix in ("a", "b", "c"):
        index = add_to_text_index(spark, root, pages_frame(spark, [(f"{prefix}{i}", "", "cat") for i in range(3)]), stem=False)
    assert len(live_runs(spark, root)) == 2 and index.replaced is None
    assert search_text(index, "cat", limit=None).count() == 9


def test_finished_segment_is_left_alone(spark, tmp_path):
    root = str(tmp_path / "index")
    add_to_text_index(spark, root, pages_frame(spark, GOLDEN_ROWS), segment=0)
    files = sorted(p for p in (tmp_path / "index").rglob("*.parquet"))
    index = add_to_text_index(spark, root, pages_frame(spark, GOLDEN_ROWS[:2]), segment=0)
    assert sorted(p for p in (tmp_path / "index").rglob("*.parquet")) == files and index.documents.count() == len(GOLDEN_ROWS)


def test_segment_search_filters_the_scan_and_reads_stored_sizes(spark, tmp_path):
    root = str(tmp_path / "index")
    for pages in (GOLDEN_ROWS, GOLDEN_ROWS[3:5]):
        index = add_to_text_index(spark, root, pages_frame(spark, pages))
    plan = search_text(index, "python")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(stem,python)" in plan and "avg(" not in plan
