"""The stored index on corpora that are longer than one task sorts: what is shuffled, and that rows stay the same."""

import pyarrow.parquet as pq
import pytest
from support import rows

from weblattice.operators import text_index
from weblattice.operators.text_index import add_to_text_index, build_text_index, document_frequency, live_runs, save_text_index, stemmed_postings

PAGES = [(f"u{i:02}", "o", i % 3, "Title" * (i % 2), f"cat w{i} dog the the running w{i % 5}") for i in range(40)] + [(None, None, None, None, None)]
LATER = [(f"u{i:02}", "o", 1, "", f"bird w{i} the") for i in range(0, 40, 4)] + [("v1", "o", 0, "new", None)]


def frame(spark, pages):
    return spark.createDataFrame(pages, "url string, origin_url string, depth int, title string, content string")


@pytest.fixture
def short_tasks(monkeypatch):
    monkeypatch.setattr(text_index, "TOKENS_A_TASK", 60)
    monkeypatch.setattr(text_index, "TOKENS_A_FILE", 20)


@pytest.fixture
def written_plans(spark, monkeypatch):
    """Plans of all tables that are written, by the end of their path."""
    plans, writer = {}, type(spark.range(1).write)
    write = writer.parquet

    def recorded(self, path, *args, **options):
        plans["/".join(path.split("/index/")[-1:])] = self._df._jdf.queryExecution().executedPlan().toString()
        return write(self, path, *args, **options)

    monkeypatch.setattr(writer, "parquet", recorded)
    return plans


def test_postings_are_not_shuffled(spark, tmp_path, short_tasks, written_plans):
    """A segment shuffles its pages, a merge of long runs nothing, though a quarter of the pages is replaced."""
    root = str(tmp_path / "index")
    save_text_index(build_text_index(frame(spark, PAGES), stem=False), root)
    first = sorted((tmp_path / "index" / "postings" / "segment=0").glob("*.parquet"))
    assert len(first) > 1
    for file in first:
        keys = pq.read_table(file, columns=["term", "url"]).to_pylist()
        assert keys == sorted(keys, key=lambda r: (r["term"], r["url"] or ""))
    add_to_text_index(spark, root, frame(spark, LATER), stem=False)
    assert live_runs(spark, root) == [(0, 1)]
    for name in ("postings", "frequencies"):
        for part in ("segment=0", "segment=1"):
            text = written_plans[f"{name}/{part}"]
            assert "hashpartitioning" not in text and text.index("Generate") < text.index("RoundRobinPartitioning"), text
        text = written_plans[f"{name}/run-0-1/segment=1"]
        assert "hashpartitioning" not in text and "SortMergeJoin" not in text and "Sort [" not in text, text


@pytest.mark.parametrize("most", [0, 1_000_000])
@pytest.mark.parametrize("stem", [False, True])
def test_long_runs_give_the_rows_of_one_index(spark, tmp_path, short_tasks, monkeypatch, most, stem):
    monkeypatch.setattr(text_index, "MOST_REPLACED", most)
    root = str(tmp_path / "index")
    for pages in (PAGES, LATER, LATER[2:5]):
        index = add_to_text_index(spark, root, frame(spark, pages), stem)
    gone = {page[0] for page in LATER}
    whole = build_text_index(frame(spark, [page for page in PAGES if page[0] not in gone] + LATER), stem)
    plain = lambda table: sorted(map(repr, rows_of(index.live(table))))
    assert plain(index.documents) == sorted(map(repr, rows_of(whole.documents)))
    assert plain(index.postings.drop("stem")) == sorted(map(repr, rows_of(whole.postings)))
    assert plain(index.frequencies) == sorted(map(repr, rows_of(whole.frequencies)))
    assert rows(document_frequency(index)) == rows(document_frequency(whole))
    if stem:
        assert sorted(map(repr, rows_of(stemmed_postings(index)))) == sorted(map(repr, rows_of(stemmed_postings(whole))))


def rows_of(table):
    return [tuple(r) for r in table.collect()]
